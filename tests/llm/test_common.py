import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlake.llm.common import BATCH_BYTES, BATCH_CONF, small_batches, stored, temporary
from marketlake.session import scratch_path, shared_dir


def left(spark, name):
    folder = shared_dir(spark).removeprefix("file:")
    return [f for f in os.listdir(folder) if f.startswith(f"{name}-")]


def test_stored_results_stay_unless_they_are_temporary(spark):
    kept = stored(spark.range(5), "kept")
    path = scratch_path(spark, "result")
    with temporary(spark):
        inner = stored(spark.range(7), "inner")
        with temporary(spark):
            assert stored(inner, "nested").count() == 7
        assert not left(spark, "nested") and inner.count() == 7
        inner.write.parquet(path)
    assert spark.read.parquet(path).count() == 7 and kept.count() == 5
    assert not left(spark, "inner") and len(left(spark, "kept")) == 1


def test_temporary_results_of_a_failed_job_go(spark):
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|raise"), temporary(spark):
        stored(spark.range(3), "early")
        stored(spark.range(3).selectExpr("1 / (id - 1) as x"), "late")
    assert not left(spark, "early") and not left(spark, "late")


def test_workers_get_small_batches_inside(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    texts = spark.range(0, 4000, 1, 1).select(F.lit("x" * 2000).alias("text"))
    frame = texts.mapInArrow(sizes, "rows bigint, bytes bigint")
    before = spark.conf.get(BATCH_CONF, None)
    with small_batches(spark):
        small = stored(frame, "small").collect()
    assert sum(r["rows"] for r in small) == 4000 and max(r["bytes"] for r in small) < 1.5 * BATCH_BYTES
    assert spark.conf.get(BATCH_CONF, None) == before
    assert [r["rows"] for r in frame.collect()] == [4000]


def test_the_batch_bound_of_the_session_is_back_afterwards(spark):
    spark.conf.set(BATCH_CONF, "3000000")
    try:
        with pytest.raises(ValueError, match="inside"), small_batches(spark):
            raise ValueError("inside")
        assert spark.conf.get(BATCH_CONF) == "3000000"
    finally:
        spark.conf.unset(BATCH_CONF)
