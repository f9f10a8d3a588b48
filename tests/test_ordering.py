from contextlib import ExitStack
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.operators import ordering
from marketlake.operators.ordering import group_sizes, key_sketch, number_rows, split_hot, surrogate_key
from marketlake.session import kept


@pytest.fixture
def skewed(spark):
    """One key holds most rows; another key is NULL."""
    hot = spark.range(300).select(F.lit("hot").alias("k"), (F.col("id") % 37).alias("v"), F.col("id").alias("w"))
    cold = spark.range(40).select(
        F.when(F.col("id") % 4 != 0, F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        F.col("id").alias("v"),
        F.lit(1).cast("long").alias("w"),
    )
    return hot.unionByName(cold)


def test_group_sizes(skewed):
    sizes = group_sizes(skewed, ["k"])
    assert (sizes.groups, sizes.largest) == (9, 300)


@pytest.mark.parametrize("keys", [["k"], []])
def test_split_numbering_equals_window(skewed, keys):
    order = [F.col("v").desc(), F.col("w").asc(), F.col("k").asc()]
    spec = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)
    want = skewed.withColumn("n", F.row_number().over(spec))
    assert rows(number_rows(skewed, keys, order, "n", max_group_rows=10)) == rows(want)
    assert rows(number_rows(skewed, keys, order, "n")) == rows(want)


def test_identical_copies_are_numbered_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(ordering, "COPY_STEP", 16)
    df = spark.range(100).select(F.lit("a").alias("k"), F.lit(1).alias("v")).unionByName(
        spark.createDataFrame([("a", 0), ("a", 2), ("b", 1)], "k string, v int")
    )
    numbered = number_rows(df, ["k"], [F.col("v")], "n", max_group_rows=5)
    assert sorted(r.n for r in numbered.filter("k = 'a'").collect()) == list(range(1, 103))
    assert [(r.v, r.n) for r in numbered.filter("k = 'a' and v <> 1").orderBy("v").collect()] == [(0, 1), (2, 102)]


def test_numbering_of_distinct_rows(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 997).alias("v"), (F.col("id") % 3).alias("k"))
    whole = surrogate_key(df, "n", [F.col("v").desc()])
    assert rows(surrogate_key(df, "n", [F.col("v").desc()], start=0, max_rows=10, unique=True)) == rows(whole)
    by_key = number_rows(df, ["k"], [F.col("v")], "n")
    assert rows(number_rows(df, ["k"], [F.col("v")], "n", max_group_rows=10, unique=True)) == rows(by_key)


def test_placed_rows_are_kept_as_files_if_the_caller_says_so(spark, monkeypatch):
    df = spark.range(500).select((F.col("id") * 7919 % 997).alias("v"), (F.col("id") % 3).alias("k"))
    order = [F.col("v").desc()]
    whole, none, paths = rows(surrogate_key(df, "n", order)), df.limit(0), []
    monkeypatch.setattr(ordering, "checkpointed", None)
    with ExitStack() as files:

        def store(placed):
            found = files.enter_context(kept(placed, "placed"))
            paths.extend(found.inputFiles())
            return found

        numbered = surrogate_key(df, "n", order, unique=True, store=store)
        assert rows(numbered) == whole and all(Path(unquote(urlparse(f).path)).exists() for f in paths)
        assert rows(surrogate_key(none, "n", order, unique=True, store=store)) == []
    assert paths and not any(Path(unquote(urlparse(f).path)).exists() for f in paths)


def test_surrogate_key_continues_after_start(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    want = [(11, "a"), (12, "b"), (13, "c")]
    assert rows(surrogate_key(df, "id", [F.col("k")], start=10)) == want
    assert rows(surrogate_key(df, "id", [F.col("k")], start=10, max_rows=1)) == want
    assert surrogate_key(df, "id", [F.col("k")]).columns == ["id", "k"]


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string")
    assert surrogate_key(df, "id", [F.col("k")]).count() == 0


@pytest.fixture
def third(spark):
    """A key with a third of all rows among keys of one row each, NULL among them."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.when(F.col("id") > 1, F.col("id") + 10))
    return spark.range(0, 60_000, 1, 6).select(key.alias("k"), (F.col("id") * 7919 % 60_013).alias("v"))


def test_a_sketch_finds_the_hot_key_without_a_shuffle_of_keys(spark, third):
    sketch = key_sketch(third, ["k"], 1000)
    assert sketch.hot == (third.filter("k = 7").select(F.xxhash64("k")).first()[0],)
    assert 0.9 < sketch.groups / 40_001 < 1.1
    assert key_sketch(third, ["k"], 30_000).hot == () == key_sketch(third.limit(0), ["k"], 0).hot
    others, hot = split_hot(third, ["k"], sketch.hot)
    assert (others.count(), hot.count()) == (40_000, 20_000)


@pytest.mark.parametrize("unique", [False, True])
def test_only_the_hot_key_is_split(spark, third, unique):
    want = third.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("v")))
    got = number_rows(third, ["k"], [F.col("v")], "n", max_group_rows=1000, unique=unique)
    assert got.exceptAll(want).isEmpty() and got.count() == 60_000


def test_no_key_is_counted_when_rows_are_ranked(spark, third, monkeypatch):
    def counted(*_):
        raise AssertionError("counting pass")

    monkeypatch.setattr(ordering, "group_sizes", counted)
    assert number_rows(third, ["k"], [F.col("v")], "n").count() == 60_000
