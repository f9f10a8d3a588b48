import os
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import test_bpe
import test_decontamination
import test_simhash
from cases import SF, by_id, docs, write
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marketlake.llm.common import table
from marketlake.llm.pii import pseudonymize
from marketlake.llm.quality_rules import quality_report
from marketlake.session import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    given = table(spark, SF, "documents")
    frames = [given]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frames.append(stage(spark, frames[-1], SF).cache())
        assert frames[-1].columns == COLUMNS
    first, good, single, clean, private = frames

    kept = {r["doc_id"] for r in quality_report(first, table(spark, SF, "labels")).where("kept").collect()}
    assert sorted(r["doc_id"] for r in good.collect()) == sorted(kept) and good.exceptAll(first).isEmpty()

    texts = [(r["doc_id"], r["text"]) for r in good.collect()]
    root = test_simhash.connect({test_simhash.fingerprint(t) for _, t in texts})
    least = {}
    for i, t in texts:
        group = root[test_simhash.fingerprint(t)]
        least[group] = min(i, least.get(group, i))
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(least.values()) and single.exceptAll(good).isEmpty()

    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    want = [r["doc_id"] for r in single.collect() if not test_decontamination.brute(r["text"], items)["contaminated"]]
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(want) and clean.exceptAll(single).isEmpty()

    new = {i: rows[0]["text"] for i, rows in by_id(pseudonymize(clean)).items()}
    assert {r["doc_id"]: r["text"] for r in private.collect()} == new
    assert private.where(F.length("text") != F.col("n_chars")).isEmpty()

    library = Tokenizer.from_file(test_bpe.PATH)
    got = by_id(corpus_pipeline.run(spark, SF))
    assert got.keys() == new.keys()
    for i, text in new.items():
        assert {k: v for k, v in got[i][0].items() if k != "doc_id"} == test_bpe.brute(library, text)


def test_only_the_last_stage_stays(spark, tmp_path):
    write(docs(spark, [" ".join(f"plain{i}" for i in range(40)), "short", None]), tmp_path, "documents")
    write(spark.createDataFrame([], "doc_id bigint, quality int, toxic int"), tmp_path, "labels")
    write(spark.createDataFrame([(1, "a b c")], "item_id bigint, text string"), tmp_path, "benchmark")
    folder = shared_dir(spark).removeprefix("file:")
    before = {f for f in os.listdir(folder) if os.path.isdir(f"{folder}/{f}")}
    rows = corpus_pipeline.run(spark, str(tmp_path))
    left = {f for f in os.listdir(folder) if os.path.isdir(f"{folder}/{f}")} - before
    assert [f for f in left if not f.startswith("pipeline-bpe_round_trip-")] == [] and len(left) == 1
    assert [r["doc_id"] for r in rows.collect()] == [0]


def test_edge_rows(spark, tmp_path):
    good = " ".join(f"plain{i}" for i in range(40))
    texts = [None, "", good, good, good, good + " 4111111111111111", "x " * 50_000]
    write(docs(spark, texts, ids=[0, 1, 2, 2, None, 3, 4]).withColumn("key", F.lit(1)), tmp_path, "documents")
    write(spark.createDataFrame([], "doc_id bigint, quality int, toxic int"), tmp_path, "labels")
    write(spark.createDataFrame([], "item_id bigint, text string"), tmp_path, "benchmark")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} <= {2, 3} and len([r for r in rows if r["doc_id"] == 2]) == 1

    write(docs(spark, []), tmp_path, "documents")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
