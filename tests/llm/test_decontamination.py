import hashlib
import random
import re
import sys
import tracemalloc
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[1]))
from cases import SF, by_id, docs, with_clashes
from compare import difference

from marketlake.llm import decontamination
from marketlake.llm.common import BATCH_BYTES, BATCH_CONF
from marketlake.llm.decontamination import ORACLE, decontamination_report, marking


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        other = words(other)
        n = min(10, len(other))
        windows = {tuple(other[i : i + n]) for i in range(len(other) - n + 1)} if other else set()
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    listed = sorted(str(i) for i in found if i is not None)
    return {
        "n_words": len(own),
        "n_hit": len(hit),
        "n_items": len(listed),
        "items_sha256": hashlib.sha256(",".join(listed).encode()).hexdigest(),
        "contaminated": bool(hit),
    }


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").repartition(2)


def test_against_brute_force(spark):
    draw = random.Random(2)
    vocabulary = [f"w{i}" for i in range(12)] + ["é", "straße", "a1"]
    long = [" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(10, 60))) for _ in range(12)]
    items = [*enumerate(long), (100, "three short words"), (101, "One"), (102, ""), (103, None), (104, "nine " * 9)]
    items += [(5, long[5]), (105, long[5]), (None, "just four words here")]
    texts = [None, "", "...", "ONE", "x three,short-WORDS y one", "nine " * 8, "nine " * 12, "just four words here"]
    for item in long:
        own = item.split()
        texts.append("start " + item.upper() + " end")
        texts.append(", ".join(own[:9]))
        texts.append("a b c " + "\n".join(own[-10:]) + " d three short words " + " ".join(own[:25]))
    texts += [" ".join(draw.choice(vocabulary) for _ in range(4000)), " ".join(long) * 30]
    got = by_id(decontamination_report(with_clashes(docs(spark, texts)), with_clashes(bench(spark, items))))
    for i, text in enumerate(texts):
        assert {k: v for k, v in got[i][0].items() if k != "doc_id"} == brute(text, items), (text or "")[:50]


def test_given_tables_agree_with_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    tables = [spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "benchmark")]
    assert difference(decontamination_report(*tables), con, ORACLE) is None


def test_repeats_null_ids_and_empty_tables(spark):
    text = "one two three four five six seven eight nine ten eleven"
    df = docs(spark, [text, text, text, "other"], ids=[1, 1, None, 1])
    items = bench(spark, [(1, text)])
    rows = decontamination_report(df, items).collect()
    assert sorted(r["n_hit"] for r in rows) == [0, 11, 11, 11]
    assert decontamination_report(df.limit(0), items).count() == 0
    assert [r["n_hit"] for r in decontamination_report(df, items.limit(0)).collect()] == [0] * 4


def test_workers_get_small_batches(spark, monkeypatch):
    seen, stored = {}, decontamination.stored

    def noting(df, name):
        seen[name] = spark.conf.get(BATCH_CONF)
        return stored(df, name)

    monkeypatch.setattr(decontamination, "stored", noting)
    text = "one two three four five six seven eight nine ten eleven"
    assert [r["n_hit"] for r in decontamination_report(docs(spark, [text]), bench(spark, [(1, text)])).collect()] == [11]
    workers = ("benchmark-windows", "benchmark-fps", "document-fps", "window-hits")
    assert [seen[name] for name in workers] == [str(BATCH_BYTES)] * 4


def test_memory_of_marking_is_bounded(spark):
    line = " ".join(f"word{i}" for i in range(250))
    columns = [pa.array(range(4000), pa.int64())] * 2 + [pa.array(range(4000), pa.int32()), pa.array([line] * 4000)]
    batch = pa.RecordBatch.from_arrays(columns, names=["id", "key", "key2", "text"])
    run = marking((3,))
    assert sum(out.num_rows for out in run(iter([batch]))) == 4000
    tracemalloc.start()
    try:
        for _ in run(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 4 * batch.nbytes, (peak, batch.nbytes)
