import math
import random
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[1]))
from cases import SF, with_clashes
from compare import difference

from marketlake.llm.exact_topk import ORACLE, exact_top_k, top_k_report

VECTORS = "vec_id bigint, embedding array<double>"
WIDE = (1 << 63) - 1


def brute(rows, k, scale=1024):
    """Rows in plain integers: every query against every row."""
    whole = [
        (i, [math.floor(x * scale) if abs(x) < 1e300 else int(x) * scale for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in whole:
        if q is None or q % 100:
            continue
        scores = [(sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q]
        scores = [(min(max(s, -WIDE - 1), WIDE), i) for s, i in scores]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(q, n, i, s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def found(spark, rows, k=10, **options):
    df = with_clashes(spark.createDataFrame(rows, VECTORS).repartition(3))
    got = exact_top_k(df, F.col("vec_id") % 100 == 0, k, **options)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def vectors(n, seed=1, width=9):
    rnd = random.Random(seed)
    return [(i, [rnd.choice((0.0, rnd.uniform(-1, 1), 0.5)) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 37, "block_queries": 2}])
def test_against_brute_force(spark, blocks):
    rows = vectors(430)
    assert found(spark, rows, **blocks) == brute(rows, 10)


def test_ties_copies_and_repeated_rows(spark):
    rows = [(i, [0.25, 0.5]) for i in range(1200)] + [(7, [0.25, 0.5])] * 20 + [(200, [0.1, 0.0])] * 2
    assert found(spark, rows, k=5) == brute(rows, 5)


def test_nulls_and_odd_vectors(spark):
    rows = [
        (0, [1.0, -1.0]), (1, None), (2, [None, 1.0]), (3, [math.nan, 1.0]), (4, [math.inf, 0.0]), (5, []), (None, [9.0]),
        (100, [0.5]), (6, [0.3, 0.2, 0.7]), (200, []), (300, None), (None, None), (-100, [0.0005, -0.0005]), (400, [0.0]),
    ]
    assert found(spark, rows) == brute(rows, 10)
    assert found(spark, rows, k=1) == brute(rows, 1)


def test_huge_components_stay_exact(spark):
    rows = [(0, [2.0**50, 3.0]), (1, [2.0**40, 1.0]), (2, [2.0**40, 1.001]), (3, [-1e308, 0.0]), (4, [1e305, 1.0])]
    assert found(spark, rows) == brute(rows, 10)


def test_few_rows_and_none(spark):
    assert found(spark, [(100, [1.0])]) == []
    assert found(spark, []) == []


def test_given_table_agrees_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    given = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert difference(top_k_report(given), con, ORACLE) is None
