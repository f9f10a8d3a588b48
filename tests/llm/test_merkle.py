import hashlib
import random
import sys
import zlib
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[1]))
from cases import DOCS, SF, with_clashes
from compare import difference

from marketlake.llm.merkle import ORACLE, merkle_report
from marketlake.llm.runs import running_sums, sorted_runs


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    parts = []
    for value in (row[0], row[3], row[2], row[4], row[1]):
        parts.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return sha("".join(parts))


def tree(nodes):
    """Levels of a tree, from the given nodes to the one on top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def path(levels, at):
    found = []
    for nodes in levels[:-1]:
        first = at // 8 * 8
        found.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 8])))
        at //= 8
    return found


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) by plain recursion."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row, leaf(row)))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0][0] is not None, r[0][0] or 0, r[1]))
    trees = {lang: tree([digest for _, digest in groups[lang]]) for lang in langs}
    over = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for j, lang in enumerate(langs):
        for i, (row, digest) in enumerate(groups[lang]):
            steps = path(trees[lang], i) + path(over, j)
            node = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                lowered = None if row[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1])
                node = leaf((row[0], lowered, *row[2:]))
            for a, b in steps:
                node = sha(a + node + b)
            proof = sha("".join(a + b for a, b in steps))
            out.append((row[0], digest, trees[lang][-1][0], over[-1][0], proof, node, node == over[-1][0]))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    got = merkle_report(with_clashes(spark.createDataFrame(rows, DOCS).repartition(3)), **options)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def made(n, seed=3):
    rnd = random.Random(seed)
    langs = ["en"] * 6 + ["de", "fr", None, "é", "en-GB"]
    texts = ["Hello World", "", None, "lower only", "ÀÉ x", "Y" * 40]
    return [(i * 7 - 50, rnd.choice(texts), rnd.choice(langs), rnd.choice(["s", None]), rnd.choice([1, None])) for i in range(n)]


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_against_recursion(spark, levels):
    rows = made(700)
    assert found(spark, rows, levels=levels) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513])
def test_sizes_of_one_group(spark, n):
    rows = [(i, f"T{i}", "en", "s", 1) for i in range(n)]
    assert found(spark, rows) == brute(rows)


def test_repeated_rows_null_ids_and_many_groups(spark):
    rows = [(5, "Same", "en", "s", 4)] * 40 + [(None, "x", "en", "s", 1), (None, None, None, None, None)]
    rows += [(5, "Other", "en", "s", 5), (6, "A" * 100_000, "de", "s", 6)]
    rows += [(i, "t", f"l{i}", "s", 1) for i in range(100, 180)]
    assert found(spark, rows, levels=1) == brute(rows)


def test_lone_leaves_and_empty(spark):
    rows = [(3, "Abc", "en", "s", 3)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows + [(4, "D", "de", "s", 1)]) == brute(rows + [(4, "D", "de", "s", 1)])
    assert found(spark, []) == []


def test_given_table_agrees_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    given = spark.read.parquet(f"{SF}/documents.parquet")
    assert difference(merkle_report(given), con, ORACLE) is None


@pytest.fixture
def many_parts(spark):
    """Small partitions stay apart, so that a small key spans several."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_group_over_many_partitions(spark, many_parts):
    rows = [*made(700), *[(5, "Same", "en", "s", 4)] * 300]
    assert found(spark, rows) == brute(rows)


def test_running_sums_of_a_hot_key(spark, many_parts):
    rows = spark.range(5000).select(
        F.when(F.col("id") < 4000, F.lit(1)).otherwise(F.col("id") % 50).alias("key"),
        F.when(F.col("id") < 3000, F.lit(0)).otherwise(F.col("id")).alias("at"),
    )
    runs = sorted_runs(rows, ["key"], [F.col("at").asc()], "runs")
    assert runs.where("key = 1").select("_part").distinct().count() > 1
    got = running_sums(runs, ["key"], [F.col("at").asc()], {"n": F.lit(1)}, {"total": "n"}).collect()
    for key in {r["key"] for r in got}:
        mine = sorted((r["at"], r["n"], r["total"]) for r in got if r["key"] == key)
        assert [n for _, n, _ in mine] == list(range(1, len(mine) + 1))
        assert {t for *_, t in mine} == {len(mine)}
