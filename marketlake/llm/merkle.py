"""Merkle manifest of a dataset: an eight-ary tree of digests for each group, and one over the groups' roots.

Leaves are hashed where their rows lie; only digests are sorted and moved. A superblock is ``8 ** LEVELS`` consecutive
nodes. On the way up each superblock is reduced to its top, and the tops are the nodes of the next round, until every
group has one node. On the way down the exchange is cogrouped: the nodes of a superblock meet the siblings that their
paths need outside of it, redo the local reduction and hand joined paths to the next round below. The last round meets
the leaves, joins their proofs and folds them to the root. A task holds superblocks only, whatever a group's size.

Defined results: a NULL field is hashed as ``-``, any other as its length in bytes, ``:`` and its text, so an empty text
differs from a NULL. Rows of a group are ordered by id, NULL ids first, and rows of one id by their leaf; repeated rows
are leaves of their own. The NULL group comes first, the others in byte order. Rows without an id are never tampered
with. Other columns are ignored. An empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import stored
from marketlake.llm.runs import running_sums, sorted_runs

ARITY, SHIFT = 8, 3
#: Levels inside a superblock.
LEVELS = 3
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NODE = "tree string, idx bigint, n bigint, digest string"
PATH = "tree string, idx bigint, lefts array<string>, rights array<string>, subroot string, root string"
PROVEN = (
    "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels until ``n`` nodes are one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def climb(digests: list[str], levels: int) -> tuple[list[list[str]], str]:
    """The runs of siblings of each level, joined, and the node on top."""
    runs = []
    for _ in range(levels):
        runs.append(["".join(digests[i : i + ARITY]) for i in range(0, len(digests), ARITY)])
        digests = [digest_of(run) for run in runs[-1]]
    return runs, digests[0]


def siblings(runs: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What lies left and right of node ``at`` in its run, and of its ancestors in theirs."""
    path = []
    for level in runs:
        run, place = level[at // ARITY], (at % ARITY) * HEX
        path.append((run[:place], run[place + HEX :]))
        at //= ARITY
    return path


def block_of(nodes: pd.DataFrame, levels: int) -> tuple[pd.DataFrame, list[list[str]], str]:
    """Nodes of one superblock in order, its runs and its top."""
    nodes = nodes.sort_values("idx", kind="stable")
    runs, top = climb(nodes["digest"].tolist(), min(levels, height(int(nodes["n"].iloc[0]))))
    return nodes, runs, top


def block_column(levels: int) -> Column:
    return F.shiftright("idx", SHIFT * levels).alias("block")


def tops(nodes: DataFrame, levels: int) -> DataFrame:
    """Superblocks reduced to their tops, which are the nodes of the next round."""

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        first = block.iloc[0]
        above = -(-int(first["n"]) // ARITY**levels)
        at = int(first["idx"]) >> (SHIFT * levels)
        return pd.DataFrame({"tree": [first["tree"]], "idx": [at], "n": [above], "digest": [block_of(block, levels)[2]]})

    return nodes.select("tree", "idx", "n", "digest").groupBy("tree", block_column(levels)).applyInPandas(reduce, NODE)


def rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes of every round from the leaves up; the last has one node for each tree."""
    found = [nodes]
    while (found[-1].agg(F.max("n")).first()[0] or 0) > 1:
        found.append(stored(tops(found[-1], levels), "merkle-tops"))
    return found


def down(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """Paths of ``nodes``: siblings inside their superblock, then the path of the superblock's top."""

    def join(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, runs, _ = block_of(block, levels)
        top, start = above.iloc[0], (int(block["idx"].iloc[0]) >> (SHIFT * levels)) << (SHIFT * levels)
        paths = [siblings(runs, int(i) - start) for i in block["idx"]]
        return pd.DataFrame(
            {
                "tree": block["tree"].tolist(),
                "idx": block["idx"].tolist(),
                "lefts": [[a for a, _ in p] + list(top["lefts"]) for p in paths],
                "rights": [[b for _, b in p] + list(top["rights"]) for p in paths],
                "subroot": top["subroot"],
                "root": top["root"],
            }
        )

    by_block = nodes.select("tree", "idx", "n", "digest").groupBy("tree", block_column(levels))
    return by_block.cogroup(outer.groupBy("tree", F.col("idx").alias("block"))).applyInPandas(join, PATH)


def prove(block: pd.DataFrame, above: pd.DataFrame, levels: int) -> pd.DataFrame:
    """Proof and folded root of every leaf of one superblock."""
    block, runs, _ = block_of(block, levels)
    top, start = above.iloc[0], (int(block["idx"].iloc[0]) >> (SHIFT * levels)) << (SHIFT * levels)
    outer = list(zip(top["lefts"], top["rights"], strict=True))
    out_of_block = "".join(a + b for a, b in outer)
    proofs, folded = [], []
    for i, leaf, other in zip(block["idx"], block["digest"], block["other"], strict=True):
        path = siblings(runs, int(i) - start)
        proofs.append(digest_of("".join(a + b for a, b in path) + out_of_block))
        node = leaf if other is None else other
        for left, right in path + outer:
            node = digest_of(left + node + right)
        folded.append(node)
    return pd.DataFrame(
        {
            "id": block["id"].tolist(),
            "leaf": block["digest"].tolist(),
            "subroot": top["subroot"],
            "root": top["root"],
            "proof_sha256": proofs,
            "folded_root": folded,
            "verified": [node == top["root"] for node in folded],
        }
    )


def framed(value: Column) -> Column:
    """Length in bytes and value, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[framed(v) for v in values]), 256)


def numbered(rows: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``idx`` from 0 inside each tree, and ``n``, the tree's nodes."""
    runs = sorted_runs(rows, keys, order, name)
    placed = running_sums(runs, keys, order, {"idx": F.lit(1)}, {"n": "idx"})
    return placed.withColumn("idx", F.col("idx") - 1)


def subroot_paths(subroots: DataFrame, levels: int) -> DataFrame:
    """The tree over the groups' roots: for each group the path from its root to the root of all."""
    listed = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    listed = stored(numbered(listed, ["tree"], [F.col("group").asc()], "merkle-groups"), "merkle-subroots")
    levels_up = rounds(listed.select("tree", "idx", "n", "digest"), levels)
    none = F.array().cast("array<string>")
    paths = levels_up[-1].select(
        "tree", "idx", none.alias("lefts"), none.alias("rights"), F.lit("").alias("subroot"), F.col("digest").alias("root")
    )
    for nodes in reversed(levels_up[:-1]):
        paths = stored(down(nodes, paths, levels), "merkle-paths")
    found = listed.select("idx", "group", "digest").join(paths.select("idx", "lefts", "rights", "root"), "idx")
    return found.select(
        F.col("group").alias("tree"), F.lit(0).cast("bigint").alias("idx"), "lefts", "rights",
        F.col("digest").alias("subroot"), "root",
    )


def manifest(
    rows: DataFrame, leaf: Column, other: Column, group: str = "lang", id_col: str = "doc_id", levels: int = LEVELS
) -> DataFrame:
    """Leaf, subroot, root and proof of every row; ``other`` is the leaf to fold in its place, or NULL for its own."""
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # NULL first, then by bytes
    leaves = rows.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf.alias("digest"), other.alias("other"))
    order = [F.col("id").asc_nulls_first(), F.col("digest").asc()]
    placed = stored(numbered(stored(leaves, "merkle-leaves"), ["tree"], order, "merkle-runs"), "merkle-numbered")
    up = rounds(placed, levels)
    paths = subroot_paths(up[-1], levels)
    for nodes in reversed(up[1:-1]):
        paths = stored(down(nodes, paths, levels), "merkle-paths")
    if len(up) == 1:  # every group is a lone leaf
        paths = paths.withColumn("idx", F.lit(0).cast("bigint"))
    given = placed.select("tree", "idx", "n", "digest", "other", F.col("id").cast("string").alias("id"))
    proven = given.groupBy("tree", block_column(levels)).cogroup(
        paths.groupBy("tree", F.col("idx").alias("block"))
    ).applyInPandas(lambda block, above: prove(block, above, levels), PROVEN)
    kind = rows.schema[id_col].dataType
    return proven.select(F.col("id").cast(kind).alias(id_col), *[c for c in proven.columns if c != "id"])


def merkle_report(documents: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``documents`` by language; every row whose id's CRC-32 is divisible by 3 is lower-cased first."""
    fields = [F.col(c) for c in FIELDS]
    lowered = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(documents, row_digest(fields), F.when(tampered, row_digest(lowered)), levels=levels)


def _oracle(levels: int = 8, group_levels: int = 4) -> str:
    """SQL of the same tables, one step for each level (``8 ** levels`` rows of a group at most)."""

    def framed_sql(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"

    def row(text: str) -> str:
        return "sha256(" + " || ".join(framed_sql(text if c == "text" else c) for c in FIELDS) + ")"

    steps = [f"""crc_table AS (
  WITH RECURSIVE bits(i, k, v) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8)
  SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8)""", f"""leaves AS (
  SELECT *, row_number() OVER () AS pos, {row('text')} AS leaf,
    xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
        lambda i: ascii(substr(CAST(doc_id AS VARCHAR), i, 1))::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, crc_table)""", f"""n0 AS (
  SELECT pos, doc_id, leaf, coalesce('=' || lang, '') AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h,
    CASE WHEN crc % 3 = 0 THEN {row(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE leaf END AS fold, '' AS proof
  FROM leaves)""", "p0 AS (SELECT * FROM n0)"]

    def level(nodes: str, up: str, paths: str, out: str) -> list[str]:
        return [f"""g{up} AS (
  SELECT tree, i // 8 AS i, string_agg(h, '' ORDER BY i) AS run, max(c) = 1 AS done
  FROM (SELECT tree, i, h, count(*) OVER (PARTITION BY tree) AS c FROM {nodes}) GROUP BY tree, i // 8)""",
            f"{up} AS (SELECT tree, i, CASE WHEN done THEN run ELSE sha256(run) END AS h FROM g{up})",
            f"""{out} AS (
  SELECT p.* REPLACE (
    p.i // 8 AS i,
    CASE WHEN done THEN fold
      ELSE sha256(substr(run, 1, 64 * (p.i % 8)) || fold || substr(run, 64 * (p.i % 8) + 65)) END AS fold,
    CASE WHEN done THEN proof
      ELSE proof || substr(run, 1, 64 * (p.i % 8)) || substr(run, 64 * (p.i % 8) + 65) END AS proof)
  FROM {paths} p JOIN g{up} g ON g.tree = p.tree AND g.i = p.i // 8)"""]

    for k in range(1, levels + 1):
        steps += level(f"n{k - 1}", f"n{k}", f"p{k - 1}", f"p{k}")
    steps += [
        f"m0 AS (SELECT '' AS tree, tree AS sub, row_number() OVER (ORDER BY tree) - 1 AS i, h FROM n{levels})",
        f"""q0 AS (SELECT p.* REPLACE (m.tree AS tree, m.i AS i), m.h AS subroot
  FROM p{levels} p JOIN m0 m ON m.sub = p.tree)""",
    ]
    for k in range(1, group_levels + 1):
        steps += level(f"m{k - 1}", f"m{k}", f"q{k - 1}", f"q{k}")
    last = group_levels
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, subroot, m.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = m.h AS verified
FROM q{last} JOIN m{last} m ON true
"""


ORACLE = _oracle()
