"""Prefix trie of rebuilt conversations, from composable fingerprints of their turns.

A rebuilt conversation is the head of a base conversation followed by the own turns after its own head. Nothing is
rebuilt as text. A turn has a hash; a sequence of turns has the fingerprint P = sum of hash(i) * B ** (d - i) modulo a
prime, and sequences join as a monoid: P(xy) = P(x) * B ** |y| + P(y). One pass gives the prefix products of every
stored conversation. The product of a rebuilt prefix follows symbolically: with the base's head of m turns in place of
the own head of h turns, P = P_own(j) + (P_base(m) - P_own(h)) * B ** (j - h). So a rebuilt prefix is a row of numbers
and a reference to the stored turn it ends with, and prefixes with equal depth and product are a node.

Equality is verified, not assumed. Turns with one hash are compared with each other as they are stored (role and text),
and every node's prefixes must end with turns of one hash; level by level this makes the prefixes of a node equal turn by
turn. If two different turns or prefixes ever met, all is done again with other hashes and bases.

A node is known by its smallest member and its depth. The depths at which a conversation is the smallest member form a
chain, and the chains split the trie, so sums over a subtree are sums over its members of what their chains hold: no
walk from level to level, however deep the trie is. Conversations and nodes of any size are split: turns are numbered
and summed in sorted runs, members are counted before they are moved, and lists of ids are hashed as a stream of pieces.

Defined results: a NULL role or text reads as empty. Turns of one conversation are ordered by turn, NULL first, and
turns of one number by the SHA-256 of their role and text, so repeated turns stay. A conversation's base is ``c - c % 20``
with the remainder of SQL (toward zero for negative ids). Rows without a conversation id belong to no conversation and
take no part, as there is no id to rebuild by. An empty table has no nodes, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import SPACE_RUN, stored
from marketlake.llm.runs import PART, running_sums, sorted_runs

#: The modulus of every lane: products of two residues fit a long.
PRIME = (1 << 31) - 1
LANES = 3
WORD = r"[^\x20\x09-\x0D]+"
HEADS = 3
BASE_STEP = 20
#: Digits of an exponent, base 256: a conversation has fewer than 2 ** 32 turns.
DIGITS = 4
#: Ids of one piece of a member list.
PIECE = 4096
ATTEMPTS = 8

PRODUCT = [f"p{k}" for k in range(LANES)]
HASH = [f"t{k}" for k in range(LANES)]
NODE = ["depth", *PRODUCT]
DIGEST = f"depth bigint, {', '.join(f'{p} bigint' for p in PRODUCT)}, ends_sha256 string"


class Bases:
    """A base for each lane, its inverse, and a seed for the turn hashes, all from the number of the attempt."""

    def __init__(self, attempt: int):
        rnd = random.Random(attempt)
        self.seed = attempt
        self.bases = [rnd.randrange(1 << 20, PRIME - 1) for _ in range(LANES)]
        self.inverses = [pow(b, -1, PRIME) for b in self.bases]


def power(base: int, exponent: Column) -> Column:
    """``base ** exponent`` modulo the prime, from tables of the powers of each digit of the exponent."""
    out = F.lit(1).cast("bigint")
    for place in range(DIGITS):
        step = pow(base, 256**place, PRIME)
        # One literal, folded to an array when the plan is made.
        table = F.split(F.lit(",".join(str(pow(step, digit, PRIME)) for digit in range(256))), ",").cast("array<bigint>")
        out = out * F.get(table, F.shiftright(exponent, 8 * place).bitwiseAND(255).cast("int")) % PRIME
    return out


def words(text: Column) -> Column:
    """Words between runs of space."""
    parts = F.split(text, SPACE_RUN)
    return F.size(F.filter(parts, lambda p: p != "")).cast("bigint")


def contents(conversations: DataFrame) -> tuple[Column, Column]:
    return F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))


def turn_hashes(role: Column, text: Column, seed: int) -> list[Column]:
    """A residue for each lane, from 128 bits of hash."""
    a = F.xxhash64(F.lit(seed), role, text)
    b = F.xxhash64(F.lit(~seed), text, role)
    mask = (1 << 31) - 1
    lanes = (a, F.shiftrightunsigned(a, 31), b)
    return [(v.bitwiseAND(mask) % PRIME).alias(n) for v, n in zip(lanes, HASH, strict=True)]


def stored_turns(conversations: DataFrame, key: str, seed: int) -> DataFrame:
    """One row per turn, without its text: order, hashes, words."""
    role, text = contents(conversations)
    tie = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("conv"),
        F.col("turn").alias("turn"),
        tie.alias("tie"),
        words(text).alias("words"),
        *turn_hashes(role, text, seed),
    )


def same_contents(conversations: DataFrame, key: str, seed: int) -> bool:
    """Whether turns of one hash are the same turn: smallest and largest (role, text) of each must agree."""
    role, text = contents(conversations)
    turns = conversations.where(F.col(key).isNotNull()).select(
        *turn_hashes(role, text, seed), F.struct(role.alias("role"), text.alias("text")).alias("turn")
    )
    ends = turns.groupBy(*HASH).agg(F.min("turn").alias("a"), F.max("turn").alias("b"))
    return ends.where(F.col("a") != F.col("b")).isEmpty()


def prefix_products(turns: DataFrame, bases: Bases) -> DataFrame:
    """(conv, at, n, products of the first ``at`` turns, hash and words of turn ``at``) of every stored turn."""
    order = [F.col("turn").asc_nulls_first(), F.col("tie").asc()]
    runs = sorted_runs(turns, ["conv"], order, "trie-turns")
    placed = stored(running_sums(runs, ["conv"], order, {"at": F.lit(1)}, {"n": "at"}), "trie-placed")
    # Divided by its power of the base, a turn's share of the product is the same in every longer prefix: a plain sum.
    shares = {
        p: F.col(t) * power(inverse, F.col("at")) % PRIME
        for p, t, inverse in zip(PRODUCT, HASH, bases.inverses, strict=True)
    }
    summed = running_sums(placed, ["conv"], [F.col("at").asc()], shares)
    products = {p: F.col(p) % PRIME * power(b, F.col("at")) % PRIME for p, b in zip(PRODUCT, bases.bases, strict=True)}
    return stored(summed.withColumns(products).select("conv", PART, "at", "n", "words", *PRODUCT, *HASH), "trie-products")


def head_size(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % (HEADS + 1)


def recipes(products: DataFrame) -> DataFrame:
    """How each conversation is rebuilt: head size, the base's head turns, products to take away and to put in place."""
    turn = F.struct("at", "words", *PRODUCT, *HASH)
    heads = products.groupBy("conv").agg(
        F.max("at").alias("n"),
        *[F.max(F.when(F.col("at") == i, turn)).alias(f"head{i}") for i in range(1, HEADS + 1)],
    )
    listed = F.array_compact(F.array(*[F.col(f"head{i}") for i in range(1, HEADS + 1)]))
    heads = heads.select("conv", "n", listed.alias("own"))
    base = heads.select(F.col("conv").alias("base"), F.col("own").alias("other"))
    found = heads.withColumn("base", F.col("conv") - F.col("conv") % BASE_STEP).join(base, "base", "left")
    found = found.withColumn("h", head_size(F.col("conv")).cast("int"))
    none = F.array().cast(heads.schema["own"].dataType)
    found = found.withColumn("head", F.slice(F.coalesce("other", none), F.lit(1), F.col("h")))

    def product(turns: str, size: Column, lane: str) -> Column:
        return F.coalesce(F.get(F.col(turns), size - 1)[lane], F.lit(0))

    m = F.size("head")
    # What the own head counted for, and what the base's head counts for in its place.
    change = [
        F.pmod(product("head", m, p) - product("own", F.col("h"), p), F.lit(PRIME)).alias(f"d{p}") for p in PRODUCT
    ]
    return found.select(
        "conv", "h", "head", m.alias("m"), *change, (m + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")
    )


def prefixes(products: DataFrame, bases: Bases) -> DataFrame:
    """Every prefix of every rebuilt conversation: (conv, node, hash and words of its last turn, whether it ends it)."""
    plan = stored(recipes(products), "trie-recipes")
    last = ["words", *HASH]
    root = plan.select(
        "conv", F.lit(-1).alias(PART), F.lit(0).cast("bigint").alias("depth"),
        *[F.lit(0).cast("bigint").alias(c) for c in (*PRODUCT, *last)], "length",
    )
    taken = plan.select("conv", "length", F.explode("head").alias("t"))
    taken = taken.select(
        "conv", F.lit(-1).alias(PART), F.col("t.at").alias("depth"), *[F.col(f"t.{c}") for c in (*PRODUCT, *last)], "length"
    )
    # A recipe goes to every partition that holds turns of its conversation, so a long one is not one task's.
    spans = products.groupBy("conv", PART).agg(F.lit(1).alias("one")).drop("one")
    own = products.select("conv", PART, "at", *PRODUCT, *last).join(
        spans.join(plan.drop("head"), "conv"), ["conv", PART]
    ).where(F.col("at") > F.col("h"))
    beyond = F.col("at") - F.col("h")
    moved = [
        ((F.col(p) + F.col(f"d{p}") * power(b, beyond)) % PRIME).alias(p) for p, b in zip(PRODUCT, bases.bases, strict=True)
    ]
    own = own.select("conv", PART, (beyond + F.col("m")).alias("depth"), *moved, *last, "length")
    every = root.unionByName(taken).unionByName(own)
    ends = (F.col("depth") == F.col("length")).alias("ends")
    return stored(every.select("conv", PART, *NODE, *last, ends), "trie-prefixes")


def parent_of(bases: Bases) -> list[Column]:
    """The node above: the last turn taken back out of the product."""
    product = [
        (F.pmod(F.col(p) - F.col(t), F.lit(PRIME)) * inverse % PRIME).alias(p)
        for p, t, inverse in zip(PRODUCT, HASH, bases.inverses, strict=True)
    ]
    return [(F.col("depth") - 1).alias("depth"), *product]


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): the SHA-256 of each node's ids in ``conv``, ascending and joined by commas.

    Ids are sorted in runs and joined in pieces of bounded size; a node's pieces then pass through its digest one after
    the other, as a digest can only be taken in order.
    """
    runs = sorted_runs(ends.select(*NODE, "conv"), NODE, [F.col("conv").asc()], "trie-ends")
    placed = running_sums(runs, NODE, [F.col("conv").asc()], {"place": F.lit(1)})
    piece = F.floor((F.col("place") - 1) / PIECE).alias("piece")
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    pieces = placed.groupBy(*NODE, piece).agg(F.array_join(ids, ",").alias("ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*NODE, "ends_sha256"]
        node, state, done = None, None, []

        def flush():
            columns = list(zip(*done, strict=True)) if done else [[] for _ in names]
            kinds = [pa.int64()] * len(NODE) + [pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for *key, ids in zip(*columns, strict=True):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            yield flush()
            done = []
        if node is not None:
            done.append((*node, state.hexdigest()))
        yield flush()

    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece")
    return ordered.select(*NODE, "ids").mapInArrow(digests, DIGEST)


def nodes_of(steps: DataFrame) -> DataFrame:
    return stored(
        steps.groupBy(*NODE).agg(
            F.min("conv").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("words").alias("words"),
            *[F.min(t).alias(t) for t in HASH],
            *[F.max(t).alias(f"max_{t}") for t in HASH],
        ),
        "trie-nodes",
    )


def conversation_trie(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """The nodes of the trie; ``saved_tokens`` counts the words that storing shared prefixes once would save."""
    for attempt in range(ATTEMPTS):
        bases = Bases(attempt)
        if not same_contents(conversations, key, bases.seed):
            continue
        products = prefix_products(stored(stored_turns(conversations, key, bases.seed), "trie-hashes"), bases)
        steps = prefixes(products, bases)
        nodes = nodes_of(steps)
        if nodes.where(reduce(lambda a, b: a | b, [F.col(t) != F.col(f"max_{t}") for t in HASH])).isEmpty():
            return _measured(steps, nodes, bases)
    raise RuntimeError("different prefixes met under every base")


def _measured(steps: DataFrame, nodes: DataFrame, bases: Bases) -> DataFrame:
    own = F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("words")).otherwise(0)
    chain = nodes.select(F.col("conv_id").alias("conv"), *NODE, own.alias("own"))
    order = [F.col("depth").asc()]
    runs = sorted_runs(chain, ["conv"], order, "trie-chains")
    summed = stored(
        running_sums(runs, ["conv"], order, {"so_far": F.col("own")}, {"all": "so_far"}), "trie-sums"
    )
    children = nodes.where("depth > 0").select(*parent_of(bases)).groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    # A chain's last node is a leaf unless another chain hangs below it.
    chains = summed.groupBy("conv").agg(F.min("depth").alias("top"), F.max("depth").alias("last"), F.max("all").alias("all"))
    tips = summed.select("conv", *NODE).join(chains, "conv").where(F.col("depth") == F.col("last"))
    tips = tips.join(children, NODE, "left").select("conv", "top", "all", F.col("n_children").isNull().alias("leaf"))
    # Whole chains below a node are those of its members that are not its smallest.
    spans = steps.select("conv", PART).distinct().join(tips, "conv")
    below = steps.select("conv", PART, *NODE).join(spans, ["conv", PART]).groupBy(*NODE).agg(
        F.sum(F.when(F.col("depth") < F.col("top"), F.col("all")).otherwise(0)).alias("below"),
        F.count_if("leaf").alias("n_leaves"),
    )
    suffix = summed.select(*NODE, (F.col("all") - F.col("so_far") + F.col("own")).alias("suffix"))
    digests = end_digests(steps.where("ends"))
    # The smallest member of the node above; inside a chain it is the chain's own.
    tops = summed.join(chains.select("conv", "top"), "conv").where("depth = top and depth > 0").select("conv")
    heads = nodes.where("depth > 0").join(tops.withColumnRenamed("conv", "conv_id"), "conv_id")
    heads = heads.join(chains.select(F.col("conv").alias("conv_id"), "top"), "conv_id").where("depth = top")
    above = nodes.select(*NODE, F.col("conv_id").alias("parent"))
    parents = heads.select(*[F.col(c).alias(f"own_{c}") for c in NODE], *parent_of(bases)).join(above, NODE)
    parents = parents.select(*[F.col(f"own_{c}").alias(c) for c in NODE], "parent")

    facts = {"conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint", "below": "bigint"}
    facts |= {"suffix": "bigint", "ends_sha256": "string", "parent": "bigint"}
    tables = (nodes, children, below, suffix, digests, parents)
    rows = [
        t.select(*NODE, *[(F.col(c) if c in t.columns else F.lit(None)).cast(k).alias(c) for c, k in facts.items()])
        for t in tables
    ]
    joined = reduce(DataFrame.unionByName, rows).groupBy(*NODE).agg(*[F.max(c).alias(c) for c in facts])
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0).cast("bigint")).alias("n_children"),
        "n_leaves",
        (F.col("below") + F.col("suffix")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


ORACLE = """
WITH crc_table AS (
  WITH RECURSIVE bits(i, k, v) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8)
  SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
  SELECT c, c - c % 20 AS base,
    xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(range(1, length(CAST(c AS VARCHAR)) + 1),
        lambda i: ascii(substr(CAST(c AS VARCHAR), i, 1))::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM turns), crc_table),
parts AS (
  SELECT heads.c, 0 AS part, i, role, text FROM heads JOIN turns ON turns.c = heads.base AND i <= h
  UNION ALL SELECT heads.c, 1, i, role, text FROM heads JOIN turns ON turns.c = heads.c AND i > h),
whole AS (
  SELECT heads.c, coalesce(w, []) AS w FROM heads LEFT JOIN (
    SELECT c, list({'role': role, 'text': text} ORDER BY part, i) AS w FROM parts GROUP BY c) USING (c)),
steps AS (
  SELECT c, unnest(range(0, len(w) + 1)) AS depth, w FROM whole),
prefixes AS (
  SELECT c, depth, sha256(CAST(to_json(list_slice(w, 1, depth)) AS VARCHAR)) AS node, depth = len(w) AS ends,
    CASE WHEN depth > 0 THEN sha256(CAST(to_json(list_slice(w, 1, depth - 1)) AS VARCHAR)) END AS parent,
    CASE WHEN depth > 0 THEN len(regexp_extract_all(w[depth].text, '[^ \\x09-\\x0D]+')) ELSE 0 END AS words
  FROM steps),
nodes AS (
  SELECT depth, node, min(c) AS conv_id, count(*) AS n_convs, any_value(parent) AS parent, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
under AS (
  SELECT a.node, n.node AS below FROM nodes n
  JOIN prefixes e ON e.c = n.conv_id AND e.depth <= n.depth JOIN nodes a ON a.node = e.node AND a.depth = e.depth),
sums AS (
  SELECT under.node, CAST(sum(CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * n.words ELSE 0 END) AS BIGINT) AS saved_tokens,
    count(*) FILTER (WHERE children.n_children IS NULL) AS n_leaves
  FROM under JOIN nodes n ON n.node = under.below LEFT JOIN children ON children.node = under.below GROUP BY under.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs,
  coalesce(children.n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (node) LEFT JOIN children USING (node) LEFT JOIN nodes p ON p.node = n.parent
"""
