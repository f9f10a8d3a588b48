"""Exact top-k search by inner product over scaled integer vectors.

Every component x counts as ``floor(scale * x)``; a vector is the sparse row of its non-zero components. The rows are
dealt into blocks, and each block is turned into postings: for every term (position) the ordinals and weights of the
rows that have it. A query is evaluated term at a time: each of its non-zero terms adds its weight times the posting's
weights to a dense array of scores, one for each row of the block. The best ``k`` of a block come from a partition
selection of that array, and the blocks' selections are merged by query. Nothing is skipped or approximated.

Queries and rows meet in a grid of cells (block of rows, block of queries), so a task holds one block of either kind
at a time, however many there are. The work is queries times rows by definition; it is spread over the cells.

Defined results: vectors that are NULL or hold a NULL or a non-finite component take no part; an empty vector takes
part with score 0; components missing in the shorter of two vectors count as 0. A query does not meet rows of its own
id. Repeated rows are rows of their own, as candidates and as queries. Ties go to the smaller id, rows without an id
last; a row without an id is no query unless ``is_query`` holds for it, and then meets every row that has an id. Scores
are exact integers, cut at the ends of the range of a long. Other columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import stored

SCALE = 1024
#: Rows of a block, at most; and queries of a block. One cell holds both.
BLOCK_ROWS, BLOCK_QUERIES = 1 << 18, 1 << 18
#: Rows of a block where there are fewer rows than the cluster could share.
SMALL_BLOCK = 512
#: Scores held at once: queries of a slice times rows of a block.
SCORES = 1 << 17
#: Integers up to here are exact as doubles.
EXACT = 2.0**53
LONG = (-(1 << 63), (1 << 63) - 1)

FOUND = "number bigint, query_id bigint, vec_id bigint, score bigint"
_SCHEMA = pa.schema([("number", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``: as doubles while those are exact, as Python integers beyond."""
    if not len(values) or np.abs(values).max() * scale < EXACT:
        return np.floor(values * scale)
    # A huge double is a whole number, and may overflow when scaled.
    whole = [math.floor(x * scale) if abs(x) < 1e300 else int(x) * scale for x in values.tolist()]
    return np.array(whole, dtype=object)


class Sparse:
    """The non-zero components of a table's vectors, by term and then by row; rows in order of their ids."""

    def __init__(self, ids: pa.ChunkedArray, vectors: pa.ChunkedArray, scale: int):
        self.n = len(ids)
        known = ids.is_valid().to_numpy()
        plain = ids.fill_null(0).to_numpy()
        order = np.lexsort((plain, ~known))
        self.ids, self.known = plain[order], int(known.sum())
        self.order = order
        place = np.empty(self.n, np.int64)
        place[order] = np.arange(self.n)

        sizes = pc.list_value_length(vectors).to_numpy().astype(np.int64)
        weights = scaled(pc.list_flatten(vectors).cast(pa.float64()).to_numpy(), scale)
        rows = np.repeat(place, sizes)
        terms = np.arange(len(weights)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        used = np.flatnonzero(weights != 0)
        used = used[np.argsort(terms[used] * self.n + rows[used], kind="stable")]
        self.rows, self.weights = rows[used], weights[used]
        self.terms, starts = np.unique(terms[used], return_index=True)
        self.ends = np.append(starts, len(used))

    def largest(self) -> float:
        """Size of the largest weight; infinite where weights are no doubles any more."""
        if self.weights.dtype == object:
            return math.inf
        return float(np.abs(self.weights).max()) if len(self.weights) else 0.0

    def postings(self) -> dict[int, tuple[np.ndarray | None, np.ndarray]]:
        """Term to (rows, weights). A posting of more than half of the rows is laid out over all, with rows None."""
        found = {}
        for term, a, b in zip(self.terms.tolist(), self.ends[:-1], self.ends[1:], strict=True):
            rows, weights = self.rows[a:b], self.weights[a:b]
            if 2 * len(rows) > self.n:
                spread = np.zeros(self.n, weights.dtype)
                spread[rows] = weights
                rows, weights = None, spread
            found[term] = rows, weights
        return found

    def with_id(self, value) -> slice:
        """The rows of one id."""
        a, b = np.searchsorted(self.ids[: self.known], [value, value + 1])
        return slice(int(a), int(b))


def scatter(postings: dict, asked: dict, start: int, stop: int, n: int, kind) -> np.ndarray:
    """Scores of the queries ``start`` to ``stop``: one term after the other, each adding its weighted posting."""
    scores = np.zeros((stop - start, n), kind)
    for term in asked.keys() & postings.keys():
        queries, weights = asked[term]
        rows, values = postings[term]
        if queries is None:
            queries, weights = slice(None), weights[start:stop]
        else:
            a, b = np.searchsorted(queries, [start, stop])
            if a == b:
                continue
            queries, weights = queries[a:b] - start, weights[a:b]
        added = weights[:, None] * values
        if rows is None:
            scores[queries] += added
        elif isinstance(queries, slice):
            scores[:, rows] += added
        else:
            scores[np.ix_(queries, rows)] += added
    return scores


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Ordinals of the ``k`` largest scores of one query, ties to the smaller ordinal; no order among them."""
    n = len(scores)
    if n <= k:
        return np.arange(n)
    least = sorted(scores)[n - k] if scores.dtype == object else np.partition(scores, n - k)[n - k]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])


def search_cell(queries: pa.Table, rows: pa.Table, k: int, scale: int) -> pa.Table:
    """The best ``k`` rows of one block for every query of one block."""
    if not queries.num_rows or not rows.num_rows:
        return _SCHEMA.empty_table()
    block = Sparse(rows["id"], rows["vector"], scale)
    asked = Sparse(queries["id"], queries["vector"], scale)
    numbers = queries["number"].to_numpy()[asked.order]
    postings, terms = block.postings(), asked.postings()
    sizes = block.largest(), asked.largest()
    exact = math.inf not in sizes and sizes[0] * sizes[1] * max(1, len(terms)) < EXACT
    kind = np.float64 if exact else object
    if not exact:
        postings = {t: (r, np.array([int(w) for w in v], object)) for t, (r, v) in postings.items()}
        terms = {t: (r, np.array([int(w) for w in v], object)) for t, (r, v) in terms.items()}

    out: list[list] = [[], [], [], []]
    step = max(1, SCORES // block.n)
    for start in range(0, asked.n, step):
        stop = min(start + step, asked.n)
        scores = scatter(postings, terms, start, stop, block.n, kind)
        for number in range(start, stop):
            row = scores[number - start]
            query = asked.ids[number] if number < asked.known else None
            row[slice(block.known, block.n) if query is None else block.with_id(query)] = -math.inf
            chosen = best(row, k)
            chosen = chosen[row[chosen] != -math.inf]
            out[0] += [numbers[number]] * len(chosen)
            out[1] += [query] * len(chosen)
            out[2] += [block.ids[i] if i < block.known else None for i in chosen]
            out[3] += [min(max(int(s), LONG[0]), LONG[1]) for s in row[chosen]]
    return pa.table([pa.array(c, pa.int64()) for c in out], schema=_SCHEMA)


def usable(vector: Column) -> Column:
    """Not NULL, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def dealt(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """Rows spread evenly over ``blocks``, copies too: the block follows from the row's place in the stored table."""
    place = F.monotonically_increasing_id()
    return rows.withColumn(name, F.pmod(F.xxhash64(place), F.lit(blocks)).cast("int"))


def exact_top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for every row that is a query, exactly."""
    spark = rows.sparkSession
    # Single precision is kept as it is: every value has the same double.
    single = rows.schema[vector_col].dataType.simpleString() == "array<float>"
    own = rows.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.col(vector_col).cast("array<float>" if single else "array<double>").alias("vector"),
    ).where(usable(F.col("vector")))
    kept = stored(own, "topk-rows")
    size = kept.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    shares = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(math.ceil(size["n"] / block_rows), min(shares, math.ceil(size["n"] / SMALL_BLOCK)), 1)
    parts = max(math.ceil(size["q"] / block_queries), 1)

    queries = kept.where("asks").withColumn("number", F.monotonically_increasing_id())
    queries = stored(queries.select("number", "id", "vector"), "topk-queries")
    asked = dealt(queries, parts, "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    offered = dealt(kept.select("id", "vector"), blocks, "block").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    )
    found = asked.groupBy("block", "part").cogroup(offered.groupBy("block", "part")).applyInArrow(
        lambda left, right: search_cell(left, right, k, scale), FOUND
    )
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k_report(embeddings: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The ``k`` best other rows of every row whose id is divisible by ``every``."""
    return exact_top_k(embeddings, F.col("vec_id") % every == 0, k)


ORACLE = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS pos,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.pos, q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY pos ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
