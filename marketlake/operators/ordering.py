"""Exact ordinals inside groups, also when one group holds a large share of all rows.

``row_number`` over a window puts a whole group into one task. That is the right plan while groups
are small, so large groups are looked for first: a frequent-items sketch over the key columns, one
partial sketch per task and no shuffle of keys. Only rows of the groups it finds are range-partitioned
by (keys, order): a large group then spans many partitions, each partition numbers its own rows, and
the rows ahead of a partition are added. The sketch chooses the plan only, never the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import checkpointed

MAX_GROUP_ROWS = 1_000_000
COPY_STEP = 65_536
#: Keys a sketch keeps apart, and the most it reports. It knows every key with more than about one row in 2,000; one
#: that it misses holds no more rows than a fair share of a job of that many tasks.
SKETCH_KEYS, SKETCH_FOUND = 20_000, 5_000

COPIES, AHEAD = "_copies", "_ahead"
_PART, _FROM, _PLACE = "_part", "_from", "_place"


@dataclass(frozen=True)
class GroupSizes:
    groups: int
    largest: int


def group_sizes(df: DataFrame, keys: Sequence[str]) -> GroupSizes:
    """Number of groups and rows of the largest one; partial counts are combined before the shuffle."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.count(F.lit(1)).alias("groups"), F.max("n").alias("largest")).first()
    return GroupSizes(row["groups"], row["largest"] or 0)


@dataclass(frozen=True)
class KeySketch:
    """``groups``: about how many keys there are (within a tenth); ``hot``: hashes of those beyond the limit."""

    groups: int
    hot: tuple[int, ...]


def key_sketch(df: DataFrame, keys: Sequence[str], limit: int) -> KeySketch:
    """The keys of more than about ``limit`` rows, without counting every key."""
    key = F.xxhash64(*keys)
    row = df.select(key.alias("key")).agg(
        F.approx_count_distinct("key", 0.03).alias("groups"),
        F.expr(f"approx_top_k(key, {SKETCH_FOUND}, {SKETCH_KEYS})").alias("top"),
    ).first()
    return KeySketch(row["groups"], tuple(sorted(t["item"] for t in row["top"] or () if t["count"] > limit)))


def split_hot(df: DataFrame, keys: Sequence[str], hot: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Rows of other keys, rows of hot keys. A key that shares a hash with a hot one goes with it."""
    is_hot = F.xxhash64(*keys).isin(list(hot))
    return df.filter(~is_hot), df.filter(is_hot)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """NULL-safe equality on ``keys``."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def collapse_copies(df: DataFrame) -> DataFrame:
    """One row per distinct row, with its multiplicity; identical copies merge before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def rows_ahead(distinct: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Add ``_ahead``: rows of the same group that sort before this one, copies included.

    ``distinct`` carries ``_copies``. No task sees more than one range partition of a group.
    """
    ranged = distinct.repartitionByRange(*[F.col(k).asc() for k in keys], *order)
    # Range bounds come from sampling, so the assignment is written down before it is used twice.
    ranged = checkpointed(ranged.withColumn(_PART, F.spark_partition_id()))

    parts = ranged.groupBy(*keys, _PART).agg(F.sum(COPIES).alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.withColumn("_before", F.sum("_rows").over(earlier))
        .filter("_before > 0")
        .select(*keys, _PART, "_before")
    )
    # Only the first group of a partition can continue from an earlier partition, so there is at
    # most one offset per partition: always small enough to broadcast.
    offsets = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in offsets.columns])
    condition = ranged[_PART] == offsets[f"_o_{_PART}"]
    for key in keys:
        condition = condition & ranged[key].eqNullSafe(offsets[f"_o_{key}"])
    joined = ranged.join(F.broadcast(offsets), condition, "left")

    inside = Window.partitionBy(*keys, _PART).orderBy(*order)
    running = F.sum(COPIES).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return joined.withColumn(
        AHEAD, F.coalesce("_o__before", F.lit(0)) + running - F.col(COPIES)
    ).drop(_PART, *offsets.columns)


def number_sorted_rows(
    df: DataFrame, order: Sequence[Column], name: str, store: Callable[[DataFrame], DataFrame] = checkpointed
) -> DataFrame:
    """Number a whole table of distinct rows: one range shuffle, then a position inside each partition.

    ``store`` writes the placed rows down; with ``session.kept`` they are compressed, and removed by the caller.
    """
    # Partition number and position come from one id: partition << 33 | position.
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = store(ranged.withColumn(_PLACE, F.monotonically_increasing_id()))
    part, position = F.shiftright(_PLACE, 33), F.col(_PLACE).bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias(_PART)).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(  # one row per partition
        F.col(_PART).alias("_o_part"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    joined = placed.join(F.broadcast(offsets), part == F.col("_o_part"))
    return joined.select(*df.columns, (F.col("_before") + position + 1).alias(name))


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    max_group_rows: int = MAX_GROUP_ROWS,
    at_most: int | None = None,
    unique: bool = False,
    store: Callable[[DataFrame], DataFrame] = checkpointed,
) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` as column ``name``.

    ``order`` should be total over distinct rows; rows that tie get numbers in arbitrary order.
    ``at_most`` is a known bound on the rows of a group, if there is one. ``unique`` states that no
    two rows tie on ``keys`` and ``order``; without ``keys`` such rows are written down by ``store``.
    """
    if unique and not keys:
        return number_sorted_rows(df, order, name, store)  # no count first, and no task ever sees the whole table
    if at_most is not None and at_most <= max_group_rows:
        return _number_in_window(df, keys, order, name)
    if not keys:
        small = group_sizes(df, keys).largest <= max_group_rows
        return (_number_in_window if small else _number_by_range)(df, keys, order, name)
    hot = key_sketch(df, keys, max_group_rows).hot
    if not hot:
        return _number_in_window(df, keys, order, name)
    others, rows = split_hot(df, keys, hot)
    return _number_in_window(others, keys, order, name).unionByName(_number_by_range(rows, keys, order, name, unique))


def _number_in_window(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    spec = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)
    return df.withColumn(name, F.row_number().over(spec).cast("long"))


def _number_by_range(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, unique: bool = False
) -> DataFrame:
    if unique:
        numbered = rows_ahead(df.withColumn(COPIES, F.lit(1).cast("long")), keys, order)
        return numbered.select(*df.columns, (F.col(AHEAD) + 1).alias(name))

    placed = rows_ahead(collapse_copies(df), keys, order)
    most = placed.agg(F.max(COPIES)).first()[0]
    if most > COPY_STEP:
        # A row with very many copies is first cut into steps, and the steps are spread out.
        steps = F.explode(F.sequence(F.lit(0).cast("long"), F.col(COPIES) - 1, F.lit(COPY_STEP).cast("long")))
        placed = placed.withColumn(_FROM, steps).repartition(*df.columns, _FROM)
    else:
        placed = placed.withColumn(_FROM, F.lit(0).cast("long"))
    last = F.least(F.col(COPIES), F.col(_FROM) + COPY_STEP)
    return placed.withColumn(
        name, F.explode(F.sequence(F.col(AHEAD) + F.col(_FROM) + 1, F.col(AHEAD) + last))
    ).select(*df.columns, name)


def surrogate_key(
    df: DataFrame,
    name: str,
    order: Sequence[Column],
    start: int = 0,
    max_rows: int = MAX_GROUP_ROWS,
    at_most: int | None = None,
    unique: bool = False,
    store: Callable[[DataFrame], DataFrame] = checkpointed,
) -> DataFrame:
    """Consecutive ids ``start + 1, start + 2, ...`` in the given order, as the first column."""
    numbered = number_rows(df, [], order, name, max_rows, at_most, unique, store)
    return numbered.select((F.col(name) + start).alias(name), *df.columns)
