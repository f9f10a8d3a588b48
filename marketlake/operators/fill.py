"""Filling gaps with the exact median of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.columns import missing_as_null
from marketlake.operators.ordering import AHEAD, COPIES, collapse_copies, key_sketch, rows_ahead, split_hot

# The aggregation state of an exact median holds every distinct value of a group.
MAX_MEDIAN_ROWS = 200_000
MAX_BROADCAST_GROUPS = 100_000


def _medians_by_range(df: DataFrame, group: str, cols: Sequence[str], few_groups: bool) -> DataFrame:
    """Medians of groups too large for one task: count equal values, then pick the middle ranks."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols])
    )
    values = df.select(group, pairs.alias("p")).select(group, "p.metric", "p.value").filter("value is not null")
    counted = collapse_copies(values)
    placed = rows_ahead(counted, [group, "metric"], [F.col("value")])
    sizes = counted.groupBy(group, "metric").agg(F.sum(COPIES).alias("n"))
    if few_groups:
        sizes = F.broadcast(sizes)
    lower, upper = F.expr("(n + 1) div 2"), F.expr("(n + 2) div 2")

    def holds(rank):
        return (F.col(AHEAD) < rank) & (rank <= F.col(AHEAD) + F.col(COPIES))

    # At most two rows per (group, metric) survive the filter.
    middle = placed.join(sizes, [group, "metric"]).filter(holds(lower) | holds(upper))
    medians = middle.groupBy(group, "metric").agg(
        ((F.min("value") + F.max("value")) / 2).alias("median")
    )
    return medians.groupBy(group).agg(
        *[F.max(F.when(F.col("metric") == c, F.col("median"))).alias(f"_median_{c}") for c in cols]
    )


METRIC, VALUE = "metric", "value"


def value_counts(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """(group, metric, value, n): how often each value of ``cols`` occurs in each group. Gaps and rows without a group
    are left out. Counts of two loads add up, so they can be kept and merged."""
    known = df.filter(F.col(group).isNotNull())
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias(METRIC), missing_as_null(F.col(c).cast("double")).alias(VALUE)) for c in cols])
    )
    values = known.select(F.col(group).alias("group"), pairs.alias("p")).select("group", "p.*").filter(f"{VALUE} is not null")
    return values.groupBy("group", METRIC, VALUE).agg(F.count(F.lit(1)).alias("n"))


def merge_counts(kept: DataFrame, new: DataFrame) -> DataFrame:
    """The counts of both loads."""
    return kept.unionByName(new).groupBy("group", METRIC, VALUE).agg(F.sum("n").alias("n"))


def medians_of_counts(counts: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(group, one median for each of ``cols``) from counted values, whatever number of rows they stand for.

    Ranks come from running sums over the sorted values, which span partitions, so no group has to fit a task.
    """
    placed = rows_ahead(counts.withColumnRenamed("n", COPIES), ["group", METRIC], [F.col(VALUE)])
    sizes = counts.groupBy("group", METRIC).agg(F.sum("n").alias("n"))
    middle = placed.join(sizes, ["group", METRIC]).filter(
        (F.col(AHEAD) < F.expr("(n + 2) div 2")) & (F.expr("(n + 1) div 2") <= F.col(AHEAD) + F.col(COPIES))
    )
    medians = middle.groupBy("group", METRIC).agg(((F.min(VALUE) + F.max(VALUE)) / 2).alias("median"))
    return medians.groupBy("group").agg(*[F.max(F.when(F.col(METRIC) == c, F.col("median"))).alias(c) for c in cols])


def fill_by_medians(
    df: DataFrame, group: str, cols: Sequence[str], medians: DataFrame, empty: float = 0.0
) -> DataFrame:
    """Gaps in ``cols`` replaced by known medians, or by ``empty``. Rows without a group are dropped."""
    known = df.filter(F.col(group).isNotNull()).withColumns(
        {c: missing_as_null(F.col(c).cast("double")) for c in cols}
    )
    named = medians.select(F.col("group").alias(group), *[F.col(c).alias(f"_median_{c}") for c in cols])
    filled = known.join(named, group, "left").withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_median_{c}"), F.lit(float(empty))) for c in cols}
    )
    return filled.select(*df.columns)


def median_fill(
    df: DataFrame,
    group: str,
    cols: Sequence[str],
    empty: float = 0.0,
    max_group_rows: int = MAX_MEDIAN_ROWS,
) -> DataFrame:
    """Replace gaps in ``cols`` by the group median, or by ``empty`` where a group has no value.

    Rows without a group are dropped.
    """
    known = df.filter(F.col(group).isNotNull()).withColumns(
        {c: missing_as_null(F.col(c).cast("double")) for c in cols}
    )
    sketch = key_sketch(known, [group], max_group_rows)
    few_groups = sketch.groups <= MAX_BROADCAST_GROUPS
    small, large = split_hot(known, [group], sketch.hot) if sketch.hot else (known, None)
    medians = small.groupBy(group).agg(*[F.median(c).alias(f"_median_{c}") for c in cols])
    if large is not None:
        medians = medians.unionByName(_medians_by_range(large, group, cols, few_groups))
    if few_groups:
        medians = F.broadcast(medians)
    filled = known.join(medians, group, "left").withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_median_{c}"), F.lit(float(empty))) for c in cols}
    )
    return filled.select(*df.columns)


def ungrouped_rows(df: DataFrame, group: str) -> DataFrame:
    """The rows ``median_fill`` leaves out."""
    return df.filter(F.col(group).isNull())


def year_filter(df: DataFrame, year: str, start: str, end: str) -> DataFrame:
    """Rows whose year lies between the years of two ISO dates, both included."""
    first, last = (F.year(F.to_date(F.lit(day))) for day in (start, end))
    return df.filter(F.col(year).between(first, last))
