"""Sorted runs: rows range-partitioned by key and order, so that one key may span many partitions.

A partition holds a contiguous stretch of the sorted rows. Running sums are taken inside (key, partition) and shifted
by what earlier partitions hold of the key, so no task ever holds more of a key than one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import stored

PART, SPREAD = "_part", "_spread"


def sorted_runs(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``df`` in runs by ``keys`` (never NULL) and ``order``, stored with ``PART``.

    Rows that tie are spread by ``SPREAD``, so a group of copies spans partitions as well. ``df`` is read twice, once
    to sample the bounds: store it first if it is dear.
    """
    spread = df.withColumn(SPREAD, F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(*[F.col(k).asc() for k in keys], *order, F.col(SPREAD).asc())
    return stored(ranged.withColumn(PART, F.spark_partition_id()), name)


def running_sums(
    runs: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: dict[str, Column],
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """``runs`` with the running sum of each of ``sums`` up to and with each row of its key.

    ``totals`` names sums whose total over the key is wanted too: column name to name of the sum.
    """
    totals = totals or {}
    parts = runs.groupBy(*keys, PART).agg(*[F.sum(value).alias(f"_{name}") for name, value in sums.items()])
    # A key has one row here for each partition it spans.
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    parts = parts.select(
        *keys,
        PART,
        *[F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}") for name in sums],
        *[F.sum(f"_{of}").over(whole).alias(name) for name, of in totals.items()],
    )
    local = Window.partitionBy(*keys, PART).orderBy(*order, F.col(SPREAD).asc())
    local = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = runs.withColumns({name: F.sum(value).over(local) for name, value in sums.items()})
    joined = summed.join(parts, [*keys, PART])
    shifted = {name: F.col(name) + F.col(f"_before_{name}") for name in sums}
    return joined.withColumns(shifted).drop(*[f"_before_{name}" for name in sums])
