"""Gold facts and group medians kept up to date from increments, without reading what did not change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.operators.fill import medians_of_counts, merge_counts, value_counts
from marketlake.operators.upsert import MAX_BROADCAST_ROWS, MONTH, month_of, replace_months, upsert_table
from marketlake.plans.gold import DERIVED, derive_facts, stock_facts
from marketlake.session import checkpointed
from marketlake.sources.tables import refresh_monthly
from marketlake.sources.versions import refresh

#: Facts of a row look back on this many rows, itself included.
LOOKBACK = 90


def months_of(spark: SparkSession, table: str) -> list[str]:
    """The calendar months a table has, in order; one name for each month."""
    return sorted(r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def _reach(prices: DataFrame, spans: DataFrame, months: Sequence[str], start: int, step: int, need: int) -> int:
    """The month, from ``start`` on in steps of ``step`` (-1 or 1), up to which every changed series has ``need`` rows
    outside of its changed span, or the last month there is. The distance doubles until that holds."""
    last, distance = (0 if step < 0 else len(months) - 1), 1
    outside = F.col("date") < F.col("first") if step < 0 else F.col("date") > F.col("last")
    while True:
        end = max(start + step * distance, 0) if step < 0 else min(start + step * distance, last)
        if end == last:
            return end
        low, high = sorted((start, end))
        near = prices.filter(F.col(MONTH).between(months[low], months[high])).select("ticker", "date")
        found = near.join(spans, "ticker").filter(outside).groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
        short = spans.join(found, "ticker", "left").filter(F.coalesce("n", F.lit(0)) < need)
        if short.isEmpty():
            return end
        distance *= 2


def changed_rows(prices: DataFrame, changed: DataFrame, months: Sequence[str], lookback: int = LOOKBACK) -> DataFrame:
    """The rows of a monthly price table that facts of the ``changed`` (ticker, date) keys are computed from.

    Only months from the rows a changed key looks back on to the rows that look back on it are read.
    """
    spans = changed.groupBy("ticker").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    ends = changed.agg(F.min(month_of("date")), F.max(month_of("date"))).first()
    low = _reach(prices, spans, months, months.index(ends[0]), -1, lookback)
    high = _reach(prices, spans, months, months.index(ends[1]), 1, lookback)
    near = prices.filter(F.col(MONTH).between(months[low], months[high]))
    return near.join(spans.select("ticker"), "ticker", "left_semi")


def affected_facts(rows: DataFrame, changed: DataFrame, lookback: int = LOOKBACK) -> DataFrame:
    """The facts of those of ``rows`` that look back on a changed key.

    Keys go with the rows in the one shuffle by series that the facts need, and the mark of a row goes through the facts
    beside its id.
    """
    keys = changed.select("ticker", "date", F.lit(True).alias("_changed"))
    both = rows.drop(MONTH).unionByName(keys, allowMissingColumns=True).repartition("ticker")
    marked = both.withColumn("_mark", F.max("_changed").over(Window.partitionBy("ticker", "date")))
    back = Window.partitionBy("ticker").orderBy("date").rowsBetween(1 - lookback, 0)
    touched = F.coalesce(F.max("_mark").over(back), F.lit(False))
    own = marked.filter(F.col("_changed").isNull())
    own = own.withColumn("stock_id", F.struct("stock_id", touched.alias("touched"))).drop("_changed", "_mark")
    facts = stock_facts(own).filter("UUID.touched")
    return facts.withColumn("UUID", F.col("UUID.stock_id"))


def store_facts(spark: SparkSession, silver: str, facts: str) -> None:
    """All facts as a table by month, to be kept up to date by ``update_facts``."""
    every = stock_facts(spark.table(silver).drop(MONTH)).drop(*DERIVED)
    refresh_monthly(every, facts, "trade_date", derive_facts)


def _replace_facts(spark: SparkSession, silver: str, facts: str, first: str) -> None:
    """Compute all facts of the month ``first`` and later ones again: whole series are read, in one shuffle."""

    def compute() -> DataFrame:
        spark.catalog.refreshTable(silver)
        every = stock_facts(spark.table(silver).drop(MONTH)).drop(*DERIVED)
        return every.filter(month_of("trade_date") >= first)

    replace_months(spark, facts, compute, "trade_date", derive_facts)


def update_facts(
    spark: SparkSession, silver: str, facts: str, changed: DataFrame, broadcast_rows: int = MAX_BROADCAST_ROWS
) -> None:
    """Bring the stored ``facts`` up to date after ``silver`` got new values for the (ticker, date) keys in ``changed``.

    A changed close reaches the next ``LOOKBACK`` rows of its series. Those are computed again from the months around
    them and swapped in month by month; running it again changes nothing. Keys that silver does not have are ignored.

    More than ``broadcast_rows`` keys in at least half of the months reach nearly every row. All facts from the first of
    these months on are then computed and stored as they are: neither keys nor stored facts are moved to be matched.
    """
    months = months_of(spark, silver)
    prices = spark.table(silver)
    found = changed.groupBy(month_of("date").alias(MONTH)).agg(
        F.approx_count_distinct(F.xxhash64("ticker", "date")).alias("keys")
    ).collect()  # one row per calendar month
    reached = sorted({r[MONTH] for r in found}.intersection(months))
    if sum(r["keys"] for r in found) > broadcast_rows and 2 * len(reached) >= len(months):
        _replace_facts(spark, silver, facts, reached[0])
        return
    wanted = changed.select("ticker", "date", month_of("date").alias(MONTH)).distinct()
    keys = checkpointed(
        prices.select("ticker", "date", MONTH).join(wanted, ["ticker", "date", MONTH], "left_semi").select("ticker", "date")
    )
    if keys.isEmpty():
        return
    rows = changed_rows(prices, keys, months)
    new = affected_facts(rows, keys).persist()  # an upsert reads a large batch several times
    upsert_table(spark, facts, new, ["ticker", "trade_date"], date="trade_date", order=[F.col("UUID")])
    new.unpersist()


def update_medians(spark: SparkSession, table: str, increment: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """Medians of all loads so far, from the counts kept in ``table`` and the values of one more load.

    Earlier rows are not read again. A load must be added once: its counts go into the table.
    """
    new = value_counts(increment, group, cols)
    counts = merge_counts(spark.table(table), new) if spark.catalog.tableExists(table) else new
    return medians_of_counts(refresh(counts, table), cols)
