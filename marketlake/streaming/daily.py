"""The daily increment as a file stream: new landing files become upserts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketlake import schemas
from marketlake.functions.columns import trim_strings
from marketlake.operators.contract import Contract, enforce
from marketlake.operators.quality import Suite
from marketlake.operators.upsert import upsert_table
from marketlake.plans import suites
from marketlake.plans.daily import create_targets, daily_bars, daily_rates
from marketlake.plans.lake import Lake
from marketlake.plans.loading import stage
from marketlake.session import shared_dir
from marketlake.sources.landing import stream_landing
from marketlake.sources.tables import keep_rejects, write_batch_report


def _stamped(rows: DataFrame) -> DataFrame:
    """The snapshot time takes the place of the load time, so it does not matter when a file is read."""
    stamp = F.coalesce("file_ts", "file_mtime")
    rows = rows.withColumn("insert_datetime", stamp).drop("file_ts", "file_mtime")
    return trim_strings(rows, ["ticker"]) if "ticker" in rows.columns else rows


@dataclass(frozen=True)
class Feed:
    """One kind of landing files: their layout, rules and tables."""

    name: str
    schema: T.StructType
    shape: Callable[[DataFrame], DataFrame]
    keys: list[str]
    staging: Contract
    lineage: Contract
    accepted: Contract
    suite: Suite
    silver: str
    silver_id: str


BARS = Feed(
    "bars", schemas.OHLCV_DAILY, daily_bars, ["ticker", "date"], schemas.OHLCV_DAILY_BRONZE, schemas.OHLCV_DAILY_LINEAGE,
    schemas.OHLCV_ACCEPTED, suites.ohlcv_stream_suite(), "ohclv_silver", "stock_id",
)
RATES = Feed(
    "rates", schemas.FX_DAILY, daily_rates, ["date"], schemas.FX_DAILY_BRONZE, schemas.FX_DAILY_LINEAGE,
    schemas.FX_ACCEPTED, suites.fx_stream_suite(), "exchange_rates_silver", "rate_id",
)


def apply_batch(spark: SparkSession, lake: Lake, feed: Feed, landed: DataFrame, run: str) -> None:
    """Upsert one micro-batch. A replayed batch, or an older file that arrives late, changes nothing.

    The batch is staged behind the staging contract and validated in the same pass; its report, its rejects and its
    unreadable lines are kept by batch, so a replay adds none. The lineage keeps the newest staged row of each key.
    Silver follows another table, of the newest row that the silver contract accepts too, by the time of its snapshot: an
    unfit newer row never hides an accepted one, whichever arrives first.
    """
    lineage, accepted, silver = (
        f"{lake.bronze}.{feed.lineage.name}", f"{lake.bronze}.{feed.accepted.name}", f"{lake.silver}.{feed.silver}"
    )
    staged = f"{lineage}_stream"
    counts = stage(
        landed, feed.schema, lambda rows: _stamped(feed.shape(rows)), feed.staging, feed.suite, staged, run
    )
    # The stream stores these from a session of its own, whose changes this one has to be told of.
    for table in (staged, f"{staged}_rejects", f"{staged}_landing_rejects"):
        spark.catalog.refreshTable(table)
    batch = spark.table(staged)
    results = feed.suite.observed(spark, counts) if counts else feed.suite.run(batch)
    write_batch_report(results, f"{lake.reports}/{feed.staging.name}_stream", run)

    upsert_table(spark, lineage, enforce(batch, feed.lineage)[0], feed.keys, id_col="id", newer_by="insert_datetime")
    fit, unfit = enforce(batch, feed.accepted)
    keep_rejects(unfit, f"{silver}_stream_rejects", run)

    def to_silver(newest: DataFrame) -> None:
        dated = newest.withColumn("insert_datetime", F.to_date("insert_datetime"))
        upsert_table(spark, silver, dated, feed.keys, id_col=feed.silver_id)

    upsert_table(spark, accepted, fit, feed.keys, newer_by="insert_datetime", then=to_silver)


def _stream(spark: SparkSession, lake: Lake, feed: Feed, folders: str, checkpoint: str | None) -> StreamingQuery:
    create_targets(spark, lake)

    def apply(batch: DataFrame, number: int) -> None:
        apply_batch(spark, lake, feed, batch, f"{feed.name}-{number}")

    return _start(spark, stream_landing(spark, folders, feed.schema), apply, checkpoint, lake, feed.name)


def stream_bars(spark: SparkSession, lake: Lake, checkpoint: str | None = None) -> StreamingQuery:
    """Process all bar files that have not been seen yet, then stop."""
    return _stream(spark, lake, BARS, lake.folders(lake.ohlcv, by_ticker=True), checkpoint)


def stream_rates(spark: SparkSession, lake: Lake, checkpoint: str | None = None) -> StreamingQuery:
    """Process all rate files that have not been seen yet, then stop."""
    return _stream(spark, lake, RATES, lake.folders(lake.fx), checkpoint)


def _start(
    spark: SparkSession, stream: DataFrame, apply, checkpoint: str | None, lake: Lake, name: str
) -> StreamingQuery:
    place = checkpoint or f"{shared_dir(spark).rstrip('/')}/{lake.silver}-{name}"
    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", place)
        .trigger(availableNow=True)
        .start()
    )


def stream_daily(spark: SparkSession, lake: Lake, checkpoint: str | None = None) -> list[StreamingQuery]:
    """Both streams; wait for each with ``awaitTermination()``."""
    return [
        stream_bars(spark, lake, checkpoint and f"{checkpoint}/bars"),
        stream_rates(spark, lake, checkpoint and f"{checkpoint}/rates"),
    ]
