"""Daily increment: staged batch, lineage, validation, silver upsert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import schemas
from marketlake.functions.columns import trim_strings
from marketlake.operators.contract import Contract, enforce
from marketlake.operators.dedup import rank_dedup
from marketlake.operators.upsert import upsert_table
from marketlake.plans import suites
from marketlake.plans.historical import validate
from marketlake.plans.lake import Lake, Run
from marketlake.plans.loading import stage
from marketlake.sources.landing import RAW_LINE
from marketlake.sources.tables import create_empty, create_layers, keep_rejects, refresh

_JSON_TYPES = {"bigint": "long", "int": "integer", "smallint": "short"}


def _table_schema(id_col: str | None, contract: Contract) -> T.StructType:
    schema = T.StructType().add(id_col, "long") if id_col else T.StructType()
    for rule in contract.columns:
        schema = schema.add(rule.name, _JSON_TYPES.get(rule.type, rule.type))
    return schema


def create_targets(spark: SparkSession, lake: Lake) -> None:
    """The upsert targets, when they do not exist yet."""
    create_layers(spark, lake.databases, lake.tables_root)
    for table, id_col, contract in (
        (f"{lake.bronze}.ohclv_daily_lineage", "id", schemas.OHLCV_DAILY_LINEAGE),
        (f"{lake.bronze}.exchange_daily_lineage", "id", schemas.FX_DAILY_LINEAGE),
        (f"{lake.bronze}.ohclv_daily_accepted", None, schemas.OHLCV_ACCEPTED),
        (f"{lake.bronze}.exchange_daily_accepted", None, schemas.FX_ACCEPTED),
        (f"{lake.silver}.ohclv_silver", "stock_id", schemas.OHLCV_SILVER),
        (f"{lake.silver}.exchange_rates_silver", "rate_id", schemas.FX_SILVER),
    ):
        create_empty(spark, table, _table_schema(id_col, contract), monthly=True)


def daily_bars(rows: DataFrame) -> DataFrame:
    """Landing bars under table names, ticker from the file's own column."""
    named = rows.drop("ticker").withColumnsRenamed(schemas.OHLCV_RENAME)
    return named.select(*schemas.OHLCV_COLUMNS, "file_ts", "file_mtime", RAW_LINE)


def daily_rates(rows: DataFrame) -> DataFrame:
    named = rows.withColumnsRenamed(schemas.FX_DAILY_RENAME)
    return named.select(*schemas.FX_COLUMNS, "file_ts", "file_mtime", RAW_LINE)


def newest_bars(staged: DataFrame) -> DataFrame:
    """One trimmed row per (ticker, date), load time narrowed to its day."""
    rows = rank_dedup(trim_strings(staged, ["ticker"]), ["ticker", "date"])
    return rows.withColumn("insert_datetime", F.to_date("insert_datetime"))


def silver_rates(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return enforce(staged.withColumn("insert_datetime", F.to_date("insert_datetime")), schemas.FX_SILVER)


def _accepted(split: tuple[DataFrame, DataFrame], table: str, day: dt.date) -> DataFrame:
    """The good rows; the others are kept beside ``table``."""
    keep_rejects(split[1], f"{table}_rejects", day.isoformat())
    return split[0]


def run_daily(
    spark: SparkSession,
    lake: Lake,
    run_ts: dt.datetime,
    fail_on_error: bool = False,
    fail_fast: bool = False,
) -> dict[str, str]:
    """Load and validate the newest snapshots of one day and upsert them into silver."""
    run, day = Run(fail_fast), run_ts.date()
    bars, rates = f"{lake.bronze}.ohclv_daily_bronze", f"{lake.bronze}.exchange_daily_bronze"
    run.step("targets", lambda: create_targets(spark, lake))

    counted = {}

    def stage_table(table, root, schema, shape, contract, suite, by_ticker=False):
        landed = lake.landing(spark, root, schema, day, by_ticker)
        counted[table] = stage(
            landed, schema, lambda rows: shape(rows).withColumn("insert_datetime", F.lit(run_ts)), contract, suite, table,
            day.isoformat(),
        )

    def lineage(own: Run, kind: str, staged: str, table: str, contract: Contract, keys: list[str]) -> None:
        own.step(f"lineage_{kind}", lambda: upsert_table(
            spark, table, _accepted(enforce(spark.table(staged), contract), table, day), keys, id_col="id"
        ), [f"stage_{kind}"])

    def silver_of_bars(own: Run) -> None:
        processed = f"{lake.bronze}.ohclv_daily_processed"

        def process() -> None:
            newest = newest_bars(spark.table(bars)).persist()  # the contract parts them in two
            refresh(_accepted(enforce(newest, schemas.OHLCV_SILVER), f"{lake.silver}.ohclv_daily", day), processed)
            newest.unpersist()

        own.step("processed_bars", process, ["stage_bars"])
        own.step("silver_bars", lambda: upsert_table(
            spark, f"{lake.silver}.ohclv_silver", spark.table(processed), ["ticker", "date"], id_col="stock_id"
        ), ["processed_bars"])

    def all_bars(own: Run) -> None:
        own.step("stage_bars", lambda: stage_table(
            bars, lake.ohlcv, schemas.OHLCV_DAILY, daily_bars, schemas.OHLCV_DAILY_BRONZE, suites.ohlcv_daily_suite(day),
            True,
        ))
        own.together(
            lambda own: lineage(
                own, "bars", bars, f"{lake.bronze}.ohclv_daily_lineage", schemas.OHLCV_DAILY_LINEAGE, ["ticker", "date"]
            ),
            lambda own: own.step("validate_bars", lambda: validate(
                spark, lake, "ohclv_daily_bronze", suites.ohlcv_daily_suite(day), run_ts, fail_on_error, counted.get(bars)
            ), ["stage_bars"]),
        )
        silver_of_bars(own)

    def all_rates(own: Run) -> None:
        own.step("stage_rates", lambda: stage_table(
            rates, lake.fx, schemas.FX_DAILY, daily_rates, schemas.FX_DAILY_BRONZE, suites.fx_daily_suite(day)
        ))
        own.together(
            lambda own: lineage(
                own, "rates", rates, f"{lake.bronze}.exchange_daily_lineage", schemas.FX_DAILY_LINEAGE, ["date"]
            ),
            lambda own: own.step("validate_rates", lambda: validate(
                spark, lake, "exchange_daily_bronze", suites.fx_daily_suite(day), run_ts, fail_on_error, counted.get(rates)
            ), ["stage_rates"]),
        )
        own.step("silver_rates", lambda: upsert_table(
            spark, f"{lake.silver}.exchange_rates_silver",
            _accepted(silver_rates(spark.table(rates)), f"{lake.silver}.exchange_daily", day),
            ["date"], id_col="rate_id",
        ), ["stage_rates"])

    run.together(all_bars, all_rates)
    return run.steps
