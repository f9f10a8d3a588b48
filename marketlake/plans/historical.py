"""Full refresh: landing snapshots to bronze, validation, silver behind contracts, gold views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import schemas
from marketlake.functions.columns import trim_strings
from marketlake.operators.contract import Contract, checked, parted, require_unique
from marketlake.operators.dedup import keep_first, keep_ranked, newest_first, rank_rows
from marketlake.operators.fill import median_fill, ungrouped_rows
from marketlake.operators.ordering import surrogate_key
from marketlake.operators.profile import null_profile
from marketlake.operators.quality import Suite
from marketlake.plans import suites
from marketlake.plans.gold import create_gold_views
from marketlake.plans.lake import Lake, Run
from marketlake.plans.loading import Counts, load
from marketlake.session import checkpointed, kept
from marketlake.sources.landing import ticker_from_path
from marketlake.sources.tables import (
    create_layers,
    keep_rejects,
    refresh,
    refresh_monthly,
    write_metrics,
    write_report,
)

BRONZE_COLUMNS = {
    "ohclv_bronze": schemas.OHLCV_COLUMNS,
    "company_meta_data_bronze": schemas.COMPANY_COLUMNS,
    "macro_economic_data_bronze": schemas.MACRO_COLUMNS,
    "exchange_rates_bronze": schemas.FX_COLUMNS,
}


def _bronze(df: DataFrame, columns: list[str], id_col: str, batch_ts: dt.datetime) -> DataFrame:
    """Table columns, a unique id without any order, and one load time for the whole batch."""
    return df.select(
        F.monotonically_increasing_id().alias(id_col), *columns, F.lit(batch_ts).alias("insert_datetime")
    )


def bronze_ohlcv(rows: DataFrame, lake: Lake, ts: dt.datetime) -> DataFrame:
    if not lake.stamped:
        rows = ticker_from_path(rows.drop("COMPANY_TICKER"))
    rows = rows.withColumnsRenamed(schemas.OHLCV_RENAME)
    return _bronze(rows, schemas.OHLCV_COLUMNS, "id", ts)


def bronze_company(rows: DataFrame, lake: Lake, ts: dt.datetime) -> DataFrame:
    return _bronze(rows.withColumnsRenamed(schemas.COMPANY_RENAME), schemas.COMPANY_COLUMNS, "company_id", ts)


def bronze_fx(rows: DataFrame, lake: Lake, ts: dt.datetime) -> DataFrame:
    return _bronze(rows.withColumnsRenamed(schemas.FX_HISTORIC_RENAME), schemas.FX_COLUMNS, "id", ts)


def bronze_macro(rows: DataFrame, lake: Lake, ts: dt.datetime) -> DataFrame:
    """Gaps are filled per country before the load; rows without a country are kept as rejects of the run."""
    day = ts.date()
    lost = ungrouped_rows(rows, "ISO3").withColumnRenamed("id", "country_id").withColumnsRenamed(schemas.MACRO_RENAME)
    lost = lost.select(*schemas.MACRO_COLUMNS, F.array(F.lit("null:ISO3")).alias("reasons"))
    keep_rejects(lost, f"{lake.bronze}.macro_economic_data_bronze_rejects", day.isoformat())
    filled = median_fill(rows, "ISO3", schemas.MACRO_MEASURES).withColumnRenamed("id", "country_id")
    return _bronze(filled.withColumnsRenamed(schemas.MACRO_RENAME), schemas.MACRO_COLUMNS, "id", ts)


def validation_suites(now: dt.datetime) -> dict[str, Suite]:
    return {
        "ohclv_bronze": suites.ohlcv_suite(now.date()),
        "company_meta_data_bronze": suites.company_suite(),
        "exchange_rates_bronze": suites.fx_suite(now.date()),
        "macro_economic_data_bronze": suites.macro_suite(now.year),
    }


def layer_metrics(spark: SparkSession, lake: Lake) -> DataFrame:
    tables = [(n, c) for n, c in BRONZE_COLUMNS.items() if spark.catalog.tableExists(f"{lake.bronze}.{n}")]
    return null_profile({name: (spark.table(f"{lake.bronze}.{name}"), cols) for name, cols in tables})


def _to_silver(
    lake: Lake,
    base: str,
    prepared: DataFrame,
    keys: list[str],
    id_col: str,
    contract: Contract,
    load_date: dt.date,
    monthly: bool,
    ranked: bool,
) -> None:
    """Rank, keep the survivors, enforce the contract; rejects go to ``<table>_rejects``."""
    # The id only tells copies apart that agree in everything else.
    order = [*newest_first(prepared.drop(id_col)), F.col(id_col).asc()]
    if ranked:
        survivors = keep_ranked(refresh(rank_rows(prepared, keys, order), f"{lake.bronze}.{base}_processed"))
    else:
        survivors = keep_first(prepared, keys, order)
    clean = refresh(survivors, f"{lake.silver}.{base}_clean")
    if "insert_datetime" in contract.names:
        clean = clean.withColumn("insert_datetime", F.lit(load_date))
    by_key: list[Column] = [F.col(k) for k in keys]
    table = f"{lake.silver}.{contract.name}"
    # The unique check, the ids (twice) and the rejects read what the contract made of each row.
    with kept(checked(clean, contract), f"{base}-checked") as rows:
        good, rejects = parted(rows, contract)
        require_unique(good, contract.unique or keys, contract.name)
        numbered = surrogate_key(good, id_col, by_key, unique=True)
        refresh_monthly(numbered, table) if monthly else refresh(numbered, table)
        refresh(rejects, f"{table}_rejects")


def load_silver(spark: SparkSession, lake: Lake, load_date: dt.date, run: Run, ranked: bool) -> None:
    def bronze(name: str) -> DataFrame:
        return trim_strings(spark.table(f"{lake.bronze}.{name}"))

    def to_silver(base, prepared, keys, id_col, contract, monthly=False):
        _to_silver(lake, base, prepared, keys, id_col, contract, load_date, monthly, ranked)

    run.together(
        lambda own: own.step("silver_ohlcv", lambda: to_silver(
            "ohclv", bronze("ohclv_bronze").withColumnRenamed("id", "stock_id"),
            ["ticker", "date"], "stock_id", schemas.OHLCV_SILVER, monthly=True,
        ), ["ohclv_bronze"]),
        lambda own: own.step("silver_company", lambda: to_silver(
            "company_meta_data", bronze("company_meta_data_bronze"),
            ["ticker"], "company_id", schemas.COMPANY_SILVER,
        ), ["company_meta_data_bronze"]),
        lambda own: own.step("silver_fx", lambda: to_silver(
            "exchange_rates",
            bronze("exchange_rates_bronze").withColumnRenamed("id", "rate_id").withColumn("date", F.to_date("date")),
            ["date"], "rate_id", schemas.FX_SILVER, monthly=True,
        ), ["exchange_rates_bronze"]),
        lambda own: own.step("silver_macro", lambda: to_silver(
            "macro_economic_data",
            bronze("macro_economic_data_bronze").withColumnsRenamed({"id": "data_id", "country_id": "country_code"}),
            ["country_code", "year"], "data_id", schemas.MACRO_SILVER,
        ), ["macro_economic_data_bronze"]),
    )


def run_historical(
    spark: SparkSession,
    lake: Lake,
    run_ts: dt.datetime,
    ohlcv_schema: T.StructType = schemas.OHLCV_DAILY,
    ranked: bool = False,
    fail_on_error: bool = False,
    fail_fast: bool = False,
) -> dict[str, str]:
    """Load, validate, transform and publish one run day; returns the outcome of every step.

    ``ranked`` also stores every row with its rank (``*_processed``), not only the survivors.
    A broken rule is only reported unless ``fail_on_error``.
    """
    run, day = Run(fail_fast), run_ts.date()
    create_layers(spark, lake.databases, lake.tables_root)
    loads = {
        "ohclv_bronze": (lake.ohlcv, ohlcv_schema, bronze_ohlcv),
        "company_meta_data_bronze": (lake.company, schemas.COMPANY, bronze_company),
        "exchange_rates_bronze": (lake.fx, schemas.FX_HISTORIC, bronze_fx),
        "macro_economic_data_bronze": (lake.macro, schemas.MACRO, bronze_macro),
    }
    rules, counted = validation_suites(run_ts), {}

    def load_table(name: str) -> None:
        root, schema, shape = loads[name]
        landed = lake.landing(spark, root, schema, day, by_ticker=name == "ohclv_bronze")
        counted[name] = load(
            landed, schema, lambda rows: shape(rows, lake, run_ts), rules[name], f"{lake.bronze}.{name}", day.isoformat(),
            row_wise=shape is not bronze_macro,  # gap filling reads its rows twice
        )

    def load_and_validate(name: str) -> Callable[[Run], None]:
        def chain(own: Run) -> None:
            own.step(name, lambda: load_table(name))
            own.step(
                f"validate_{name}",
                lambda: validate(spark, lake, name, rules[name], run_ts, fail_on_error, counted.get(name)),
                [name],
            )

        return chain

    run.together(*[load_and_validate(name) for name in loads])
    metrics = f"{lake.reports}/bronze_layer_metrics"
    run.together(
        lambda own: own.step("layer_metrics", lambda: write_metrics(layer_metrics(spark, lake), metrics)),
        lambda own: load_silver(spark, lake, day, own, ranked),
    )
    run.step("gold", lambda: create_gold_views(spark, lake.silver, lake.gold))
    return run.steps


def validate(
    spark: SparkSession,
    lake: Lake,
    table: str,
    suite: Suite,
    run_ts: dt.datetime,
    fail_on_error: bool = False,
    counts: Counts | None = None,
) -> None:
    """Report of one suite from the ``counts`` of the load, or else from the table; values that break its rules are
    looked up only when a rule is broken."""
    rows = spark.table(f"{lake.bronze}.{table}")
    results = suite.observed(spark, counts) if counts else checkpointed(suite.run(rows))
    write_report(results, f"{lake.reports}/{table}", run_ts)
    failed = [r["position"] for r in results.filter(~F.col("success")).collect()]
    if failed:
        write_report(suite.samples(rows, positions=failed), f"{lake.reports}/{table}_samples", run_ts)
    if fail_on_error:
        suite.raise_failed(results)
