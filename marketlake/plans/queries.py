"""Every operator as a query over the shared test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import ExitStack
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions.columns import (
    landing_day,
    landing_time,
    path_file_ts,
    path_run_day,
    path_ticker,
    trim_strings,
)
from marketlake.operators.contract import enforce, unique_violations
from marketlake.operators.dedup import keep_first, keep_ranked, newest_first, rank_dedup
from marketlake.operators.fill import fill_by_medians, median_fill, ungrouped_rows, year_filter
from marketlake.operators.ordering import surrogate_key
from marketlake.operators.profile import null_profile
from marketlake.operators.quality import Suite
from marketlake.operators.upsert import MONTH, upsert, upsert_table
from marketlake.plans import adapters, gold, suites
from marketlake.plans.daily import run_daily
from marketlake.plans.historical import bronze_ohlcv, run_historical
from marketlake.plans.increment import store_facts, update_facts, update_medians
from marketlake.plans.lake import Lake
from marketlake.plans.loading import load
from marketlake.session import checkpointed, kept, scratch_path
from marketlake.sources.landing import latest_snapshot, read_landing, ticker_from_path
from marketlake.sources.payloads import explode_rates, flatten_rate, pick_keys, upper_headers, variant_rates
from marketlake.sources.tables import create_layers, refresh_monthly, write_landing, write_landing_tree
from marketlake.streaming.daily import stream_bars

Query = Callable[[SparkSession, str], DataFrame]

NOW = dt.date(2000, 1, 1)
TODAY_BARS = dt.date(1998, 6, 1)
NOW_FX = dt.date(2024, 1, 20)
TODAY_FX = dt.date(2024, 1, 10)
LOAD_DATE = dt.date(2025, 12, 18)
MEASURES = ["nominal_gdp", "real_gdp", "inflation", "unemployment"]


def _bars(spark, sf):
    return adapters.bars(adapters.table(spark, sf, "events"))


def _ohlcv(spark, sf):
    return adapters.ohlcv_rows(adapters.table(spark, sf, "lineitem"))


def _company(spark, sf):
    return adapters.company_rows(adapters.table(spark, sf, "customer"))


def _fx(spark, sf):
    return adapters.fx_rows(adapters.table(spark, sf, "events"))


def _macro(spark, sf):
    return adapters.macro_rows(*[adapters.table(spark, sf, name) for name in ("orders", "customer", "nation")])


# --- gold -------------------------------------------------------------------------------------


def _rounded_facts(facts: DataFrame) -> DataFrame:
    # The deviation is a floating sum over the frame; engines differ in its last digits.
    return facts.withColumn("volatility_days_30", F.round("volatility_days_30", 8))


def stock_facts(spark, sf):
    return _rounded_facts(gold.stock_facts(_bars(spark, sf), time="bar_ts", id_col=None))


def stock_facts_split(spark, sf):
    """The same facts when every series is too long for one task."""
    return _rounded_facts(gold.stock_facts(_bars(spark, sf), time="bar_ts", id_col=None, max_group_rows=100))


def stock_facts_wide(spark, sf):
    """The same facts of closes in a wider decimal type: the type does not change a value."""
    bars = _bars(spark, sf).withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("open", "high", "low", "close")})
    return _rounded_facts(gold.stock_facts(bars, time="bar_ts", id_col=None))


def stock_facts_silver(spark, sf):
    silver = checkpointed(surrogate_key_silver(spark, sf))  # a stored table in the flows
    return _rounded_facts(gold.stock_facts(silver))


def stock_facts_increment(spark, sf):
    """Stored price facts brought up to date after a second batch of bars went over the first."""
    lake, (bars, _) = _lake(spark), _daily_halves(spark, sf)
    create_layers(spark, lake.databases, lake.tables_root)
    silver, facts = f"{lake.silver}.ohclv_silver", f"{lake.gold}.stock_facts_stored"
    halves = [
        enforce(_for_silver(trim_strings(half.drop("batch"), ["ticker"])), schemas.OHLCV_SILVER)[0] for half in bars
    ]
    values = [F.col(c).asc() for c in schemas.OHLCV_COLUMNS]
    stored = keep_first(halves[0], BAR_KEY, values)
    with ExitStack() as files:
        numbered = surrogate_key(
            stored, "stock_id", [F.col(k) for k in BAR_KEY], unique=True,
            store=lambda rows: files.enter_context(kept(rows, "placed")),
        )
        refresh_monthly(numbered, silver)
    store_facts(spark, silver, facts)
    with kept(halves[1], "batch") as batch:
        upsert_table(spark, silver, batch, BAR_KEY, order=values, id_col="stock_id")
        update_facts(spark, silver, facts, batch.select(*BAR_KEY))
    return _rounded_facts(spark.table(facts).drop(MONTH, "UUID"))


def macro_facts(spark, sf):
    return gold.macro_facts(adapters.macro_series(_macro(spark, sf)), id_col=None)


def macro_facts_compat(spark, sf):
    return gold.macro_facts(adapters.macro_series(_macro(spark, sf)), id_col=None, compat=True)


# --- ranking and de-duplication ---------------------------------------------------------------


def _trimmed_ohlcv(spark, sf):
    return trim_strings(_ohlcv(spark, sf), ["ticker"])


def _clean_ohlcv(spark, sf):
    return rank_dedup(_trimmed_ohlcv(spark, sf), ["ticker", "date"])


def rank_trim_ohlcv(spark, sf):
    return rank_dedup(_trimmed_ohlcv(spark, sf), ["ticker", "date"], keep_rank=True)


def dedup_ohlcv(spark, sf):
    return _clean_ohlcv(spark, sf)


def rank_trim_company(spark, sf):
    return rank_dedup(trim_strings(_company(spark, sf)), ["ticker"], keep_rank=True)


def dedup_company(spark, sf):
    return rank_dedup(trim_strings(_company(spark, sf)), ["ticker"])


def clean_company(spark, sf):
    return keep_ranked(rank_trim_company(spark, sf))


def _fx_by_day(spark, sf):
    return _fx(spark, sf).withColumn("date", F.col("date").cast("date"))


def rank_trim_fx(spark, sf):
    rates = _fx_by_day(spark, sf)
    return rank_dedup(rates, ["date"], newest_first(rates, ["insert_order"]), keep_rank=True)


def rank_trim_fx_split(spark, sf):
    """The same ranks when every day has too many rates for one task."""
    rates = _fx_by_day(spark, sf)
    return rank_dedup(rates, ["date"], newest_first(rates, ["insert_order"]), keep_rank=True, max_group_rows=50)


def dedup_fx(spark, sf):
    rates = _fx_by_day(spark, sf)
    return rank_dedup(rates, ["date"], newest_first(rates, ["insert_order"]))


def _macro_order(rows):
    return newest_first(rows, ["insert_datetime", "insert_order"])


def rank_trim_macro(spark, sf):
    rows = trim_strings(_macro(spark, sf))
    return rank_dedup(rows, ["country_id", "year"], _macro_order(rows), keep_rank=True)


def dedup_macro(spark, sf):
    rows = trim_strings(_macro(spark, sf))
    return rank_dedup(rows, ["country_id", "year"], _macro_order(rows))


def dedup_daily(spark, sf):
    """The staged batch reduced to one row per key, load time narrowed to a date."""
    staged = _trimmed_ohlcv(spark, sf).drop("batch")
    return rank_dedup(staged, ["ticker", "date"]).withColumn("insert_datetime", F.col("insert_datetime").cast("date"))


# --- gaps -------------------------------------------------------------------------------------


def macro_median_fill(spark, sf, **limits):
    filled = median_fill(_macro(spark, sf), "country_id", MEASURES, **limits)
    return filled.select("country_id", "year", "insert_order", *[F.round(c, 4).alias(c) for c in MEASURES])


def macro_median_fill_split(spark, sf):
    """The same medians when every country is too large for one task."""
    return macro_median_fill(spark, sf, max_group_rows=20)


def macro_median_increment(spark, sf):
    """The same gaps filled after two loads, the medians from kept counts and the second load alone."""
    lake, rows = _lake(spark), _macro(spark, sf)
    create_layers(spark, [lake.bronze], lake.tables_root)
    for half in (0, 1):
        medians = update_medians(
            spark, f"{lake.bronze}.macro_value_counts", rows.filter(F.col("insert_order") % 2 == half), "country_id", MEASURES
        )
    filled = fill_by_medians(rows, "country_id", MEASURES, medians)
    return filled.select("country_id", "year", "insert_order", *[F.round(c, 4).alias(c) for c in MEASURES])


def macro_ungrouped(spark, sf):
    return ungrouped_rows(_macro(spark, sf), "country_id")


def macro_year_filter(spark, sf):
    return year_filter(_macro(spark, sf), "year", "1996-01-01", "1999-06-30")


# --- contracts --------------------------------------------------------------------------------


def _for_silver(df: DataFrame) -> DataFrame:
    return df.withColumn("insert_datetime", F.lit(LOAD_DATE))


def _silver_ohlcv(spark, sf):
    return enforce(_for_silver(_clean_ohlcv(spark, sf)), schemas.OHLCV_SILVER)[0]


def contract_ohlcv(spark, sf):
    return _silver_ohlcv(spark, sf)


def contract_rejects(spark, sf):
    rejects = enforce(_for_silver(_clean_ohlcv(spark, sf)), schemas.OHLCV_SILVER)[1]
    return rejects.withColumn("reasons", F.concat_ws(",", "reasons")).drop("batch")


def contract_company(spark, sf):
    return enforce(dedup_company(spark, sf), schemas.COMPANY_SILVER)[0]


def contract_company_rejects(spark, sf):
    rejects = enforce(dedup_company(spark, sf), schemas.COMPANY_SILVER)[1]
    return rejects.withColumn("reasons", F.concat_ws(",", "reasons"))


def contract_fx(spark, sf):
    return enforce(_for_silver(dedup_fx(spark, sf)), schemas.FX_SILVER)[0]


def contract_macro(spark, sf):
    rows = median_fill(dedup_macro(spark, sf), "country_id", MEASURES)
    good = enforce(rows.withColumnRenamed("country_id", "country_code"), schemas.MACRO_SILVER)[0]
    return good.select("country_name", "country_code", "year", *[F.round(c, 4).alias(c) for c in MEASURES])


def unique_violations_ohlcv(spark, sf):
    return unique_violations(_trimmed_ohlcv(spark, sf), ["ticker", "date"])


BAR_KEY = ["ticker", "date"]


def surrogate_key_ohlcv(spark, sf):
    clean = checkpointed(_clean_ohlcv(spark, sf))  # a stored table in the flows
    return surrogate_key(clean, "stock_id", [F.col(k) for k in BAR_KEY], unique=True)


def surrogate_key_silver(spark, sf):
    clean = checkpointed(_silver_ohlcv(spark, sf))
    return surrogate_key(clean, "stock_id", [F.col(k) for k in BAR_KEY], unique=True)


# --- upsert -----------------------------------------------------------------------------------


def upsert_ohlcv(spark, sf):
    """First half of the lines as the stored table, second half as the incoming batch."""
    rows = _trimmed_ohlcv(spark, sf)
    stored = keep_first(rows.filter("batch <= 3").drop("batch"), ["ticker", "date"])
    target = checkpointed(surrogate_key(stored, "id", [F.col("ticker"), F.col("date")], unique=True))
    return upsert(target, rows.filter("batch > 3").drop("batch"), ["ticker", "date"], id_col="id")


def upsert_fx(spark, sf):
    rates = _fx_by_day(spark, sf)
    order = [F.col("insert_order").desc(), F.col("inr_rate").asc()]
    stored = keep_first(rates.filter("insert_order % 2 = 0"), ["date"], order)
    return upsert(stored, rates.filter("insert_order % 2 = 1"), ["date"], order)


# --- validation -------------------------------------------------------------------------------


def dq_suite_ohlcv(spark, sf):
    return suites.ohlcv_suite(NOW).run(_ohlcv(spark, sf))


def dq_suite_ohlcv_daily(spark, sf):
    return suites.ohlcv_daily_suite(TODAY_BARS).run(_ohlcv(spark, sf))


def dq_suite_company(spark, sf):
    return suites.company_suite().run(_company(spark, sf))


def dq_suite_fx(spark, sf):
    return suites.fx_suite(NOW_FX).run(_fx_by_day(spark, sf))


def dq_suite_fx_daily(spark, sf):
    return suites.fx_daily_suite(TODAY_FX).run(_fx_by_day(spark, sf))


def dq_suite_macro(spark, sf):
    return suites.macro_suite(2000, first_year=1996).run(_macro(spark, sf))


def dq_summary_company(spark, sf):
    return Suite.summary(dq_suite_company(spark, sf))


def dq_samples_company(spark, sf):
    return suites.company_suite().samples(_company(spark, sf))


def dq_quarantine_company(spark, sf):
    bad = suites.company_suite().clean(trim_strings(_company(spark, sf)))[1]
    return bad.withColumn("reasons", F.size("reasons"))


def null_profile_layers(spark, sf):
    return null_profile(
        {
            "ohclv_bronze": (_ohlcv(spark, sf), schemas.OHLCV_COLUMNS),
            "company_meta_data_bronze": (_company(spark, sf), schemas.COMPANY_COLUMNS),
            "macro_economic_data_bronze": (_macro(spark, sf), schemas.MACRO_COLUMNS),
            "exchange_rates_bronze": (_fx(spark, sf), schemas.FX_COLUMNS),
        }
    )


# --- landing ----------------------------------------------------------------------------------


def _with_paths(events: DataFrame) -> DataFrame:
    ticker = F.upper("event_type")
    path = F.concat_ws(
        "/", F.lit("file:/landing/ohclv"), ticker, landing_day(F.col("ts")),
        F.concat(ticker, F.lit("_stock_"), landing_time(F.date_trunc("hour", "ts")), F.lit(".csv")),
    )
    return events.select("event_id", "value", path.alias("file_path"))


def latest_snapshot_rows(spark, sf):
    """All files have the same modification time, so the stamp in the name decides."""
    rows = _with_paths(adapters.table(spark, sf, "events")).withColumn("file_mtime", F.lit(0))
    return latest_snapshot(rows).select("event_id", "value", F.col("folder_ticker").alias("ticker"), "run_day")


def path_parts(spark, sf):
    path = F.col("file_path")
    return _with_paths(adapters.table(spark, sf, "events")).select(
        "event_id",
        path_ticker(path).alias("ticker"),
        path_run_day(path).alias("run_day"),
        path_file_ts(path).cast("timestamp_ntz").alias("file_ts"),
    )


def json_rates_explode(spark, sf):
    day = F.col("ts").cast("date")
    rate = F.struct(F.col("value").alias("INR"))
    rates = F.create_map(
        day.cast("string"), rate, F.date_add(day, 1).cast("string"), F.struct((F.col("value") + 1).alias("INR"))
    )
    payloads = adapters.table(spark, sf, "events").select(F.to_json(F.struct(rates.alias("rates"))).alias("body"))
    return explode_rates(payloads, "body")


def json_variant_rates(spark, sf):
    """Rates from payloads of four shapes, one of them without rates; fields that nobody asked for are kept."""
    events = adapters.table(spark, sf, "events")
    day, value, shape = F.col("ts").cast("date").cast("string"), F.col("value"), F.col("event_id") % 4
    rate = F.struct(value.alias("INR"))
    body = (
        F.when(shape == 0, F.to_json(F.struct(F.lit(1).alias("amount"), F.create_map(day, rate).alias("rates"))))
        .when(
            shape == 1,
            F.to_json(
                F.struct(F.array(F.struct(day.alias("date"), value.alias("INR"))).alias("rates"), F.lit("n").alias("note"))
            ),
        )
        .when(shape == 2, F.to_json(F.struct(F.lit("USD").alias("base"))))
        .otherwise(F.to_json(F.struct(day.alias("date"), rate.alias("rates"))))
    )
    rates = variant_rates(events.select("event_id", body.alias("body")), "body")
    other = F.concat_ws(",", F.transform(F.map_entries("other"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return rates.select("event_id", "date", "rate", other.alias("other"))


def json_rate_flatten(spark, sf):
    body = F.struct(
        F.lit(1.0).alias("amount"),
        F.lit("USD").alias("base"),
        F.col("ts").cast("date").cast("string").alias("date"),
        F.struct(F.col("value").alias("INR")).alias("rates"),
    )
    return flatten_rate(adapters.table(spark, sf, "events").select(F.to_json(body).alias("body")), "body")


def json_pick_keys(spark, sf):
    """One profile list per customer; every fourth profile has no industry."""
    rows = _company(spark, sf)
    body = F.struct(
        F.col("company_name").alias("companyName"),
        F.col("ticker").alias("symbol"),
        "price",
        F.col("market_cap").alias("marketCap"),
        "sector",
        F.when(F.col("industry") != "Semiconductors", F.col("industry")).alias("industry"),
        F.lit("n/a").alias("website"),
    )
    return pick_keys(rows.select(F.to_json(F.array(body)).alias("body")), "body")


def provider_columns(spark, sf):
    """Headers in upper case, then table names, constants added, columns reordered."""
    bars = _bars(spark, sf)
    provider = upper_headers(bars.select(*[F.col(c).cast("double").alias(c) for c in ("close", "high", "low", "open")],
                                         "volume", "bar_ts", "ticker"))
    named = provider.withColumnsRenamed({**schemas.OHLCV_RENAME, "TICKER": "ticker", "BAR_TS": "date"})
    return named.withColumn("USD_rate", F.lit(1)).drop("volume").select(
        "ticker", "date", *[F.round(c, 2).alias(c) for c in ("open", "high", "low", "close")], "USD_rate"
    )


# --- flows: landing files written from the tables, loaded through the layers ---------------------

FIRST_RUN = dt.datetime(2025, 12, 17, 18)
SECOND_RUN = dt.datetime(2025, 12, 18, 18)
GZIP = "gzip"


def _lake(spark: SparkSession) -> Lake:
    """A lake of its own below the shared folder."""
    root = scratch_path(spark, "lake")
    tag = root.rsplit("-", 1)[1][:12]
    return Lake(
        reports=f"{root}/reports",
        **{name: f"{root}/landing/{name}" for name in ("ohlcv", "company", "fx", "macro")},
        bronze=f"bronze_{tag}",
        silver=f"silver_{tag}",
        gold=f"gold_{tag}",
        tables_root=f"{root}/tables",
        stamped=True,
    )


def _provider(df: DataFrame, names: dict[str, str], schema) -> DataFrame:
    """Table names back to the provider's, in file order."""
    return df.withColumnsRenamed({v: k for k, v in names.items()}).select(*schema.names)


def _land_bars(rows: DataFrame, lake: Lake, run: dt.datetime) -> None:
    write_landing(_provider(rows, schemas.OHLCV_RENAME, schemas.OHLCV_DAILY), lake.ohlcv, run, compression=GZIP)


def _land_rates(rows: DataFrame, lake: Lake, run: dt.datetime) -> None:
    write_landing(_provider(rows, schemas.FX_DAILY_RENAME, schemas.FX_DAILY), lake.fx, run, compression=GZIP)


def landing_snapshot(spark, sf):
    """Two snapshots of one run day; the later one is read."""
    lake, rows = _lake(spark), _company(spark, sf)
    files = _provider(rows, schemas.COMPANY_RENAME, schemas.COMPANY)
    write_landing(files.filter("price > 0"), lake.company, FIRST_RUN)
    write_landing(files, lake.company, FIRST_RUN.replace(hour=20))
    return lake.landing(spark, lake.company, schemas.COMPANY, FIRST_RUN.date()).select(*schemas.COMPANY.names)


def landing_tree(spark, sf):
    """Bars in the provider's folders ``<ticker>/yyyy/Mon/dd``; the folder names the ticker, whatever the file says."""
    root = scratch_path(spark, "tree")
    kind = F.col("ticker")
    named = F.when(kind == "VIEW", "VIEW B").when(kind == "CLICK", "^CLICK").otherwise(kind)
    rows = _bars(spark, sf).withColumns({"ticker": F.lit("of the file"), "date": F.to_date("bar_ts"), "folder": named})
    rows = rows.withColumnsRenamed({v: k for k, v in schemas.OHLCV_RENAME.items()})
    write_landing_tree(rows, root, FIRST_RUN, "stock", "folder", schemas.OHLCV_DAILY.names)
    found = read_landing(spark, root, schemas.OHLCV_DAILY, FIRST_RUN.date(), by_ticker=True)
    found = ticker_from_path(found.drop("COMPANY_TICKER")).withColumnsRenamed(schemas.OHLCV_RENAME)
    return found.select(*schemas.OHLCV_COLUMNS)


def _faulty_lines(spark, sf) -> DataFrame:
    """Landing lines of the bars, some of them beyond reading: text for a number, another order of the day, a field
    less, a field more, two bad fields."""
    rows = _ohlcv(spark, sf)
    close, fault = F.col("close"), F.round(F.col("close") * 100).cast("long") % 50
    fields = [
        F.when(fault == 1, F.date_format("date", "dd/MM/yyyy")).otherwise(F.date_format("date", "yyyy-MM-dd")),
        F.when(fault == 0, F.lit("abc")).otherwise(adapters.money(close).cast("string")),
        *[adapters.money(c).cast("string") for c in ("high", "low")],
        F.when(fault == 4, F.lit("?")).otherwise(adapters.money("open").cast("string")),
        F.when(fault == 4, F.lit("1 lot")).otherwise(F.coalesce(F.col("volume").cast("long").cast("string"), F.lit(""))),
    ]
    fields.append(F.when(fault != 2, F.col("ticker")))
    fields.append(F.when(fault == 3, F.lit("x")))
    return rows.select(F.concat_ws(",", *fields).alias(",".join(schemas.OHLCV_DAILY.names)))


def landing_rejects(spark, sf):
    """Lines that a load could not read, with their snapshot and the reasons."""
    lake = _lake(spark)
    create_layers(spark, lake.databases, lake.tables_root)
    folder = f"{lake.ohlcv}/run_day={FIRST_RUN:%Y-%m-%d}/run_time={FIRST_RUN:%H-%M-%S}"
    lines = _faulty_lines(spark, sf).write.option("header", True).option("sep", "\u0001")  # a line is one field here
    lines.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    landed = lake.landing(spark, lake.ohlcv, schemas.OHLCV_DAILY, FIRST_RUN.date())
    table = f"{lake.bronze}.ohclv_bronze"
    load(
        landed, schemas.OHLCV_DAILY, lambda rows: bronze_ohlcv(rows, lake, FIRST_RUN), suites.ohlcv_suite(NOW), table, "one"
    )
    found = spark.table(f"{table}_landing_rejects")
    snapshot = F.regexp_extract("file_path", "run_day=([^/]+/run_time=[^/]+)/", 1).alias("snapshot")
    return found.select(snapshot, "raw_line", F.concat_ws(",", "reasons").alias("reasons"))


def _historical(spark, sf) -> Lake:
    lake = _lake(spark)
    _land_bars(_ohlcv(spark, sf), lake, FIRST_RUN)
    write_landing(_provider(_company(spark, sf), schemas.COMPANY_RENAME, schemas.COMPANY), lake.company, FIRST_RUN, compression=GZIP)
    rates = _fx_by_day(spark, sf)
    write_landing(_provider(rates, schemas.FX_HISTORIC_RENAME, schemas.FX_HISTORIC), lake.fx, FIRST_RUN, compression=GZIP)
    macro = _macro(spark, sf).withColumn("ISO3", F.col("country_id"))
    write_landing(_provider(macro, schemas.MACRO_RENAME, schemas.MACRO), lake.macro, FIRST_RUN, compression=GZIP)
    run_historical(spark, lake, FIRST_RUN, fail_fast=True)
    return lake


def historical_silver(spark, sf):
    """Bars after the full refresh: landing, bronze, validation, ranking, contract, ids."""
    return spark.table(f"{_historical(spark, sf).silver}.ohclv_silver").drop(MONTH)


def historical_fx(spark, sf):
    """Rates after the full refresh; many per day are landed, some without a date."""
    return spark.table(f"{_historical(spark, sf).silver}.exchange_rates_silver").drop(MONTH, "rate_id")


def historical_gold(spark, sf):
    """Macro facts read from the catalog view after the full refresh."""
    facts = spark.table(f"{_historical(spark, sf).gold}.macro_facts")
    return facts.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in facts.dtypes])


def historical_stock_view(spark, sf):
    """Price facts read from the catalog view after the full refresh."""
    facts = _rounded_facts(spark.table(f"{_historical(spark, sf).gold}.stock_facts"))
    return facts.withColumn("stock_90_day_average", F.round("stock_90_day_average", 6))


def macro_rejects(spark, sf):
    """Macro rows without a country, as the full refresh keeps them."""
    rows = spark.table(f"{_historical(spark, sf).bronze}.macro_economic_data_bronze_rejects").drop("run")
    return rows.withColumn("reasons", F.concat_ws(",", "reasons"))


def layer_metrics_report(spark, sf):
    """The CSV report of the full refresh: rows and NULLs of each loaded table."""
    path = f"{_historical(spark, sf).reports}/bronze_layer_metrics"
    return spark.read.schema("table_name string, total_records bigint, total_null_values bigint").csv(path, header=True)


def suite_report(spark, sf):
    """The JSON report of the full refresh on the company table."""
    lake = _historical(spark, sf)
    schema = suites.company_suite().run(spark.table(f"{lake.bronze}.company_meta_data_bronze")).schema
    return spark.read.schema(schema).json(f"{lake.reports}/company_meta_data_bronze")


def _daily_halves(spark, sf):
    bars, rates = _ohlcv(spark, sf), _fx_by_day(spark, sf)
    return (
        (bars.filter("batch <= 3"), bars.filter("batch > 3")),
        (rates.filter("insert_order % 2 = 0"), rates.filter("insert_order % 2 = 1")),
    )


def _daily(spark, sf) -> Lake:
    lake, (bars, rates) = _lake(spark), _daily_halves(spark, sf)
    for run, b, r in zip((FIRST_RUN, SECOND_RUN), bars, rates):
        _land_bars(b, lake, run)
        _land_rates(r, lake, run)
        run_daily(spark, lake, run, fail_fast=True)
    return lake


def daily_silver(spark, sf):
    """Bars after two daily increments, the second over the first."""
    return spark.table(f"{_daily(spark, sf).silver}.ohclv_silver").drop(MONTH, "stock_id")


def daily_fx_silver(spark, sf):
    """Rates after two daily increments."""
    return spark.table(f"{_daily(spark, sf).silver}.exchange_rates_silver").drop(MONTH, "rate_id")


def lineage_ohlcv(spark, sf):
    """Every bar that passed the staging contract, with the run that brought it."""
    lineage = spark.table(f"{_daily(spark, sf).bronze}.ohclv_daily_lineage").drop(MONTH, "id")
    return lineage.withColumn("insert_datetime", F.col("insert_datetime").cast("timestamp_ntz"))


def _reasons(spark, tables) -> DataFrame:
    found = [spark.table(t).select(F.trim("ticker").alias("ticker"), "date", F.concat_ws(",", "reasons").alias("reasons")) for t in tables]
    return reduce(DataFrame.unionByName, found)


def daily_rejects(spark, sf):
    """Bars that the contracts of the two increments rejected."""
    lake = _daily(spark, sf)
    return _reasons(spark, [f"{lake.bronze}.ohclv_daily_bronze_rejects", f"{lake.silver}.ohclv_daily_rejects"])


def _tree_lake(spark) -> Lake:
    return replace(_lake(spark), stamped=False, writes_tree=True)


def _tree_bars(spark, sf) -> DataFrame:
    """Hourly bars as several rows of their day, in file layout; some tickers are padded."""
    padded = F.when(F.hour("bar_ts") % 2 == 0, F.concat(F.lit(" "), F.col("ticker"))).otherwise(F.col("ticker"))
    rows = _bars(spark, sf).withColumns({"ticker": padded, "date": F.to_date("bar_ts"), "hour": F.hour("bar_ts")})
    return rows.withColumnsRenamed({v: k for k, v in schemas.OHLCV_RENAME.items()})


def _land_tree(rows: DataFrame, lake: Lake, run: dt.datetime) -> None:
    write_landing_tree(rows, lake.ohlcv, run, "stock", "COMPANY_TICKER", schemas.OHLCV_DAILY.names)


def daily_tree_silver(spark, sf):
    """Bars after two increments from the dated tree; of two snapshots of the second day the newer one counts."""
    lake, rows = _tree_lake(spark), _tree_bars(spark, sf)
    for run, part in ((FIRST_RUN, "hour < 12"), (SECOND_RUN.replace(hour=9), "hour >= 6"), (SECOND_RUN, "hour >= 12")):
        _land_tree(rows.filter(part), lake, run)
    for run, rates in zip((FIRST_RUN, SECOND_RUN), _daily_halves(spark, sf)[1]):
        write_landing_tree(_provider(rates, schemas.FX_DAILY_RENAME, schemas.FX_DAILY), lake.fx, run, "exchange_rate")
        run_daily(spark, lake, run, fail_fast=True)
    return spark.table(f"{lake.silver}.ohclv_silver").drop(MONTH, "stock_id")


def historical_tree_silver(spark, sf):
    """Bars after the full refresh of all tables from the dated tree, the folder naming the ticker."""
    lake, rows = _tree_lake(spark), _tree_bars(spark, sf).withColumn("folder", F.trim("COMPANY_TICKER"))
    rows = rows.withColumn("COMPANY_TICKER", F.lit("of the file"))
    write_landing_tree(rows, lake.ohlcv, FIRST_RUN, "stock", "folder", schemas.OHLCV_DAILY.names)
    company = _provider(_company(spark, sf), schemas.COMPANY_RENAME, schemas.COMPANY)
    write_landing_tree(company, lake.company, FIRST_RUN, "company_metadata")
    rates = _provider(_fx_by_day(spark, sf), schemas.FX_HISTORIC_RENAME, schemas.FX_HISTORIC)
    write_landing_tree(rates, lake.fx, FIRST_RUN, "exchange_rate")
    macro = _macro(spark, sf).withColumn("ISO3", F.col("country_id"))
    write_landing_tree(_provider(macro, schemas.MACRO_RENAME, schemas.MACRO), lake.macro, FIRST_RUN, "macro_data")
    run_historical(spark, lake, FIRST_RUN, fail_fast=True)
    return spark.table(f"{lake.silver}.ohclv_silver").drop(MONTH)


def _streamed(spark, sf) -> Lake:
    """The same two snapshots as a file stream, the newer one arriving first."""
    lake, (bars, _) = _lake(spark), _daily_halves(spark, sf)
    checkpoint = scratch_path(spark, "stream")
    for run, b in ((SECOND_RUN, bars[1]), (FIRST_RUN, bars[0])):
        _land_bars(b, lake, run)
        stream_bars(spark, lake, checkpoint).awaitTermination()
    return lake


def stream_silver(spark, sf):
    """Bars after the stream: the same rows as after the two increments."""
    return spark.table(f"{_streamed(spark, sf).silver}.ohclv_silver").drop(MONTH, "stock_id")


def stream_suite_report(spark, sf):
    """The reports of the stream's two micro-batches, each on the rows that it staged."""
    lake = _streamed(spark, sf)
    schema = suites.ohlcv_stream_suite().run(spark.table(f"{lake.bronze}.ohclv_daily_lineage")).schema
    return spark.read.schema(schema.add("batch", "string")).json(f"{lake.reports}/ohclv_daily_bronze_stream")


def stream_rejects(spark, sf):
    """Bars that the contracts of the stream rejected."""
    lake = _streamed(spark, sf)
    return _reasons(
        spark, [f"{lake.bronze}.ohclv_daily_lineage_stream_rejects", f"{lake.silver}.ohclv_silver_stream_rejects"]
    )


QUERIES: dict[str, Query] = {
    "stock_facts": stock_facts,
    "stock_facts_split": stock_facts_split,
    "stock_facts_silver": stock_facts_silver,
    "stock_facts_increment": stock_facts_increment,
    "stock_facts_wide": stock_facts_wide,
    "macro_facts": macro_facts,
    "macro_facts_compat": macro_facts_compat,
    "rank_trim_ohlcv": rank_trim_ohlcv,
    "rank_trim_company": rank_trim_company,
    "rank_trim_fx": rank_trim_fx,
    "rank_trim_fx_split": rank_trim_fx_split,
    "rank_trim_macro": rank_trim_macro,
    "dedup_ohlcv": dedup_ohlcv,
    "dedup_company": dedup_company,
    "clean_company": clean_company,
    "dedup_fx": dedup_fx,
    "dedup_macro": dedup_macro,
    "dedup_daily": dedup_daily,
    "macro_median_fill": macro_median_fill,
    "macro_median_fill_split": macro_median_fill_split,
    "macro_median_increment": macro_median_increment,
    "macro_ungrouped": macro_ungrouped,
    "year_filter": macro_year_filter,
    "contract_ohlcv": contract_ohlcv,
    "contract_rejects": contract_rejects,
    "contract_company": contract_company,
    "contract_company_rejects": contract_company_rejects,
    "contract_fx": contract_fx,
    "contract_macro": contract_macro,
    "unique_violations": unique_violations_ohlcv,
    "surrogate_key": surrogate_key_ohlcv,
    "upsert_ohlcv": upsert_ohlcv,
    "upsert_fx": upsert_fx,
    "dq_suite_ohlcv": dq_suite_ohlcv,
    "dq_suite_ohlcv_daily": dq_suite_ohlcv_daily,
    "dq_suite_company": dq_suite_company,
    "dq_suite_fx": dq_suite_fx,
    "dq_suite_fx_daily": dq_suite_fx_daily,
    "dq_suite_macro": dq_suite_macro,
    "dq_summary_company": dq_summary_company,
    "dq_samples_company": dq_samples_company,
    "dq_quarantine_company": dq_quarantine_company,
    "null_profile": null_profile_layers,
    "latest_snapshot": latest_snapshot_rows,
    "path_parts": path_parts,
    "json_rates_explode": json_rates_explode,
    "json_rate_flatten": json_rate_flatten,
    "json_variant_rates": json_variant_rates,
    "json_pick_keys": json_pick_keys,
    "provider_columns": provider_columns,
    "landing_snapshot": landing_snapshot,
    "landing_tree": landing_tree,
    "landing_rejects": landing_rejects,
    "historical_silver": historical_silver,
    "historical_fx": historical_fx,
    "historical_gold": historical_gold,
    "historical_stock_view": historical_stock_view,
    "macro_rejects": macro_rejects,
    "layer_metrics_report": layer_metrics_report,
    "suite_report": suite_report,
    "daily_silver": daily_silver,
    "daily_fx_silver": daily_fx_silver,
    "lineage_ohlcv": lineage_ohlcv,
    "daily_rejects": daily_rejects,
    "daily_tree_silver": daily_tree_silver,
    "historical_tree_silver": historical_tree_silver,
    "stream_silver": stream_silver,
    "stream_rejects": stream_rejects,
    "stream_suite_report": stream_suite_report,
}
