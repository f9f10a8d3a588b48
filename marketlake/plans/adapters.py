"""Views that shape general order, customer and event tables like the market-data inputs.

They carry deliberate faults (padded keys, gaps, bounds broken, duplicate keys) so that every rule
and every repair has rows to work on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast(MONEY)


def bars(events: DataFrame) -> DataFrame:
    """Hourly price bars per event type; ties in time are broken by the event id."""
    placed = F.struct("ts", "event_id")
    price = F.col("value").try_cast("decimal(6,2)")
    return (
        events.select(
            F.upper("event_type").alias("ticker"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("bar_ts"),
            price.alias("price"),
            placed.alias("placed"),
        )
        .groupBy("ticker", "bar_ts")
        .agg(
            F.min_by("price", "placed").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "placed").alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


def cents(value: str) -> Column:
    """A two-decimal double as whole cents."""
    return F.floor(F.col(value) * 100 + 0.5)


def ohlcv_rows(lineitem: DataFrame) -> DataFrame:
    """Raw monthly bars: padded tickers, repeated (ticker, date) keys, high below low, missing volume."""
    line = F.col("l_linenumber")
    name = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    ticker = (
        F.when(line % 3 == 0, F.concat(F.lit(" "), name, F.lit("  ")))
        .when((line == 5) & (F.col("l_returnflag") == "N"), F.lower(name))
        .otherwise(name)
    )
    price, up, down = cents("l_extendedprice"), cents("l_discount"), cents("l_tax")
    base = lineitem.select(
        "l_linenumber",
        "l_returnflag",
        ticker.alias("ticker"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("date"),
        F.when(down == 8, price).otherwise(F.call_function("div", price * 5 + 50, F.lit(100))).alias("open"),
        (F.col("l_quantity").cast("long") - 25).alias("move"),
        up.alias("up"),
        down.alias("down"),
        F.when(up != 10, F.col("l_quantity") * 100).alias("volume"),
        F.col("l_shipdate").alias("insert_datetime"),
    )
    base = base.withColumn("close", F.col("open") + F.col("move"))
    low = F.least("open", "close") - F.col("down")
    crossed = (line == 7) & (F.col("l_returnflag") == "R")
    high = F.when(crossed, low - 1).otherwise(F.greatest("open", "close") + F.col("up"))
    prices = {"open": F.col("open"), "high": high, "low": low, "close": F.col("close")}
    return base.select(
        "ticker",
        "date",
        *[(value / 100.0).alias(name) for name, value in prices.items()],
        "volume",
        "insert_datetime",
        F.col("l_linenumber").alias("batch"),
    )


def company_rows(customer: DataFrame) -> DataFrame:
    """Company profiles: repeated tickers, prices at or below zero, names and sectors off the list."""
    key = F.col("c_custkey")
    sector = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "Technology")
        .when(F.col("c_mktsegment") == "FURNITURE", "Consumer Cyclical")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Consumer Defensive")
        .when(F.col("c_mktsegment") == "BUILDING", "Financial Services")
        .otherwise("Industrials")
    )
    group = F.col("c_nationkey") % 3
    industry = (
        F.when(group == 0, "Semiconductors")
        .when(group == 1, "Discount Stores")
        .otherwise("Airlines, Airports & Air Services")
    )
    plain = F.translate(F.col("c_name"), "#", " ")
    name = F.when(key % 10 == 0, F.col("c_name")).otherwise(F.concat(F.lit("  "), plain))
    return customer.select(
        name.alias("company_name"),
        F.concat(F.lit("C"), (key.bitwiseAND(1023)).cast("string"), F.lit(" ")).alias("ticker"),
        F.when(key % 50 != 0, F.col("c_acctbal")).alias("price"),
        (F.col("c_acctbal") * 100.25).alias("market_cap"),
        sector.alias("sector"),
        industry.alias("industry"),
        F.date_add(F.lit("2025-12-17").cast("date"), (key % 5).cast("int")).alias("insert_datetime"),
    )


def fx_rows(events: DataFrame) -> DataFrame:
    """One rate per event: many rates per day, rates with too many decimals, missing dates."""
    user = F.col("user_id")
    return events.select(
        F.when(~((F.col("event_type") == "error") & (F.col("value") < 1)), F.col("ts")).alias("date"),
        (F.col("value") / 8).alias("inr_rate"),
        F.when(user % 19 == 0, 0.0).when(user % 17 != 0, 1.0).alias("usd_amount"),
        F.col("event_id").alias("insert_order"),
    )


def macro_rows(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One observation per order, by its customer's country: gaps, one country without unemployment."""
    homes = customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    joined = orders.join(homes, "o_custkey").join(nation, "n_nationkey")
    key, year = F.col("n_nationkey"), F.year("o_orderdate")
    code = F.when(key != 24, F.concat(F.lit("N"), key.cast("string")))
    return joined.select(
        code.alias("country_id"),
        F.concat(F.lit(" "), F.col("n_name")).alias("country_name"),
        year.alias("year"),
        F.col("o_totalprice").alias("nominal_gdp"),
        F.when((F.col("o_orderkey") + key) % 3 != 0, F.col("o_totalprice") - 1000).alias("real_gdp"),
        F.when((F.col("o_orderkey") % 4) != 0, (F.col("o_orderkey") % 31 - 60).cast("double")).alias("inflation"),
        F.when((key != 7) & (F.col("o_orderkey") % 5 != 0), (F.col("o_orderkey") % 110).cast("double")).alias(
            "unemployment"
        ),
        F.col("o_orderdate").alias("insert_datetime"),
        F.col("o_orderkey").alias("insert_order"),
    )


def macro_series(rows: DataFrame) -> DataFrame:
    """One row per country and year; sums are exact decimals before they become doubles."""
    return (
        rows.filter("country_id is not null")
        .groupBy(F.col("country_id").alias("country_code"), F.trim("country_name").alias("country_name"), "year")
        .agg(
            F.sum(money("nominal_gdp")).cast("double").alias("nominal_gdp"),
            F.sum(money("real_gdp")).cast("double").alias("real_gdp"),
            (F.sum(money("inflation")).cast("long") % 7).cast("double").alias("inflation"),
            (F.sum(money("unemployment")).cast("long") % 23).cast("double").alias("unemployment"),
        )
    )
