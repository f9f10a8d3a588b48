"""Shaping of JSON provider payloads into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.schemas import COMPANY_KEYS


def explode_rates(df: DataFrame, payload: str, currency: str = "INR") -> DataFrame:
    """``{"rates": {date: {currency: x}}}`` to one row (Date, INR_amount, USD_rate = 1) per date."""
    schema = f"rates MAP<STRING, STRUCT<{currency}: DOUBLE>>"
    rates = df.select(F.from_json(payload, schema).alias("p")).select(F.explode("p.rates").alias("day", "rate"))
    return rates.select(
        F.to_date("day").alias("Date"),
        F.col(f"rate.{currency}").alias(f"{currency}_amount"),
        F.lit(1).alias("USD_rate"),
    )


def flatten_rate(df: DataFrame, payload: str, currency: str = "INR") -> DataFrame:
    """``{"date": d, "rates": {currency: x}, ...}`` to (date, inr_rate, USD_rate = 1)."""
    parsed = df.select(F.from_json(payload, f"date STRING, rates STRUCT<{currency}: DOUBLE>").alias("p"))
    return parsed.select(
        F.to_date("p.date").alias("date"),
        F.col(f"p.rates.{currency}").alias(f"{currency.lower()}_rate"),
        F.lit(1).alias("USD_rate"),
    )


def variant_rates(df: DataFrame, payload: str, currency: str = "INR") -> DataFrame:
    """Rates of payloads whose shape changes, one row (date, rate, other) per rate, beside the other columns of ``df``.

    ``rates`` may be an object by date (``{date: {currency: x}}``), a list (``[{"date": d, currency: x}]``), or the single
    rate of the payload's own ``date`` (``{currency: x}``). A payload without rates, or one that is no JSON object, keeps
    one row with neither date nor rate. ``other`` holds the payload's remaining fields as JSON texts by name.
    """
    names = [F.col(f"`{c}`") for c in df.columns if c != payload]
    known = ("rates", "date")
    fields = F.try_variant_get(F.col("_payload"), "$", "map<string,variant>")
    parsed = df.withColumn("_payload", F.try_parse_json(payload)).select(
        *names,
        F.try_variant_get("_payload", "$.date", "string").alias("_day"),
        F.try_variant_get("_payload", "$.rates", "variant").alias("_rates"),
        F.transform_values(
            F.map_filter(fields, lambda name, _: ~name.isin(*known)), lambda _, value: F.to_json(value)
        ).alias("other"),
    )
    table = df.sparkSession.tvf.variant_explode_outer(F.col("_rates").outer())
    entries = parsed.lateralJoin(table)
    value = F.col("value")
    single = F.col("key") == currency
    return entries.filter(F.col("key").isNull() | single | F.schema_of_variant(value).startswith("OBJECT")).select(
        *names,
        F.to_date(
            F.when(single, F.col("_day")).otherwise(
                F.coalesce(F.col("key"), F.try_variant_get(value, "$.date", "string"))
            )
        ).alias("date"),
        F.when(single, F.try_variant_get(value, "$", "double"))
        .otherwise(F.try_variant_get(value, f"$.{currency}", "double"))
        .alias("rate"),
        "other",
    )


def pick_keys(
    df: DataFrame, payload: str, keys: Sequence[str] = COMPANY_KEYS, numbers: Sequence[str] = ("price", "marketCap")
) -> DataFrame:
    """Selected keys of the first object of a payload list; an absent key is NULL."""
    fields = ", ".join(f"`{k}` {'DOUBLE' if k in numbers else 'STRING'}" for k in keys)
    first: Column = F.try_element_at(F.from_json(payload, f"ARRAY<STRUCT<{fields}>>"), F.lit(1))
    return df.select(first.alias("p")).filter("p is not null").select("p.*")


def upper_headers(df: DataFrame) -> DataFrame:
    """Column names in upper case."""
    return df.toDF(*[c.upper() for c in df.columns])
