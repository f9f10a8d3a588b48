"""Provider tables and payloads to landing snapshots. Fetching them is left to the caller."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators.fill import year_filter
from marketlake.plans.lake import Lake
from marketlake.sources.payloads import explode_rates, flatten_rate, pick_keys, upper_headers
from marketlake.sources.tables import write_landing, write_landing_tree

PRICES = ("CLOSE", "HIGH", "LOW", "OPEN")


def provider_bars(bars: DataFrame, ticker: str | None = None) -> DataFrame:
    """Provider bars in file layout: headers in upper case, prices to two places, the ticker as a column."""
    named = upper_headers(bars).withColumnRenamed("DATE", "Date")
    if ticker is not None:
        named = named.withColumn("COMPANY_TICKER", F.lit(ticker))
    return named.withColumns({c: F.round(c, 2) for c in PRICES}).select(*schemas.OHLCV_DAILY.names)


def provider_macro(panel: DataFrame, start: str, end: str) -> DataFrame:
    """The years between two dates of a macro panel, under the file's column names."""
    named = year_filter(panel, "year", start, end).withColumnsRenamed(schemas.MACRO_PROVIDER_RENAME)
    return named.select(*schemas.MACRO.names)


def _land(rows: DataFrame, lake: Lake, root: str, run: dt.datetime, name: str, by: str | None = None) -> None:
    """A snapshot in the layout that the lake reads; a dated tree that a provider fills is not written to."""
    if lake.stamped:
        write_landing(rows, root, run)
    elif lake.writes_tree:
        write_landing_tree(rows, root, run, name, by)
    else:
        raise ValueError("snapshots are landed with Lake(stamped=True) or Lake(writes_tree=True)")


def land_bars(bars: DataFrame, lake: Lake, run: dt.datetime, ticker: str | None = None) -> None:
    _land(provider_bars(bars, ticker), lake, lake.ohlcv, run, "stock", "COMPANY_TICKER")


def land_macro(panel: DataFrame, lake: Lake, run: dt.datetime, start: str, end: str) -> None:
    _land(provider_macro(panel, start, end), lake, lake.macro, run, "macro_data")


def land_companies(payloads: DataFrame, lake: Lake, run: dt.datetime, body: str = "body") -> None:
    _land(pick_keys(payloads, body), lake, lake.company, run, "company_metadata")


def land_rates(payloads: DataFrame, lake: Lake, run: dt.datetime, body: str = "body", history: bool = False) -> None:
    """One row per date of a rate history, or the single rate of a latest-rate payload."""
    _land((explode_rates if history else flatten_rate)(payloads, body), lake, lake.fx, run, "exchange_rate")
