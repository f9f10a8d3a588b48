"""Schemas of the landing files and of every table, with the contracts of the typed layers."""

from __future__ import annotations

from pyspark.sql import types as T

from marketlake.operators.contract import ColumnRule, Contract


def _schema(**columns: str) -> T.StructType:
    schema = T.StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema


# Column names of the landing files, in file order.
OHLCV_DAILY = _schema(
    Date="date", CLOSE="double", HIGH="double", LOW="double", OPEN="double", VOLUME="double", COMPANY_TICKER="string"
)
OHLCV_HISTORIC = _schema(
    **{"Date": "date", "ADJ CLOSE": "double", "CLOSE": "double", "HIGH": "double", "LOW": "double", "OPEN": "double"},
    VOLUME="double",
    COMPANY_TICKER="string",
)
COMPANY = _schema(
    companyName="string", symbol="string", price="double", marketCap="double", sector="string", industry="string"
)
FX_HISTORIC = _schema(Date="date", INR_amount="double", USD_rate="double")
FX_DAILY = _schema(date="date", inr_rate="double", USD_rate="double")
MACRO = _schema(
    ISO3="string",
    countryname="string",
    id="string",
    year="integer",
    NOMINAL_GDP="double",
    REAL_GDP="double",
    INFLATION="double",
    UNEMPLOYMENT="double",
)

# Landing column -> table column.
OHLCV_RENAME = {
    "Date": "date",
    "OPEN": "open",
    "HIGH": "high",
    "LOW": "low",
    "CLOSE": "close",
    "VOLUME": "volume",
    "COMPANY_TICKER": "ticker",
}
COMPANY_RENAME = {"companyName": "company_name", "symbol": "ticker", "marketCap": "market_cap"}
FX_HISTORIC_RENAME = {"Date": "date", "INR_amount": "inr_rate", "USD_rate": "usd_amount"}
FX_DAILY_RENAME = {"USD_rate": "usd_amount"}
MACRO_PROVIDER_RENAME = {
    "nGDP": "NOMINAL_GDP",
    "rGDP": "REAL_GDP",
    "infl": "INFLATION",
    "unemp": "UNEMPLOYMENT",
}
MACRO_RENAME = {
    "id": "country_id",
    "countryname": "country_name",
    "NOMINAL_GDP": "nominal_gdp",
    "REAL_GDP": "real_gdp",
    "INFLATION": "inflation",
    "UNEMPLOYMENT": "unemployment",
}
COMPANY_KEYS = ("companyName", "symbol", "price", "marketCap", "sector", "industry")

# Bronze columns, in table order, without the surrogate id.
OHLCV_COLUMNS = ["ticker", "date", "open", "high", "low", "close", "volume"]
COMPANY_COLUMNS = ["company_name", "ticker", "price", "market_cap", "sector", "industry"]
FX_COLUMNS = ["date", "inr_rate", "usd_amount"]
MACRO_COLUMNS = [
    "country_id",
    "year",
    "country_name",
    "nominal_gdp",
    "real_gdp",
    "inflation",
    "unemployment",
]
MACRO_MEASURES = ["NOMINAL_GDP", "REAL_GDP", "INFLATION", "UNEMPLOYMENT"]


def _prices(kind: str) -> tuple[ColumnRule, ...]:
    return tuple(ColumnRule(c, kind) for c in ("open", "high", "low", "close"))


def _bars(name: str, ticker_length: int, price: str, stamp: str, unique: bool) -> Contract:
    return Contract(
        name,
        (
            ColumnRule("ticker", "string", max_length=ticker_length),
            ColumnRule("date", "date"),
            *_prices(price),
            ColumnRule("volume", "bigint"),
            ColumnRule("insert_datetime", stamp),
        ),
        ("ticker", "date") if unique else (),
    )


def _rates(name: str, amount: str, stamp: str, unique: bool) -> Contract:
    return Contract(
        name,
        (
            ColumnRule("date", "date"),
            ColumnRule("inr_rate", "double"),
            ColumnRule("usd_amount", amount),
            ColumnRule("insert_datetime", stamp),
        ),
        ("date",) if unique else (),
    )


OHLCV_SILVER = _bars("ohclv_silver", 10, "decimal(6,2)", "date", True)
OHLCV_DAILY_LINEAGE = _bars("ohclv_daily_lineage", 20, "double", "timestamp", True)
OHLCV_DAILY_BRONZE = _bars("ohclv_daily_bronze", 20, "decimal(6,2)", "timestamp", False)
#: What silver accepts, with the time of the snapshot: by it the stream knows the newest accepted row of a key.
OHLCV_ACCEPTED = _bars("ohclv_daily_accepted", 10, "decimal(6,2)", "timestamp", True)
FX_ACCEPTED = _rates("exchange_daily_accepted", "smallint", "timestamp", True)
FX_SILVER = _rates("exchange_rates_silver", "smallint", "date", True)
FX_DAILY_LINEAGE = _rates("exchange_daily_lineage", "int", "timestamp", True)
FX_DAILY_BRONZE = _rates("exchange_daily_bronze", "int", "timestamp", False)
COMPANY_SILVER = Contract(
    "company_meta_data_silver",
    (
        ColumnRule("company_name", "string", max_length=100),
        ColumnRule("ticker", "string", max_length=10),
        ColumnRule("price", "decimal(6,2)"),
        ColumnRule("market_cap", "bigint"),
        ColumnRule("sector", "string", max_length=50),
        ColumnRule("industry", "string", max_length=50),
    ),
)
MACRO_SILVER = Contract(
    "macro_economic_data_silver",
    (
        ColumnRule("country_name", "string", max_length=50),
        ColumnRule("country_code", "string", max_length=25),
        ColumnRule("year", "int"),
        ColumnRule("nominal_gdp", "double"),
        ColumnRule("real_gdp", "double"),
        ColumnRule("inflation", "double"),
        ColumnRule("unemployment", "double"),
    ),
)
