"""The six validation suites. Dates and the current year are parameters, so results repeat."""

from __future__ import annotations

import datetime as dt

from marketlake.operators.quality import (
    Suite,
    between,
    in_set,
    length,
    match,
    not_match,
    not_null,
    pair,
    same_day,
)

# Patterns, bounds and the allowed sectors and industries.
TICKER = r"^[A-Z0-9]{1,7}$"
COMPANY_NAME = r"^(?=.{1,200}$)[A-Za-z0-9,.\-& ]+$"
RATE = r"^\d+(\.\d{1,3})?$"
BLANK = r"^\s*$"
FIRST_TRADE_DATE = dt.date(2000, 1, 1)
FIRST_RATE_DATE = dt.date(2019, 12, 1)
FIRST_MACRO_YEAR = 2020
SECTORS = (
    "Technology",
    "Consumer Cyclical",
    "Financial Services",
    "Consumer Defensive",
)
INDUSTRIES = (
    "Consumer Electronics",
    "Internet Content & Information",
    "Semiconductors",
    "Auto - Manufacturers",
    "Software - Infrastructure",
    "Specialty Retail",
    "Financial - Capital Markets",
    "Discount Stores",
    "Banks - Diversified",
    "Software - Application",
    "Information Technology Services",
    "Electronic Gaming & Multimedia",
)


def _ticker_rules():
    return not_null("ticker"), length("ticker", 1, 7), match("ticker", TICKER)


def _bar_rules(date_rule):
    return (
        *_ticker_rules(),
        not_null("date"),
        date_rule,
        *[not_null(c) for c in ("open", "high", "low", "close", "volume")],
        between("open", low=0, strict_low=True),
        between("volume", low=0),
        pair("high", "low"),
        pair("high", "open"),
        pair("close", "low"),
        pair("high", "close"),
    )


def ohlcv_suite(now: dt.date | dt.datetime) -> Suite:
    return Suite("bronze_ohclv_suit", _bar_rules(between("date", FIRST_TRADE_DATE, now)))


def ohlcv_daily_suite(today: dt.date) -> Suite:
    return Suite("daily_ohclv_suit", _bar_rules(between("date", today, today)))


def ohlcv_stream_suite() -> Suite:
    """The daily rules where rows of several days arrive together: a row's date is the day of its snapshot."""
    return Suite("daily_ohclv_suit", _bar_rules(same_day("date", "insert_datetime")))


def ohlcv_documented_suite(now: dt.date | dt.datetime) -> Suite:
    """The written rules, which also ask for positive lows."""
    rules = _bar_rules(between("date", FIRST_TRADE_DATE, now))
    return Suite("documented_ohclv_suit", (*rules, between("low", low=0, strict_low=True)))


def company_suite(sectors=SECTORS, industries=INDUSTRIES) -> Suite:
    return Suite(
        "bronze_meta_data_suit",
        (
            not_null("company_name"),
            length("company_name", 1, 200),
            match("company_name", COMPANY_NAME),
            *_ticker_rules(),
            between("price", low=0, strict_low=True),
            not_null("market_cap"),
            between("market_cap", low=0),
            not_null("sector"),
            in_set("sector", sectors),
            not_null("industry"),
            in_set("industry", industries),
        ),
    )


def company_documented_suite(sectors=SECTORS, industries=INDUSTRIES) -> Suite:
    """The written rules, which also ask for a price."""
    rules = company_suite(sectors, industries).expectations
    return Suite("documented_meta_data_suit", (*rules, not_null("price")))


def _rate_rules(date_rule):
    return (
        not_null("date"),
        date_rule,
        not_null("inr_rate"),
        between("inr_rate", low=0, strict_low=True),
        match("inr_rate", RATE),
        not_null("usd_amount"),
        between("usd_amount", low=0, strict_low=True),
    )


def fx_suite(now: dt.date | dt.datetime) -> Suite:
    return Suite("bronze_exchange_suit", _rate_rules(between("date", FIRST_RATE_DATE, now)))


def fx_daily_suite(today: dt.date) -> Suite:
    return Suite("daily_exchg_suit", _rate_rules(between("date", today, today)))


def fx_stream_suite() -> Suite:
    """As ``ohlcv_stream_suite``."""
    return Suite("daily_exchg_suit", _rate_rules(same_day("date", "insert_datetime")))


def macro_suite(current_year: int, first_year: int = FIRST_MACRO_YEAR, max_inflation: float = 20000) -> Suite:
    return Suite(
        "bronze_macro_suit",
        (
            not_null("country_id"),
            length("country_id", 2, 10),
            not_null("year"),
            between("year", first_year, current_year),
            not_null("country_name"),
            length("country_name", 1, 200),
            not_match("country_name", BLANK),
            between("nominal_gdp", low=0),
            between("real_gdp", low=0),
            between("inflation", -50, max_inflation),
            between("unemployment", 0, 100),
        ),
    )


def macro_documented_suite(current_year: int) -> Suite:
    """The written rules: years from 1900, inflation up to 200."""
    return macro_suite(current_year, first_year=1900, max_inflation=200)
