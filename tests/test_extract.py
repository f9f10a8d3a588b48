import dataclasses
import datetime as dt
import json

import pytest
from conftest import rows

from marketlake.plans.daily import run_daily
from marketlake.plans.extract import land_bars, land_companies, land_macro, land_rates
from marketlake.plans.historical import run_historical
from marketlake.plans.lake import Run
from marketlake.streaming.daily import stream_daily

RUN = dt.datetime(2025, 12, 18, 17, 0, 0)


def test_provider_data_reaches_silver(spark, lake, tmp_path):
    lake = dataclasses.replace(lake, stamped=True)
    day = dt.date(2025, 12, 18)
    bars = spark.createDataFrame(
        [(day, 271.1949, 273.0, 266.0, 270.0, 1000.0)], "Date date, Close double, High double, Low double, Open double, Volume double"
    )
    rates = spark.createDataFrame([(json.dumps({"rates": {str(day): {"INR": 90.26}}}),)], "body string")
    profile = [{"companyName": "Apple Inc.", "symbol": "AAPL", "price": 271.19, "marketCap": 4e12, "sector": "Technology",
                "industry": "Consumer Electronics", "beta": 1.1}]
    panel = spark.createDataFrame(
        [("IND", "India", "IND", y, 1.0 * y, None, 4.0, 5.0) for y in (2018, 2020, 2026, 2030)],
        "ISO3 string, countryname string, id string, year int, nGDP double, rGDP double, infl double, unemp double",
    )
    land_bars(bars, lake, RUN, "AAPL")
    land_companies(spark.createDataFrame([(json.dumps(profile),)], "body string"), lake, RUN)
    land_rates(rates, lake, RUN, history=True)
    land_macro(panel, lake, RUN, "2020-01-01", "2026-01-05")
    assert set(run_historical(spark, lake, RUN).values()) == {"ok"}
    silver = spark.table(f"{lake.silver}.ohclv_silver").first()
    assert (silver.stock_id, silver.ticker, str(silver.close), silver.volume) == (1, "AAPL", "271.19", 1000)
    macro = spark.table(f"{lake.silver}.macro_economic_data_silver")
    assert rows(macro.select("year", "nominal_gdp", "real_gdp")) == [(2020, 2020.0, 0.0), (2026, 2026.0, 0.0)]
    assert spark.table(f"{lake.silver}.company_meta_data_silver").count() == 1

    daily = dataclasses.replace(lake, ohlcv=f"{tmp_path}/daily/ohlcv", fx=f"{tmp_path}/daily/fx")
    latest = {"amount": 1.0, "base": "USD", "date": "2025-12-19", "rates": {"INR": 90.5}}
    land_bars(bars.selectExpr("date_add(Date, 1) as Date", "Close + 1 as Close", "High", "Low", "Open", "Volume"), daily, RUN, "AAPL")
    land_rates(spark.createDataFrame([(json.dumps(latest),)], "body string"), daily, RUN)
    assert set(run_daily(spark, daily, RUN).values()) == {"ok"}
    assert rows(spark.table(f"{lake.silver}.ohclv_silver").select("stock_id", "close"))[1][0] == 2
    assert rows(spark.table(f"{lake.silver}.exchange_rates_silver").select("inr_rate", "usd_amount")) == [(90.26, 1), (90.5, 1)]
    for query in stream_daily(spark, daily, str(tmp_path / "stream")):
        query.awaitTermination()
    assert spark.table(f"{lake.silver}.ohclv_silver").count() == 2


def test_provider_data_reaches_silver_by_the_dated_tree(spark, lake):
    lake = dataclasses.replace(lake, writes_tree=True)
    day = dt.date(2025, 12, 18)
    bars = spark.createDataFrame(
        [(day, 271.1949, 273.0, 266.0, 270.0, 1000.0)], "Date date, Close double, High double, Low double, Open double, Volume double"
    )
    latest = {"amount": 1.0, "base": "USD", "date": "2025-12-18", "rates": {"INR": 90.5}}
    for ticker in ("AAPL", "^GSPC"):
        land_bars(bars, lake, RUN, ticker)
    land_rates(spark.createDataFrame([(json.dumps(latest),)], "body string"), lake, RUN)
    assert set(run_daily(spark, lake, RUN).values()) == {"ok"}
    silver = spark.table(f"{lake.silver}.ohclv_silver")
    assert [r[0] for r in rows(silver.select("ticker"))] == ["AAPL", "^GSPC"]
    assert rows(spark.table(f"{lake.silver}.exchange_rates_silver").select("inr_rate")) == [(90.5,)]


def test_landing_wants_the_layout_that_is_read(spark, lake):
    bodies = spark.createDataFrame([("{}",)], "body string")
    with pytest.raises(ValueError, match="stamped"):
        land_rates(bodies, lake, RUN)


def test_steps_side_by_side_are_recorded_and_fail_alone():
    def fail():
        raise RuntimeError("broken")

    def chain(name, action):
        def steps(own):
            own.step(f"{name}_one", action, ["before"])
            own.step(f"{name}_two", lambda: None, [f"{name}_one"])

        return steps

    run = Run()
    run.step("before", lambda: None)
    run.together(chain("a", lambda: None), chain("b", fail))
    assert list(run.steps) == ["before", "a_one", "a_two", "b_one", "b_two"]
    assert run.steps["a_two"] == "ok" and run.steps["b_one"] == "failed: broken"
    assert run.steps["b_two"] == "skipped: needs b_one"
    strict = Run(fail_fast=True, steps={"before": "ok"})
    with pytest.raises(RuntimeError, match="broken"):
        strict.together(chain("b", fail), chain("a", lambda: None))
    assert strict.steps["a_two"] == "ok" and "b_one" not in strict.steps
