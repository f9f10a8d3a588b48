import datetime as dt
import math
import statistics
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from marketlake.operators.series import over_series
from marketlake.plans.gold import macro_facts, stock_facts

SCHEMA = "ticker string, date date, open {0}, high {0}, low {0}, close {0}, volume bigint, stock_id bigint"


def closes(seed, n):
    return [round(50 + ((i * seed) % 97) * 1.37, 2) for i in range(n)]


@pytest.fixture
def prices(spark):
    """A long series with gaps in its dates, a short one, and a one-row one."""
    data, day = [], dt.date(2020, 1, 1)
    for ticker, values in (("A", closes(31, 250)), ("B", closes(17, 5)), ("C", [9.5])):
        for i, c in enumerate(values):
            data.append((ticker, day + dt.timedelta(days=i + i // 5 * 2), c, c, c, c, i, len(data)))
    df = spark.createDataFrame(data, SCHEMA.format("double"))
    return df.withColumns({c: F.col(c).cast("decimal(6,2)") for c in ("open", "high", "low", "close")})


def expected(values):
    returns = [None] + [round((b - a) / a, 6) for a, b in zip(values, values[1:])]
    out = []
    for i in range(len(values)):
        window = [r for r in returns[max(0, i - 29): i + 1] if r is not None]
        out.append((returns[i], statistics.stdev(window) if len(window) > 1 else None,
                    statistics.fmean(values[max(0, i - 89): i + 1])))
    return out


def close_to(a, b, tolerance):
    return (a is None and b is None) or math.isclose(a, b, abs_tol=tolerance)


@pytest.mark.parametrize("limit", [1000, 120])
def test_stock_facts(prices, limit):
    facts = stock_facts(prices, max_group_rows=limit)
    for ticker, values in (("A", closes(31, 250)), ("B", closes(17, 5)), ("C", [9.5])):
        got = facts.filter(F.col("ticker") == ticker).orderBy("trade_date").collect()
        for row, (change, deviation, mean) in zip(got, expected(values), strict=True):
            assert close_to(row.daily_return, change, 1.1e-6)
            assert close_to(row.volatility_days_30, deviation, 1e-5)
            assert close_to(row.stock_90_day_average, mean, 6e-7)
            assert row.stock_id == f"STK_{ticker}"


def test_split_series_equal_whole_series(prices):
    whole = stock_facts(prices).withColumn("volatility_days_30", F.round("volatility_days_30", 9))
    split = stock_facts(prices, max_group_rows=95).withColumn("volatility_days_30", F.round("volatility_days_30", 9))
    assert rows(whole) == rows(split)
    assert whole.columns == split.columns


def test_the_width_of_a_decimal_changes_nothing(prices):
    want = rows(stock_facts(prices).select("ticker", "trade_date", "daily_return", "volatility_days_30", "stock_90_day_average"))
    for kind in ("decimal(9,2)", "decimal(10,2)", "decimal(24,2)", "decimal(24,6)"):
        wide = prices.withColumns({c: F.col(c).cast(kind) for c in ("open", "high", "low", "close")})
        got = stock_facts(wide).select("ticker", "trade_date", "daily_return", "volatility_days_30", "stock_90_day_average")
        assert rows(got) == want, kind


def test_wide_closes_are_exact(spark):
    """Closes beyond what doubles tell apart; returns and averages against whole numbers."""
    values = [Decimal("123456789012345678.25") + Decimal(i * i) / 4 for i in range(120)]
    data = [("W", dt.date(2020, 1, 1) + dt.timedelta(days=i), v, v, v, v, 1, i) for i, v in enumerate(values)]
    got = stock_facts(spark.createDataFrame(data, SCHEMA.format("decimal(22,2)"))).orderBy("trade_date").collect()

    def millionths(top, bottom):
        top, bottom = int(top), int(bottom)
        size = (2 * abs(top) * 10**6 + abs(bottom)) // (2 * abs(bottom))
        return (size if (top < 0) == (bottom < 0) else -size) / 1e6

    cents = [v * 100 for v in values]
    for i, row in enumerate(got):
        frame = cents[max(0, i - 89): i + 1]
        assert row.stock_90_day_average == millionths(sum(frame), 100 * len(frame))
        assert row.daily_return == (millionths(cents[i] - cents[i - 1], cents[i - 1]) if i else None)


def test_double_prices_use_doubles(prices):
    exact = stock_facts(prices).orderBy("ticker", "trade_date").collect()
    plain = prices.withColumns({c: F.col(c).cast("double") for c in ("open", "high", "low", "close")})
    for a, b in zip(exact, stock_facts(plain).orderBy("ticker", "trade_date").collect(), strict=True):
        assert close_to(a.daily_return, b.daily_return, 1e-6)
        assert close_to(a.stock_90_day_average, b.stock_90_day_average, 1e-6)


def test_zero_previous_close(spark):
    data = [("Z", dt.date(2020, 1, d), v, v, v, v, 1, d) for d, v in ((1, 0.0), (2, 5.0), (3, 10.0))]
    df = spark.createDataFrame(data, SCHEMA.format("double"))
    fixed = df.withColumn("close", F.col("close").cast("decimal(6,2)"))
    for prices in (df, fixed):
        got = [r.daily_return for r in stock_facts(prices).orderBy("trade_date").collect()]
        assert got == [None, None, 1.0]


def test_one_shuffle_and_one_sort(prices):
    plan = stock_facts(prices)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert plan.count("+- Window [") == 2


def test_lookback_reaches_over_small_blocks(spark):
    df = spark.range(50).select(F.lit("a").alias("k"), F.col("id").alias("t"))
    def far(d, w):
        return d.withColumn("back", F.lag("t", 7).over(w))

    got = over_series(df, ["k"], "t", 7, far, max_group_rows=3).orderBy("t").collect()
    assert [r.back for r in got] == [None] * 7 + list(range(43))


@pytest.fixture
def macro(spark):
    data = [
        ("A", "Aland", 2020, 100.0, 50.0, 2.0, 4.0, 1),
        ("A", "Aland", 2021, 110.0, 40.0, 0.0, 5.0, 2),
        ("A", "Aland", 2022, 0.0, 60.0, 3.0, 0.0, 3),
        ("A", "Aland", 2023, 10.0, 60.0, 4.0, 2.0, 4),
        ("B", "Bland", 2020, 1.0, 1.0, 1.0, 1.0, 5),
    ]
    return spark.createDataFrame(
        data,
        "country_code string, country_name string, year int, nominal_gdp double, real_gdp double,"
        " inflation double, unemployment double, data_id bigint",
    )


@pytest.mark.parametrize("limit", [100, 1])
def test_macro_facts(macro, limit):
    got = macro_facts(macro, max_group_rows=limit).filter("country_code = 'A'").orderBy("data_point_year").collect()
    assert [r.year_on_year_gdp_change for r in got] == [None, 0.1, -1.0, None]
    assert [r.year_on_real_gdp_change for r in got] == [None, -0.2, 0.5, 0.0]
    assert [r.inflation_change_year_on_year for r in got] == [None, -2.0, None, 1.0]
    assert [r.unemployment_change_year_on_year for r in got] == [None, 1.0, -5.0, None]


def test_macro_facts_compat_repeats_inflation(macro):
    got = macro_facts(macro, compat=True).collect()
    assert all(r.unemployment_change_year_on_year == r.inflation_change_year_on_year for r in got)


def test_dated_series_are_not_counted_first(spark, prices):
    spark.sparkContext.setJobGroup("build", "facts are only declared")
    try:
        stock_facts(prices)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
