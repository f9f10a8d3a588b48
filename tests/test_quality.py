import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from marketlake.functions.columns import number_text
from marketlake.operators.profile import null_profile
from marketlake.operators.quality import QualityError, Suite, between, in_set, match, not_match, not_null, pair
from marketlake.plans import suites

DAY = dt.date(2025, 12, 17)
BAR = "ticker string, date date, open double, high double, low double, close double, volume double"


def results(suite, df):
    return {r.rule: r for r in suite.run(df).collect()}


@pytest.fixture
def bars(spark):
    return spark.createDataFrame(
        [
            ("AAPL", DAY, 273.61, 273.62, 266.96, 271.19, 28864357.0),
            ("TGT", DAY, 97.0, 98.54, 96.0, 98.6, 1000.0),
        ],
        BAR,
    )


def test_daily_bars_break_one_rule(bars):
    suite = suites.ohlcv_daily_suite(DAY)
    failed = [r for r in suite.run(bars).collect() if not r.success]
    assert [(r.rule, r.unexpected_count) for r in failed] == [("pair_ge(high, close)", 1)]
    summary = Suite.summary(suite.run(bars)).first()
    assert (summary.success, summary.evaluated_expectations, summary.successful_expectations) == (False, 16, 15)
    assert [(r.rule, r.value, r.sample) for r in suite.samples(bars).collect()] == [
        ("pair_ge(high, close)", "98.54/98.6", 1)
    ]
    assert suite.samples(bars, positions=[1, 2]).count() == 0
    assert [r.ticker for r in suite.clean(bars)[1].collect()] == ["TGT"]


def test_daily_suite_wants_the_day_itself(bars):
    other = results(suites.ohlcv_daily_suite(dt.date(2025, 12, 18)), bars)
    assert other["between(date, low=2025-12-18, high=2025-12-18)"].unexpected_count == 2


def test_company_suite(spark):
    df = spark.createDataFrame(
        [
            ("American Airlines Group Inc.", "AAL", 15.51, 10237902499, "Industrials", "Airlines, Airports & Air Services"),
            ("Apple Inc.", "AAPL", 271.19, 4016803799520, "Technology", "Consumer Electronics"),
        ],
        "company_name string, ticker string, price double, market_cap bigint, sector string, industry string",
    )
    suite = suites.company_suite()
    got = suite.run(df).collect()
    assert len(got) == 13 and sum(r.success for r in got) == 11
    assert {r.column for r in got if not r.success} == {"sector", "industry"}
    assert [r.unexpected_percent for r in got if not r.success] == [50.0, 50.0]


def test_sizes_of_the_suites():
    today = dt.date(2026, 1, 5)
    sizes = {
        s.name: len(s.expectations)
        for s in (
            suites.ohlcv_suite(today), suites.ohlcv_daily_suite(today), suites.company_suite(),
            suites.fx_suite(today), suites.fx_daily_suite(today), suites.macro_suite(2026),
        )
    }
    assert sorted(sizes.values()) == [7, 7, 11, 13, 16, 16]


def test_repeated_rules_are_evaluated_once():
    suite = Suite("s", (between("a", low=0), not_null("a"), between("a", low=0)))
    assert len(suite.expectations) == 2


def test_nulls_and_limits(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 2.0), (3.0, None), (None, None), (0.0, 5.0)], "a double, b double")
    suite = Suite("s", (
        not_null("a"), between("a", low=0), between("a", low=0, strict_low=True),
        between("a", high=3, strict_high=True), pair("a", "b"), pair("a", "b", or_equal=False),
    ))
    got = list(suite.run(df).orderBy("position").collect())
    assert [r.unexpected_count for r in got] == [2, 0, 1, 1, 1, 2]
    assert [r.missing_count for r in got] == [0, 2, 2, 2, 1, 1]
    assert got[2].unexpected_percent == pytest.approx(100 / 3)
    assert got[2].unexpected_percent_total == 20.0


def test_rate_decimals(spark):
    df = spark.createDataFrame([(90.26,), (90.2601,), (71.0,), (12345678.125,), (0.5,), (None,)], "inr_rate double")
    suite = Suite("s", (match("inr_rate", suites.RATE),))
    assert [r.inr_rate for r in suite.failing_rows(df, suite.expectations[0]).collect()] == [90.2601]


def test_text_rules(spark):
    df = spark.createDataFrame([("a",), ("  ",), ("",), (None,)], "t string")
    suite = Suite("s", (not_match("t", suites.BLANK), in_set("t", ["a"])))
    assert [r.unexpected_count for r in suite.run(df).orderBy("position").collect()] == [2, 2]


def test_empty_table_passes(spark):
    suite = suites.ohlcv_suite(DAY)
    got = suite.run(spark.createDataFrame([], BAR)).collect()
    assert len(got) == 16 and all(r.success and r.element_count == 0 for r in got)
    assert all(r.unexpected_percent is None for r in got)


def test_failure_only_stops_when_asked(bars):
    suite = suites.ohlcv_daily_suite(DAY)
    assert suite.check(bars).count() == 16
    with pytest.raises(QualityError, match="high, close"):
        suite.check(bars, fail_on_error=True)


def test_documented_rules(spark, bars):
    assert "between(low, low=0, strict_low)" in results(suites.ohlcv_documented_suite(DAY), bars)
    assert len(suites.company_documented_suite().expectations) == 14
    rules = [e.rule for e in suites.macro_documented_suite(2026).expectations]
    assert "between(year, low=1900, high=2026)" in rules and "between(inflation, low=-50, high=200)" in rules


def test_suite_is_one_aggregation(bars):
    plan = suites.ohlcv_suite(DAY).run(bars)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_null_profile(spark):
    some = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = null_profile({"some": (some, ["a", "b"]), "full": (some.filter("b is not null"), ["a", "b"]),
                        "none": (some.limit(0), ["a", "b"])})
    assert rows(got) == sorted([("some", 3, 3), ("full", 1, 0), ("none", 0, None)], key=repr)


@pytest.mark.parametrize("value, text", [
    (100.0, "100"), (0.5, "0.5"), (1.00000000001, "1.00000000001"), (1e30, "1" + "0" * 30), (1.25e-5, "0.0000125"),
    (-12345678.9, "-12345678.9"), (1e-300, "1.0E-300"), (0.0, "0"), (None, None),
])
def test_number_text_is_whole(spark, value, text):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(number_text(F.col("x"))).first()[0] == text


def test_nan_is_missing_in_every_rule(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    suite = Suite("s", (not_null("x"), between("x", low=0)))
    found = {r.position: (r.missing_count, r.unexpected_count) for r in suite.run(df).collect()}
    assert found == {1: (0, 1), 2: (1, 0)}
    assert suite.clean(df)[0].count() == 1
