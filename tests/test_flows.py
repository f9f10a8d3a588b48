"""Whole flows on small landing trees: historical refresh, daily increment, file stream."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators.upsert import MONTH
from marketlake.plans.daily import run_daily
from marketlake.plans import suites
from marketlake.plans.gold import register_gold, stock_facts
from marketlake.plans.historical import run_historical
from marketlake.plans.loading import stored_counts
from marketlake.streaming.daily import stream_bars, stream_daily, stream_rates

BARS = "Date,CLOSE,HIGH,LOW,OPEN,VOLUME,COMPANY_TICKER"
RUN = dt.datetime(2025, 12, 18, 17, 0, 0)
LEAF = "2025/Dec/18"


def bar(day, close, ticker, high=None):
    return f"{day},{close},{high or close + 1},{close - 1},{close},1000,{ticker}"


@pytest.fixture
def historic(lake, land):
    days = [dt.date(2025, 11, 3) + dt.timedelta(days=i) for i in range(45)]
    aapl = [bar(d, 270 + i, "AAPL") for i, d in enumerate(days)]
    land(lake.ohlcv, f"AAPL/{LEAF}", "AAPL_stock_09-19-37.csv", BARS, aapl + aapl[:3])
    land(lake.ohlcv, f"TGT/{LEAF}", "TGT_stock_09-19-37.csv", BARS,
         [bar("2025-12-17", 98.6, "TGT", 98.54), "2025-12-18,,,,,,TGT", bar("2025-12-16", 12000, "TGT")])
    land(lake.company, LEAF, "company_metadata_09-19-37.csv", "companyName,symbol,price,marketCap,sector,industry", [
        "Apple Inc.,AAPL,271.19,4070885251500,Technology,Consumer Electronics",
        'American Airlines Group Inc.,AAL ,15.51,10237902499.4,Industrials,"Airlines, Airports & Air Services"',
        'American Airlines Group Inc.,AAL,15.51,10237902499.4,Industrials,"Airlines, Airports & Air Services"',
    ])
    land(lake.fx, LEAF, "exchange_rates_09-19-44.csv", "Date,INR_amount,USD_rate",
         ["2025-12-16,90.9,1", "2025-12-17,90.26,1", "2025-12-17,90.26,1"])
    land(lake.macro, LEAF, "macro_data_historic_09-19-50.csv",
         "ISO3,countryname,id,year,NOMINAL_GDP,REAL_GDP,INFLATION,UNEMPLOYMENT",
         ["IND,India,IND,2021,100,50,4,", "IND,India,IND,2022,,60,6,", "IND,India,IND,2023,130,70,,",
          ",Nowhere,X,2023,1,1,1,1"])
    return lake


def test_historical_refresh(spark, historic):
    lake = historic
    steps = run_historical(spark, lake, RUN, ranked=True)
    assert set(steps.values()) == {"ok"}, steps

    bronze = spark.table(f"{lake.bronze}.ohclv_bronze")
    assert bronze.count() == 51 and bronze.select("id").distinct().count() == 51
    assert bronze.columns == ["id", *schemas.OHLCV_COLUMNS, "insert_datetime"]
    processed = spark.table(f"{lake.bronze}.ohclv_processed")
    assert processed.filter("rank_assigned = 1").count() == 48 == spark.table(f"{lake.silver}.ohclv_clean").count()

    silver = spark.table(f"{lake.silver}.ohclv_silver")
    assert silver.count() == 46
    assert sorted(r.stock_id for r in silver.collect()) == list(range(1, 47))
    assert dict(silver.dtypes)["close"] == "decimal(6,2)" and dict(silver.dtypes)["volume"] == "bigint"
    assert {r.insert_datetime for r in silver.collect()} == {RUN.date()}
    rejects = spark.table(f"{lake.silver}.ohclv_silver_rejects")
    assert sorted(r.reasons[0] for r in rejects.collect()) == ["null:open", "type:open"]

    company = spark.table(f"{lake.silver}.company_meta_data_silver")
    assert rows(company.select("ticker", "market_cap")) == [("AAL", 10237902499), ("AAPL", 4070885251500)]
    assert spark.table(f"{lake.silver}.exchange_rates_silver").count() == 2
    macro = spark.table(f"{lake.silver}.macro_economic_data_silver").orderBy("year").collect()
    assert [(m.nominal_gdp, m.inflation, m.unemployment) for m in macro] == [
        (100.0, 4.0, 0.0), (115.0, 6.0, 0.0), (130.0, 5.0, 0.0),
    ]

    report = spark.read.json(f"{lake.reports}/company_meta_data_bronze")
    assert {r.column for r in report.filter("not success").collect()} == {"ticker", "sector", "industry"}
    metrics = spark.read.option("header", True).csv(f"{lake.reports}/bronze_layer_metrics")
    assert {r.table_name: r.total_null_values for r in metrics.collect()} == {
        "ohclv_bronze": "5", "company_meta_data_bronze": "0",
        "macro_economic_data_bronze": "0", "exchange_rates_bronze": "0",
    }

    view = spark.table(f"{lake.gold}.stock_facts")
    facts = stock_facts(silver)
    names = ["UUID", "stock_id", "trade_date", "prev_close_price"]
    assert rows(view.select(*names)) == rows(facts.select(*names))
    joined = view.alias("v").join(facts.alias("f"), ["ticker", "trade_date"])
    for c, limit in (("daily_return", 0), ("volatility_days_30", 1e-12), ("stock_90_day_average", 0)):
        assert joined.filter(F.abs(F.col(f"v.{c}") - F.col(f"f.{c}")) > limit).count() == 0
        assert joined.filter(F.col(f"v.{c}").isNull() != F.col(f"f.{c}").isNull()).count() == 0
    register_gold(spark, lake.silver)
    assert rows(spark.table("macro_facts")) == rows(spark.table(f"{lake.gold}.macro_facts").select(spark.table("macro_facts").columns))

    assert set(run_historical(spark, lake, RUN).values()) == {"ok"}
    assert spark.table(f"{lake.silver}.ohclv_silver").count() == 46


def test_a_failed_step_does_not_stop_the_others(spark, historic, land):
    land(historic.fx, LEAF, "exchange_rates_23-00-00.csv", "wrong,header,here", ["a,b,c"])
    steps = run_historical(spark, historic, RUN)
    assert steps["exchange_rates_bronze"].startswith("failed")
    assert steps["silver_ohlcv"] == steps["gold"] == "ok"
    with pytest.raises(Exception):
        run_historical(spark, historic, RUN, fail_fast=True)


def test_broken_rules_stop_only_on_request(spark, historic):
    steps = run_historical(spark, historic, RUN, fail_on_error=True)
    assert "sector" in steps["validate_company_meta_data_bronze"]
    assert steps["validate_exchange_rates_bronze"] == "ok"


def daily(land, lake, day, stamp, closes, rate):
    leaf = day.strftime("%Y/%b/%d")
    for ticker, close in closes.items():
        land(lake.ohlcv, f"{ticker}/{leaf}", f"{ticker}_stock_{stamp}.csv", BARS, [bar(day, close, ticker)])
    land(lake.fx, leaf, f"exchange_rate{stamp}.csv", "date,inr_rate,USD_rate", [f"{day},{rate},1"])


def silver(spark, lake):
    bars = spark.table(f"{lake.silver}.ohclv_silver").select("ticker", "date", "close", "volume")
    rates = spark.table(f"{lake.silver}.exchange_rates_silver").select("date", "inr_rate", "usd_amount")
    return rows(bars), rows(rates)


D17, D18 = dt.date(2025, 12, 17), dt.date(2025, 12, 18)


def test_daily_increment(spark, lake, land):
    daily(land, lake, D17, "13-16-54", {"AAPL": 270, "TGT": 98}, 90.1)
    assert set(run_daily(spark, lake, dt.datetime(2025, 12, 17, 18)).values()) == {"ok"}
    daily(land, lake, D18, "13-16-54", {"AAPL": 271, "TGT": 99}, 90.2)
    daily(land, lake, D18, "16-16-54", {"AAPL": 272}, 90.3)
    for hour in (18, 19):
        assert set(run_daily(spark, lake, dt.datetime(2025, 12, 18, hour)).values()) == {"ok"}
    bars, rates = silver(spark, lake)
    assert bars == [
        ("AAPL", D17, Decimal("270.00"), 1000), ("AAPL", D18, Decimal("272.00"), 1000),
        ("TGT", D17, Decimal("98.00"), 1000), ("TGT", D18, Decimal("99.00"), 1000),
    ]
    assert rates == [(D17, 90.1, 1), (D18, 90.3, 1)]
    assert spark.table(f"{lake.silver}.ohclv_silver").select("stock_id").distinct().count() == 4
    lineage = spark.table(f"{lake.bronze}.ohclv_daily_lineage")
    assert lineage.count() == 4 and lineage.filter(F.col("insert_datetime") == dt.datetime(2025, 12, 18, 19)).count() == 2
    assert spark.table(f"{lake.bronze}.ohclv_daily_bronze").count() == 2
    assert stock_facts(spark.table(f"{lake.silver}.ohclv_silver")).filter("daily_return is not null").count() == 2


def test_stream_equals_daily_runs(spark, lake, land, tmp_path):
    checkpoint = str(tmp_path / "stream")
    # The newer snapshot arrives first, the older one late, and a copy of a file is seen again.
    daily(land, lake, D18, "16-16-54", {"AAPL": 272}, 90.3)
    for query in stream_daily(spark, lake, checkpoint):
        query.awaitTermination()
    daily(land, lake, D17, "13-16-54", {"AAPL": 270, "TGT": 98}, 90.1)
    daily(land, lake, D18, "13-16-54", {"AAPL": 271, "TGT": 99}, 90.2)
    land(lake.ohlcv, "AAPL/2025/Dec/18", "AAPL_again_13-16-54.csv", BARS, [bar(D18, 271, "AAPL")])
    for _ in range(2):
        for query in stream_daily(spark, lake, checkpoint):
            query.awaitTermination()
    want_bars = [
        ("AAPL", D17, Decimal("270.00"), 1000), ("AAPL", D18, Decimal("272.00"), 1000),
        ("TGT", D17, Decimal("98.00"), 1000), ("TGT", D18, Decimal("99.00"), 1000),
    ]
    assert silver(spark, lake) == (want_bars, [(D17, 90.1, 1), (D18, 90.3, 1)])
    ids = spark.table(f"{lake.silver}.ohclv_silver").select("stock_id", MONTH)
    assert ids.distinct().count() == 4

    # A lost checkpoint replays every file; the tables stay the same.
    stream_bars(spark, lake, str(tmp_path / "replay")).awaitTermination()
    assert silver(spark, lake)[0] == want_bars


def test_a_day_without_files_leaves_the_tables_alone(spark, historic, land):
    lake = historic
    assert set(run_historical(spark, lake, RUN).values()) == {"ok"}
    before = rows(spark.table(f"{lake.silver}.ohclv_silver").drop(MONTH))
    later = dt.datetime(2025, 12, 19, 17)
    land(lake.fx, "2025/Dec/19", "exchange_rates_09-19-44.csv", "Date,INR_amount,USD_rate", ["2025-12-19,91.5,1"])
    steps = run_historical(spark, lake, later)
    assert steps["ohclv_bronze"].startswith("skipped") and steps["silver_ohlcv"].startswith("skipped")
    assert steps["exchange_rates_bronze"] == steps["silver_fx"] == "ok"
    assert rows(spark.table(f"{lake.silver}.ohclv_silver").drop(MONTH)) == before
    assert [len(s) for s in (schemas.OHLCV_DAILY, schemas.FX_DAILY)] == [7, 3]
    steps = run_daily(spark, lake, later)
    assert {v[:7] for k, v in steps.items() if k != "targets"} == {"skipped"} or steps["stage_bars"].startswith("skipped")
    daily(land, lake, D18, "13-16-54", {"AAPL": 271}, 90.2)
    assert set(run_daily(spark, lake, dt.datetime(2025, 12, 18, 18)).values()) == {"ok"}


def test_rejected_rows_are_kept_once(spark, lake, land, tmp_path):
    daily(land, lake, D18, "13-16-54", {"AAPL": 271, "TGT": 12000}, 90.2)
    for _ in range(2):
        assert set(run_daily(spark, lake, dt.datetime(2025, 12, 18, 18)).values()) == {"ok"}
    found = [spark.table(t) for t in (f"{lake.bronze}.ohclv_daily_bronze_rejects", f"{lake.silver}.ohclv_daily_rejects")]
    assert sum(t.count() for t in found) == 1 and spark.table(f"{lake.silver}.ohclv_silver").count() == 1
    for name in ("one", "two"):
        stream_bars(spark, lake, str(tmp_path / name)).awaitTermination()
    assert spark.table(f"{lake.silver}.ohclv_silver").count() == 1
    kept = [f"{lake.bronze}.ohclv_daily_lineage_stream_rejects", f"{lake.silver}.ohclv_silver_stream_rejects"]
    assert sum(spark.table(t).count() for t in kept) == 1


@pytest.mark.parametrize("late", [False, True])
def test_an_unfit_newer_row_never_hides_an_accepted_one(spark, lake, land, tmp_path, late):
    """Batch and stream keep the newest accepted row, in either order of arrival."""
    def older():
        daily(land, lake, D18, "13-16-54", {"AAPL": 271}, 90.2)

    def newer():
        leaf = D18.strftime("%Y/%b/%d")
        land(lake.ohlcv, f"AAPL/{leaf}", "AAPL_stock_16-16-54.csv", BARS, [bar(D18, 12000, "AAPL")])

    for arrive in (newer, older) if late else (older, newer):
        arrive()
        stream_bars(spark, lake, str(tmp_path / "stream")).awaitTermination()
    bars = spark.table(f"{lake.silver}.ohclv_silver").select("ticker", "date", "close")
    assert rows(bars) == [("AAPL", D18, Decimal("271.00"))]
    assert spark.table(f"{lake.bronze}.ohclv_daily_lineage").count() == 1
    assert spark.table(f"{lake.bronze}.ohclv_daily_lineage_stream_rejects").count() == 1


@pytest.mark.parametrize("late", [False, True])
def test_an_amount_that_silver_cannot_hold_hides_no_older_rate(spark, lake, land, tmp_path, late):
    """40000 fits the staging type, not the silver type. Either order of arrival, a restart and a replay end alike."""
    leaf = D18.strftime("%Y/%b/%d")
    snapshots = [("13-16-54", "90.2,1"), ("16-16-54", "90.9,40000")]
    for stamp, values in reversed(snapshots) if late else snapshots:
        land(lake.fx, leaf, f"exchange_rate{stamp}.csv", "date,inr_rate,USD_rate", [f"{D18},{values}"])
        stream_rates(spark, lake, str(tmp_path / "stream")).awaitTermination()
    for checkpoint in ("stream", "replay"):
        stream_rates(spark, lake, str(tmp_path / checkpoint)).awaitTermination()
        rates = spark.table(f"{lake.silver}.exchange_rates_silver").select("date", "inr_rate", "usd_amount")
        assert rows(rates) == [(D18, 90.2, 1)]
    lineage = spark.table(f"{lake.bronze}.exchange_daily_lineage").select("inr_rate", "usd_amount")
    assert rows(lineage) == [(90.9, 40000)]


def test_unreadable_lines_are_kept_by_batch_and_stream(spark, lake, land, tmp_path):
    lines = [
        f"{D18},abc,3,1,2,5,AAPL", "18/12/2025,2,3,1,2,5,AAPL", f"{D18},2,3,1", f"{D18},2,3,1,2,5,AAPL,more",
        f'{D18},"2,5",3,1,?,5,AAPL', f"{D18},2,3,1,2,,TGT", bar(D18, 271, "AAPL"),
    ]
    want = [
        (lines[0], "unreadable:CLOSE"), (lines[1], "unreadable:Date"), (lines[2], "fields"), (lines[3], "fields"),
        (lines[4], "unreadable:CLOSE,unreadable:OPEN"),
    ]
    land(lake.ohlcv, f"AAPL/{LEAF}", "AAPL_stock_13-16-54.csv", BARS, lines)

    def kept(table):
        found = spark.table(table)
        assert all(r.file_path.endswith("AAPL_stock_13-16-54.csv") for r in found.collect())
        return sorted((r.raw_line, ",".join(r.reasons)) for r in found.collect())

    for _ in range(2):
        assert set(run_daily(spark, lake, dt.datetime(2025, 12, 18, 18)).values()) <= {
            "ok", f"skipped: no landing files below {lake.fx}", "skipped: needs stage_rates"
        }
        assert kept(f"{lake.bronze}.ohclv_daily_bronze_landing_rejects") == sorted(want)
    rejects = spark.table(f"{lake.bronze}.ohclv_daily_bronze_rejects")
    assert [r.reasons for r in rejects.collect()] == [["null:volume"]]
    run_historical(spark, lake, RUN)
    assert spark.table(f"{lake.bronze}.ohclv_bronze").count() == 2
    assert kept(f"{lake.bronze}.ohclv_bronze_landing_rejects") == sorted(want)
    for checkpoint in ("one", "two"):
        stream_bars(spark, lake, str(tmp_path / checkpoint)).awaitTermination()
        assert kept(f"{lake.bronze}.ohclv_daily_lineage_stream_landing_rejects") == sorted(want)
    report = spark.read.json(f"{lake.reports}/ohclv_daily_bronze_stream")
    plain = spark.read.json(f"{lake.reports}/ohclv_daily_bronze").filter("run_ts is not null").limit(16)
    counts = ["position", "column", "element_count", "missing_count", "unexpected_count"]
    assert rows(report.select(*counts).distinct()) == rows(plain.select(*counts).distinct()) and report.count() == 16


def test_rules_are_counted_by_the_job_that_stores(spark, lake, land):
    """The counts of the pass equal a run of the suite over the table; a wrong count is not used."""
    land(lake.ohlcv, f"AAPL/{LEAF}", "AAPL_stock_13-16-54.csv", BARS, [bar(D18, 271, "AAPL"), f"{D17},5,4,1,-2,,aapl"])
    run_historical(spark, lake, RUN)
    suite = suites.ohlcv_suite(RUN.date())
    stored = spark.table(f"{lake.bronze}.ohclv_bronze")
    report = spark.read.json(f"{lake.reports}/ohclv_bronze").drop("run_ts")
    want = suite.run(stored)
    assert rows(report.select(want.columns)) == rows(want)
    assert stored_counts(stored, {"n": 3}) is None and stored_counts(stored, {"n": 2}) == {"n": 2}


def test_a_stream_refuses_other_headers(spark, lake, land, tmp_path):
    land(lake.ohlcv, f"AAPL/{LEAF}", "AAPL_stock_13-16-54.csv", BARS.replace("CLOSE", "ADJ CLOSE"), [bar(D18, 271, "AAPL")])
    with pytest.raises(Exception):
        stream_bars(spark, lake, str(tmp_path / "stream")).awaitTermination()
    assert spark.table(f"{lake.silver}.ohclv_silver").count() == 0


def test_nan_is_a_missing_value(spark, lake, land):
    land(lake.ohlcv, f"AAPL/{LEAF}", "AAPL_stock_13-16-54.csv", BARS, [f"{D18},NaN,NaN,NaN,NaN,NaN,AAPL", bar(D17, 271, "AAPL")])
    run_historical(spark, lake, RUN)
    bronze = spark.table(f"{lake.bronze}.ohclv_bronze")
    assert bronze.filter("open is null and volume is null").count() == 1 and bronze.filter("isnan(open)").count() == 0
    report = spark.read.json(f"{lake.reports}/ohclv_bronze")
    assert {r.column for r in report.filter("not success").collect()} >= {"open", "high", "low", "close", "volume"}
