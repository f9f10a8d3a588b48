import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions.columns import landing_day, landing_time, path_file_ts, path_run_day, path_ticker
from marketlake.sources.landing import latest_snapshot, read_landing, read_stamped, ticker_from_path
from marketlake.sources.payloads import explode_rates, flatten_rate, pick_keys, upper_headers, variant_rates
from marketlake.sources.tables import write_landing, write_landing_tree, write_metrics, write_report

BARS = "Date,CLOSE,HIGH,LOW,OPEN,VOLUME,COMPANY_TICKER"
DAY = dt.date(2025, 12, 18)


@pytest.fixture
def tree(lake, land):
    """Two snapshots for one ticker, one for another, a header-only file, and another day."""
    files = [
        land(lake.ohlcv, "AAPL/2025/Dec/18", "AAPL_stock_13-16-54.csv", BARS, ["2025-12-18,271.19,273.62,266.96,273.61,28864357,AAPL"]),
        land(lake.ohlcv, "AAPL/2025/Dec/18", "AAPL_stock_16-19-18.csv", BARS, ["2025-12-18,272.5,273.62,266.96,273.61,30000000,AAPL"]),
        land(lake.ohlcv, "TGT/2025/Dec/18", "TGT_stock_13-16-54.csv", BARS, ["2025-12-18,98.6,98.54,96.0,97.0,1000,XXX"]),
        land(lake.ohlcv, "GS/2025/Dec/18", "GS_stock_13-16-54.csv", BARS),
        land(lake.ohlcv, "AAPL/2025/Dec/17", "AAPL_stock_16-11-11.csv", BARS, ["2025-12-17,1,1,1,1,1,AAPL"]),
    ]
    for file in files:
        os.utime(file, (0, 0))
    return lake.ohlcv


def test_latest_snapshot_of_the_run_day(spark, tree):
    got = read_landing(spark, tree, schemas.OHLCV_DAILY, DAY, by_ticker=True)
    assert rows(got.select("COMPANY_TICKER", "CLOSE", "run_day")) == [("AAPL", 272.5, DAY), ("XXX", 98.6, DAY)]
    assert {str(r.file_ts) for r in got.collect()} == {"2025-12-18 16:19:18", "2025-12-18 13:16:54"}
    assert sorted(r.ticker for r in ticker_from_path(got).collect()) == ["AAPL", "TGT"]


def test_only_winning_files_are_opened(spark, tree):
    got = read_landing(spark, tree, schemas.OHLCV_DAILY, DAY, by_ticker=True)
    assert len(got.inputFiles()) == 3
    assert len(read_landing(spark, tree, schemas.OHLCV_DAILY, by_ticker=True, latest=False).inputFiles()) == 5


def test_newer_modification_time_wins(spark, tree):
    os.utime(f"{tree}/AAPL/2025/Dec/18/AAPL_stock_13-16-54.csv", (1000, 1000))
    got = read_landing(spark, tree, schemas.OHLCV_DAILY, DAY, by_ticker=True)
    assert 271.19 in [r.CLOSE for r in got.collect()]


def test_missing_day_is_empty(spark, tree):
    got = read_landing(spark, tree, schemas.OHLCV_DAILY, dt.date(2020, 1, 1), by_ticker=True)
    assert got.count() == 0 and "file_ts" in got.columns


def test_other_layouts(spark, lake, land):
    land(lake.fx, "2025/Dec/18", "exchange_rate13-17-06.csv", "date,inr_rate,USD_rate", ["2025-12-18,90.26,1"])
    fx = read_landing(spark, lake.fx, schemas.FX_DAILY, DAY).first()
    assert (fx.inr_rate, str(fx.file_ts)) == (90.26, "2025-12-18 13:17:06")
    land(
        lake.company, "2025/Dec/18", "company_metadata_16-19-18.csv",
        "companyName,symbol,price,marketCap,sector,industry",
        ['American Airlines Group Inc.,AAL,15.51,10237902499.0,Industrials,"Airlines, Airports & Air Services"'],
    )
    company = read_landing(spark, lake.company, schemas.COMPANY, DAY).first()
    assert company.industry == "Airlines, Airports & Air Services"
    header = BARS.replace("Date,", "Date,ADJ CLOSE,")
    land(lake.ohlcv, "GOOG/2025/Dec/18", "GOOG_stock_14-46-47.csv", header, ["2025-12-18,1,2,3,1,2,5,GOOG"])
    old = read_landing(spark, lake.ohlcv, schemas.OHLCV_HISTORIC, DAY, by_ticker=True).first()
    assert (old["ADJ CLOSE"], old.CLOSE) == (1.0, 2.0)


def test_wrong_header_is_not_read_by_position(spark, lake, land):
    land(lake.fx, "2025/Dec/18", "exchange_rate_13-17-06.csv", "Date,INR_amount,USD_rate", ["2025-12-18,90.26,1"])
    with pytest.raises(Exception, match="header"):
        read_landing(spark, lake.fx, schemas.FX_DAILY, DAY).collect()


def test_latest_snapshot_of_rows(spark):
    leaf = "file:/r/A/2025/Dec/18/A_stock"
    df = spark.createDataFrame(
        [(f"{leaf}_09-00-00.csv", 1, "x"), (f"{leaf}_10-00-00.csv", 1, "y"), (f"{leaf}_10-00-00.csv", 1, "z"),
         (f"{leaf}_08-00-00.csv", 0, "old"), ("file:/r/B/2025/Dec/18/B.csv", 1, "w")],
        "file_path string, file_mtime int, v string",
    )
    got = latest_snapshot(df)
    assert rows(got.select("folder_ticker", "v", "run_day")) == [("A", "y", DAY), ("A", "z", DAY), ("B", "w", DAY)]


def test_path_parts(spark):
    df = spark.createDataFrame([("file:/r/GOOG/2025/Dec/11/GOOG_stock_14-46-47.csv",), ("file:/r/other.csv",)], "p string")
    p = F.col("p")
    got = df.select(path_ticker(p), path_run_day(p), path_file_ts(p).cast("string")).collect()
    assert tuple(got[0]) == ("GOOG", dt.date(2025, 12, 11), "2025-12-11 14:46:47")
    assert tuple(got[1]) == ("", None, None)
    run = F.lit("2025-12-11 14:46:47").cast("timestamp")
    assert tuple(df.select(landing_day(run), landing_time(run)).first()) == ("2025/Dec/11", "14-46-47")


def test_stamped_snapshots(spark, tmp_path):
    root = str(tmp_path / "stamped")
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "ticker string, x double")
    write_landing(df, root, dt.datetime(2025, 12, 18, 9, 0, 0), ["ticker"])
    write_landing(df.filter("ticker = 'A'").withColumn("x", F.col("x") * 10), root, dt.datetime(2025, 12, 18, 16, 0, 0), ["ticker"])
    write_landing(df, root, dt.datetime(2025, 12, 19, 9, 0, 0), ["ticker"])
    schema = df.drop("ticker").schema
    day = read_stamped(spark, root, schema, ["ticker"], DAY)
    assert rows(day.select("ticker", "x", "run_day")) == [("A", 10.0, DAY), ("B", 2.0, DAY)]
    assert read_stamped(spark, root, schema, ["ticker"]).count() == 4
    assert read_stamped(spark, root, schema, ["ticker"], latest=False).count() == 5
    assert read_stamped(spark, str(tmp_path / "none"), schema).count() == 0


def test_rates_payload(spark):
    body = json.dumps({"amount": 1.0, "rates": {"2025-12-17": {"INR": 90.1}, "2025-12-18": {"INR": 90.26}}})
    df = spark.createDataFrame([(body,), ("{}",)], "body string")
    got = explode_rates(df, "body")
    assert got.columns == ["Date", "INR_amount", "USD_rate"]
    assert rows(got) == [(dt.date(2025, 12, 17), 90.1, 1), (dt.date(2025, 12, 18), 90.26, 1)]


def test_payloads_of_changing_shape(spark):
    bodies = [
        (0, '{"amount": 1.5, "rates": {"2025-12-17": {"INR": 90.1}, "2025-12-18": {"INR": 90}}}'),
        (1, '{"rates": [{"date": "2025-12-18", "INR": 90.26}, {"date": "2025-12-19"}], "note": "n", "z": [1]}'),
        (2, '{"base": "USD"}'), (3, '{"date": "2025-12-18", "rates": {"INR": 9, "EUR": 2}}'), (4, "no json"), (5, None),
        (6, "[1]"), (7, '{"rates": null}'),
    ]
    got = variant_rates(spark.createDataFrame(bodies, "id int, body string"), "body")
    assert got.columns == ["id", "date", "rate", "other"]
    found = sorted(((r.id, str(r.date), r.rate, r.other) for r in got.collect()), key=repr)
    assert found == [
        (0, "2025-12-17", 90.1, {"amount": "1.5"}), (0, "2025-12-18", 90.0, {"amount": "1.5"}),
        (1, "2025-12-18", 90.26, {"note": '"n"', "z": "[1]"}), (1, "2025-12-19", None, {"note": '"n"', "z": "[1]"}),
        (2, "None", None, {"base": '"USD"'}), (3, "2025-12-18", 9.0, {}), (4, "None", None, None), (5, "None", None, None),
        (6, "None", None, None), (7, "None", None, {}),
    ]


def test_latest_rate_payload(spark):
    body = json.dumps({"amount": 1.0, "base": "USD", "date": "2025-12-18", "rates": {"INR": 90.26}})
    assert rows(flatten_rate(spark.createDataFrame([(body,)], "body string"), "body")) == [(DAY, 90.26, 1)]


def test_profile_payload(spark):
    profile = {"companyName": "Apple", "symbol": "AAPL", "price": 271.19, "marketCap": 4e12, "sector": "Technology", "beta": 1}
    bodies = [(json.dumps([profile, {"symbol": "no"}]),), (json.dumps({"symbol": "ONE"}),), ("[]",)]
    got = pick_keys(spark.createDataFrame(bodies, "body string"), "body")
    assert got.columns == list(schemas.COMPANY_KEYS)
    assert rows(got) == sorted(
        [("Apple", "AAPL", 271.19, 4e12, "Technology", None), (None, "ONE", None, None, None, None)], key=repr
    )


def test_headers_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "Open int, cLose int")
    assert upper_headers(df).columns == ["OPEN", "CLOSE"]
    for hour in (1, 2):
        write_report(df, str(tmp_path / "report"), dt.datetime(2026, 1, 5, hour))
    assert spark.read.json(str(tmp_path / "report")).count() == 2
    write_metrics(df, str(tmp_path / "metrics"))
    assert spark.read.option("header", True).csv(str(tmp_path / "metrics")).columns == ["Open", "cLose"]


def test_file_names_with_encoded_characters(spark, lake, land):
    tickers = ["AAPL", "^GSPC", "BRK B", "EURUSD=X", "A%41", "A[1]"]
    for ticker in tickers:
        row = f"2025-12-18,2,3,1,2,5,{ticker}"
        land(lake.ohlcv, f"{ticker}/2025/Dec/18", f"{ticker}_stock_13-16-54.csv", BARS, [row])
    got = ticker_from_path(read_landing(spark, lake.ohlcv, schemas.OHLCV_DAILY, DAY, by_ticker=True))
    assert sorted(r.ticker for r in got.collect()) == sorted(tickers)
    assert rows(got.select("ticker", "run_day")) == sorted((t, DAY) for t in tickers)


def test_dated_tree_is_written_as_it_is_read(spark, lake):
    names = ["AAPL ", "^GSPC", "BRK B", "A/B", "A%41", None, " "]
    rows = [(DAY, 2.0, 3.0, 1.0, 2.0, float(i), n) for i, n in enumerate(names)]
    bars = spark.createDataFrame(rows, schemas.OHLCV_DAILY)
    for hour in (9, 16):
        write_landing_tree(bars, lake.ohlcv, dt.datetime(2025, 12, 18, hour, 5, 7), "stock", "COMPANY_TICKER")
    folders = ["A%2FB", "A%41", "AAPL", "BRK B", "^GSPC", "unnamed"]
    assert sorted(os.listdir(lake.ohlcv)) == folders
    for folder in folders:
        found = sorted(f for f in os.listdir(f"{lake.ohlcv}/{folder}/2025/Dec/18") if f.endswith(".csv"))
        assert found == [f"{folder}_stock_{hour}-05-07.csv" for hour in ("09", "16")]
    got = ticker_from_path(read_landing(spark, lake.ohlcv, schemas.OHLCV_DAILY, DAY, by_ticker=True))
    assert rows_of(got, "ticker", "VOLUME") == [
        ("A%2FB", 3.0), ("A%41", 4.0), ("AAPL", 0.0), ("BRK B", 2.0), ("^GSPC", 1.0), ("unnamed", 5.0), ("unnamed", 6.0)
    ]
    assert {str(r.file_ts) for r in got.collect()} == {"2025-12-18 16:05:07"}
    assert not [d for d in os.listdir(os.path.dirname(lake.ohlcv)) if "staging" in d]


def rows_of(df, *names):
    return rows(df.select(*names))


def test_snapshots_of_several_files_are_read_whole(spark, lake):
    rates = spark.range(0, 100, 1, 4).selectExpr("date'2025-12-18' as date", "double(id) as inr_rate", "1 as USD_rate")
    early, late = (dt.datetime(2025, 12, 18, hour, 0, 0) for hour in (9, 16))
    write_landing_tree(rates, lake.fx, early, "exchange_rate")
    for _ in range(2):  # the same run again replaces its own files
        write_landing_tree(rates.filter("inr_rate < 80"), lake.fx, late, "exchange_rate")
    files = [f for f in os.listdir(f"{lake.fx}/2025/Dec/18") if f.endswith(".csv")]
    assert len(files) == 8 and "exchange_rate.part-00003_16-00-00.csv" in files
    got = read_landing(spark, lake.fx, schemas.FX_DAILY, DAY)
    assert sorted(r.inr_rate for r in got.collect()) == [float(i) for i in range(80)]
    assert read_landing(spark, lake.fx, schemas.FX_DAILY, DAY, latest=False).count() == 180
    write_landing_tree(rates.limit(0), lake.fx, dt.datetime(2025, 12, 19, 9, 0, 0), "exchange_rate")
    assert read_landing(spark, lake.fx, schemas.FX_DAILY, dt.date(2025, 12, 19)).count() == 0
