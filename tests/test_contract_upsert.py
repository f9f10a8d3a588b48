import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators import upsert as upserts
from marketlake.operators.contract import ContractError, enforce, require_unique, unique_violations
from marketlake.operators.upsert import MONTH, drop_old_months, upsert, upsert_table
from marketlake.sources.tables import create_layers, refresh_monthly

D = dt.date(2025, 12, 17)
BAR = "ticker string, date date, open double, high double, low double, close double, volume {}, insert_datetime date"


def bar(ticker="AAPL", price=10.0, volume=5.0, date=D):
    return (ticker, date, price, price, price, price, volume, D)


def test_contract_splits_rows(spark):
    data = [
        bar(price=271.195),
        bar(price=10000.0),
        bar(price=None),
        bar(price=float("nan")),
        bar(ticker="ELEVENCHARS"),
        bar(date=None, volume=None),
        bar(volume=1.5),
    ]
    good, rejects = enforce(spark.createDataFrame(data, BAR.format("double")), schemas.OHLCV_SILVER)
    assert good.dtypes == [
        ("ticker", "string"), ("date", "date"), ("open", "decimal(6,2)"), ("high", "decimal(6,2)"),
        ("low", "decimal(6,2)"), ("close", "decimal(6,2)"), ("volume", "bigint"), ("insert_datetime", "date"),
    ]
    assert sorted((r.open, r.volume) for r in good.collect()) == [(Decimal("10.00"), 2), (Decimal("271.20"), 5)]
    prices = ("open", "high", "low", "close")
    assert sorted(r.reasons for r in rejects.collect()) == sorted(
        [
            [f"type:{c}" for c in prices],
            [f"null:{c}" for c in prices],
            [f"null:{c}" for c in prices],
            ["length:ticker"],
            ["null:date", "null:volume"],
        ]
    )


def test_contract_reads_text(spark):
    data = [("x", "4070885251500"), ("y", "3616789682215.0005"), ("z", "4016803799520.0"), ("w", "n/a")]
    df = spark.createDataFrame(data, "ticker string, market_cap string").select(
        F.lit("Name").alias("company_name"), "ticker", F.lit("1.5").alias("price"), "market_cap",
        F.lit("Technology").alias("sector"), F.lit("Semiconductors").alias("industry"),
    )
    good, rejects = enforce(df, schemas.COMPANY_SILVER)
    assert {r.ticker: r.market_cap for r in good.collect()} == {
        "x": 4070885251500, "y": 3616789682215, "z": 4016803799520,
    }
    assert [r.reasons for r in rejects.collect()] == [["type:market_cap"]]


def test_unique(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "k string, d int")
    assert rows(unique_violations(df, ["k", "d"])) == [("a", 1, 2)]
    with pytest.raises(ContractError):
        require_unique(df, ["k", "d"], "t")
    require_unique(df.distinct(), ["k", "d"], "t")


TARGET = [(1, "a", 1, "old", 10), (2, "b", 1, "old", 20), (3, "c", 1, None, 30)]
SCHEMA = "id bigint, k string, d int, v string, insert_datetime int"


def batch(spark, data):
    return spark.createDataFrame(data, "k string, d int, v string, insert_datetime int")


@pytest.mark.parametrize("limit", [100, 0])
def test_upsert(spark, limit):
    target = spark.createDataFrame(TARGET, SCHEMA)
    source = batch(spark, [("a", 1, "new", 11), ("a", 1, "newer", 12), ("b", 1, None, 21), ("e", 1, "e", 1), ("d", 1, "d", 1)])
    got = upsert(target, source, ["k", "d"], id_col="id", broadcast_rows=limit)
    assert rows(got) == [
        (1, "a", 1, "newer", 12), (2, "b", 1, None, 21), (3, "c", 1, None, 30), (4, "d", 1, "d", 1), (5, "e", 1, "e", 1),
    ]
    assert got.columns == target.columns
    again = upsert(got, source, ["k", "d"], id_col="id", broadcast_rows=limit)
    assert rows(again) == rows(got)


def test_upsert_into_and_from_nothing(spark):
    empty, source = spark.createDataFrame([], SCHEMA), batch(spark, [("a", 1, "x", 1)])
    assert rows(upsert(empty, source, ["k", "d"], id_col="id")) == [(1, "a", 1, "x", 1)]
    target = spark.createDataFrame(TARGET, SCHEMA)
    assert rows(upsert(target, batch(spark, []), ["k", "d"], id_col="id")) == rows(target)


def test_upsert_keeps_newer_rows(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    source = batch(spark, [("a", 1, "late", 9), ("b", 1, "fresh", 21)])
    got = upsert(target, source, ["k", "d"], id_col="id", newer_by="insert_datetime")
    assert [r.v for r in got.orderBy("id").collect()] == ["old", "fresh", None]


def test_upsert_table_rewrites_only_touched_months(spark, lake):
    create_layers(spark, [lake.silver], lake.tables_root)
    table = f"{lake.silver}.t"
    day = lambda m, d: dt.date(2025, m, d)
    stored = spark.createDataFrame(
        [(1, day(1, 5), 1.0), (2, day(2, 5), 2.0), (3, day(2, 6), 3.0)], "id bigint, date date, x double"
    )
    refresh_monthly(stored, table)
    january = [f for f in spark.table(table).inputFiles() if "month=2025-01" in f]
    source = spark.createDataFrame([(day(2, 6), 9.0), (day(3, 1), 4.0)], "date date, x double")
    for _ in range(2):
        upsert_table(spark, table, source, ["date"], id_col="id", order=[F.col("x")])
        assert rows(spark.table(table).drop(MONTH)) == [
            (1, day(1, 5), 1.0), (2, day(2, 5), 2.0), (3, day(2, 6), 9.0), (4, day(3, 1), 4.0),
        ]
    assert [f for f in spark.table(table).inputFiles() if "month=2025-01" in f] == january


def test_a_job_lost_before_the_swap_leaves_the_old_month(spark, lake, monkeypatch):
    create_layers(spark, [lake.silver], lake.tables_root)
    table = f"{lake.silver}.t"
    day = dt.date(2025, 2, 5)
    refresh_monthly(spark.createDataFrame([(1, day, 1.0)], "id bigint, date date, x double"), table)
    source = spark.createDataFrame([(day, 9.0), (dt.date(2025, 2, 6), 4.0)], "date date, x double")

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(upserts, "point_months", lost)
        with pytest.raises(RuntimeError):
            upsert_table(spark, table, source, ["date"], id_col="id", order=[F.col("x")])
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table).drop(MONTH)) == [(1, day, 1.0)]
    before = spark.table(table).inputFiles()
    for _ in range(2):
        upsert_table(spark, table, source, ["date"], id_col="id", order=[F.col("x")])
    assert spark.table(table).filter("x in (9.0, 4.0)").count() == 2
    assert not set(before) & set(spark.table(table).inputFiles())

    written = Path(upserts.versions_root(spark, table).removeprefix("file:"))
    assert len(list(written.iterdir())) == 3
    drop_old_months(spark, table)
    drop_old_months(spark, table)
    spark.catalog.refreshTable(table)
    assert len(list(written.iterdir())) == 1 and spark.table(table).count() == 2
