"""What a full refresh computes once, and by which steps."""

import datetime as dt
import os

from conftest import rows
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators.contract import ColumnRule, Contract, checked, enforce, parted
from marketlake.operators.fill import median_fill
from marketlake.operators.quality import Suite, between, not_null
from marketlake.plans import suites
from marketlake.plans.loading import load
from marketlake.session import shared_dir
from marketlake.sources.landing import read_landing
from marketlake.sources.tables import create_layers

MACRO = "ISO3,countryname,id,year,NOMINAL_GDP,REAL_GDP,INFLATION,UNEMPLOYMENT"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_that_are_read_twice_are_parsed_once(spark, lake, land):
    create_layers(spark, lake.databases, lake.tables_root)
    lines = ["IND,India,IND,2021,100,50,4,", "IND,India,IND,2022,,60,6,3", ",Nowhere,X,2023,1,1,1,1", "IND,India,IND,x,1,1,1,1"]
    land(lake.macro, "2025/Dec/18", "macro_data_09-19-50.csv", MACRO, lines)
    seen = []

    def shape(read):
        seen.append(plan(read))
        filled = median_fill(read, "ISO3", schemas.MACRO_MEASURES).withColumnsRenamed({"id": "country_id"})
        return filled.withColumnsRenamed(schemas.MACRO_RENAME).select(*schemas.MACRO_COLUMNS)

    landed = read_landing(spark, lake.macro, schemas.MACRO, dt.date(2025, 12, 18))
    table = f"{lake.bronze}.macro"
    counts = load(landed, schemas.MACRO, shape, suites.macro_suite(2025), table, "one", row_wise=False)
    assert "csv" not in seen[0].lower() and "parquet" in seen[0].lower()
    assert counts["n"] == 2 == spark.table(table).count()
    got = spark.table(table).orderBy("year").select("nominal_gdp", "unemployment")
    assert [tuple(r) for r in got.collect()] == [(100.0, 3.0), (100.0, 3.0)]
    lost = spark.table(f"{table}_landing_rejects").collect()
    assert [(r.raw_line, r.reasons) for r in lost] == [("IND,India,IND,x,1,1,1,1", ["unreadable:year"])]
    assert not [f for f in os.listdir(shared_dir(spark).removeprefix("file:")) if f.startswith("parsed-")]


def test_samples_of_many_broken_values_are_not_sorted(spark):
    suite = Suite("many", (not_null("x"), between("x", low=0), between("y", high=3)))
    df = spark.range(1000).select((-F.col("id")).alias("x"), (F.col("id") % 6).alias("y"))
    found = suite.samples(df, limit=3)
    assert "TakeOrderedAndProject" in plan(found)
    got = rows(found.select("position", "value", "sample"))
    assert got == [(2, "-1", 1), (2, "-10", 2), (2, "-100", 3), (3, "4", 1), (3, "4", 2), (3, "4", 3)]


def test_checked_rows_part_as_enforce_parts_them(spark):
    contract = Contract("c", (ColumnRule("t", "string", max_length=3), ColumnRule("x", "decimal(4,2)"), ColumnRule("n", "int", True)))
    given = [("a", 1.5, 2.4, 1), ("long", 1.0, 1.0, 2), (None, None, None, 3), ("b", 1e9, 3e12, 4), ("c", float("nan"), 1.0, 5),
             ("d", 2.345, None, 6), ("d", 2.345, None, 6)]
    df = spark.createDataFrame(given, "t string, x double, n double, other int")
    want, got = enforce(df, contract), parted(checked(df, contract), contract)
    for a, b in zip(want, got):
        assert a.columns == b.columns and [t for _, t in a.dtypes] == [t for _, t in b.dtypes]
        assert repr(rows(a)) == repr(rows(b))  # NaN is not equal to itself
