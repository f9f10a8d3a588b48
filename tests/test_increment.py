"""Gold facts and medians kept up to date from increments: equal to a whole run, from the parts that changed."""

import datetime as dt
import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from marketlake.operators.fill import fill_by_medians, median_fill, value_counts
from marketlake.operators.upsert import MONTH, replace_months, upsert_table
from marketlake.plans import increment
from marketlake.plans.gold import DERIVED, derive_facts, stock_facts
from marketlake.plans.increment import affected_facts, changed_rows, months_of, store_facts, update_facts, update_medians
from marketlake.sources.tables import create_layers, refresh_monthly

BARS = "stock_id bigint, ticker string, date date, open double, high double, low double, close double, volume bigint"
FIRST = dt.date(2018, 1, 1)


def bars(spark, data):
    df = spark.createDataFrame(data, BARS)
    return df.withColumns({c: F.col(c).cast("decimal(6,2)") for c in ("open", "high", "low", "close")})


def bar(i, ticker, day, close):
    return (i, ticker, day, close, close, close, close, 10)


def series(seed=1):
    """A daily series, a sparse one, one that ends early, a single row."""
    rnd, data = random.Random(seed), []
    for ticker, n, gap in (("DAY", 900, 1), ("GAP", 120, 9), ("OLD", 40, 1), ("ONE", 1, 1)):
        data += [(ticker, FIRST + dt.timedelta(days=i * gap), round(rnd.uniform(5, 900), 2)) for i in range(n)]
    return [bar(i, *row) for i, row in enumerate(data)]


@pytest.fixture
def silver(spark, lake):
    create_layers(spark, lake.databases, lake.tables_root)
    table = f"{lake.silver}.ohclv_silver"
    refresh_monthly(bars(spark, series()), table)
    return table


def rounded(df):
    return rows(df.withColumn("volatility_days_30", F.round("volatility_days_30", 9)).drop(MONTH))


CHANGES = [
    [bar(0, "DAY", FIRST + dt.timedelta(days=450), 500.0)],
    [bar(0, "DAY", FIRST, 1.0), bar(0, "DAY", FIRST + dt.timedelta(days=899), 2.0)],
    [bar(0, "GAP", FIRST + dt.timedelta(days=9 * 60), 0.0), bar(0, "ONE", FIRST, 3.0)],
    [bar(0, "NEW", dt.date(2019, 5, 5), 7.0), bar(0, "GAP", FIRST + dt.timedelta(days=9 * 60 + 1), 8.0)],
    [bar(0, "OLD", dt.date(2021, 1, 1), 9.0), bar(0, "ONE", dt.date(2017, 1, 1), 4.0)],
]


def test_updated_facts_equal_a_whole_run(spark, lake, silver):
    facts = f"{lake.gold}.stored"
    store_facts(spark, silver, facts)
    for change in CHANGES:
        batch = bars(spark, change).drop("stock_id")
        upsert_table(spark, silver, batch, ["ticker", "date"], order=[F.col("close")], id_col="stock_id")
        for _ in range(2 if change is CHANGES[0] else 1):
            update_facts(spark, silver, facts, batch.select("ticker", "date"))
        assert rounded(spark.table(facts)) == rounded(stock_facts(spark.table(silver).drop(MONTH)))


def test_keys_that_silver_rejected_are_ignored(spark, lake, silver):
    facts = f"{lake.gold}.stored"
    store_facts(spark, silver, facts)
    before = rounded(spark.table(facts))
    update_facts(spark, silver, facts, bars(spark, [bar(0, "NONE", FIRST, 1.0)]).select("ticker", "date"))
    assert rounded(spark.table(facts)) == before


def test_only_months_around_a_change_are_read(spark, silver):
    keys = bars(spark, CHANGES[0]).select("ticker", "date")
    found = changed_rows(spark.table(silver), keys, months_of(spark, silver))
    read = sorted({f.split("month=")[1][:7] for f in found.inputFiles()})
    assert len(read) < 12 < len(months_of(spark, silver))
    assert read[0] <= "2018-12" and read[-1] >= "2019-06"  # 90 rows back and 90 ahead of 2019-03-27
    assert found.select("ticker").distinct().count() == 1
    assert affected_facts(found, keys).count() == 90


def folders(spark, table):
    """month -> folder that the table reads it from"""
    found = [f.rsplit("/", 2) for f in spark.table(table).inputFiles()]
    return {month: folder for folder, month, _ in found}


def test_a_batch_over_most_months_neither_matches_keys_nor_stored_facts(spark, lake, silver, monkeypatch):
    facts = f"{lake.gold}.stored"
    store_facts(spark, silver, facts)
    before = folders(spark, facts)
    # Every 20th day from the fourth month on, a new series, and a key that silver does not get.
    data = [bar(0, "DAY", FIRST + dt.timedelta(days=i), float(i % 900 + 1)) for i in range(100, 1080, 20)]
    data += [bar(0, "NEW", FIRST + dt.timedelta(days=i), 7.0) for i in range(95, 1070, 31)]
    batch = bars(spark, data).drop("stock_id")
    upsert_table(spark, silver, batch, ["ticker", "date"], order=[F.col("close")], id_col="stock_id")

    def fails(*args, **kwargs):
        raise AssertionError("rows are moved to be matched")

    for name in ("upsert_table", "checkpointed", "changed_rows", "affected_facts"):
        monkeypatch.setattr(increment, name, fails)
    keys = batch.unionByName(bars(spark, [bar(0, "NONE", FIRST + dt.timedelta(days=500), 1.0)]).drop("stock_id"))
    keys = keys.select("ticker", "date")
    for _ in range(2):
        update_facts(spark, silver, facts, keys, broadcast_rows=10)
        assert rounded(spark.table(facts)) == rounded(stock_facts(spark.table(silver).drop(MONTH)))
    after = folders(spark, facts)
    assert {m for m in before if after[m] == before[m]} == {"month=2018-01", "month=2018-02", "month=2018-03"}


def test_a_large_batch_in_few_months_reads_what_is_near(spark, lake, silver, monkeypatch):
    facts = f"{lake.gold}.stored"
    store_facts(spark, silver, facts)
    batch = bars(spark, [bar(0, "DAY", FIRST + dt.timedelta(days=i), 3.0) for i in range(400, 460)]).drop("stock_id")
    upsert_table(spark, silver, batch, ["ticker", "date"], order=[F.col("close")], id_col="stock_id")
    monkeypatch.setattr(increment, "replace_months", None)
    update_facts(spark, silver, facts, batch.select("ticker", "date"), broadcast_rows=10)
    assert rounded(spark.table(facts)) == rounded(stock_facts(spark.table(silver).drop(MONTH)))


def test_replaced_months_are_computed_again_after_another_writer(spark, lake, silver):
    calls = []

    def compute():
        now = spark.table(silver).drop(MONTH)
        if not calls:  # another writer commits while the first one computes
            late = bars(spark, [bar(0, "LATE", FIRST, 5.0)]).drop("stock_id")
            upsert_table(spark, silver, late, ["ticker", "date"], order=[F.col("close")], id_col="stock_id")
        calls.append(len(calls))
        return now.filter("date < '2018-03-01'").withColumn("volume", F.col("volume") + 1)

    size = spark.table(silver).count()
    replace_months(spark, silver, compute)
    assert len(calls) == 2
    found = spark.table(silver)
    assert found.count() == size + 1 and found.filter("ticker = 'LATE'").count() == 1
    assert {r["volume"] for r in found.filter("date < '2018-03-01'").collect()} == {11}
    assert {r["volume"] for r in found.filter("date >= '2018-03-01'").collect()} == {10}


@pytest.mark.parametrize("kind", ["decimal(6,2)", "double"])
def test_derived_columns_are_not_moved(spark, kind):
    prices = bars(spark, series()).withColumn("close", F.col("close").cast(kind))
    facts = stock_facts(prices)
    derived = derive_facts(facts.drop(*DERIVED).withColumn(MONTH, F.date_format("trade_date", "yyyy-MM")).hint("rebalance", F.col(MONTH)))
    assert derived.columns == [*facts.columns, MONTH]
    assert rows(derived.drop(MONTH)) == rows(facts)
    plan = derived._jdf.queryExecution().optimizedPlan().toString()
    assert "STK_" in plan.split("RebalancePartitions")[0] and "STK_" not in plan.split("RebalancePartitions")[1]


def test_medians_of_kept_counts(spark, lake):
    create_layers(spark, [lake.bronze], lake.tables_root)
    rnd, table, seen = random.Random(2), f"{lake.bronze}.counts", []
    schema = "g string, x double, y int"
    for load in range(3):
        new = [
            (rnd.choice(["a", "a", "b", None]), rnd.choice([None, float("nan"), rnd.randrange(9) / 2]), rnd.randrange(5))
            for _ in range(301 + load)
        ] + [("empty", None, load)]
        seen += new
        medians = update_medians(spark, table, spark.createDataFrame(new, schema), "g", ["x", "y"])
        got = {r["group"]: (r["x"], r["y"]) for r in medians.collect()}
        for g in ("a", "b", "empty"):
            for i, value in enumerate(("x", "y"), 1):
                own = [r[i] for r in seen if r[0] == g and r[i] is not None and r[i] == r[i]]
                assert got[g][i - 1] == (statistics.median(own) if own else None), (g, value)
    every = spark.createDataFrame(seen, schema)
    assert rows(fill_by_medians(every, "g", ["x", "y"], medians)) == rows(median_fill(every, "g", ["x", "y"]))
    plan = medians._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan  # neither load is looked at again
    assert rows(spark.table(table)) == rows(value_counts(every, "g", ["x", "y"]))


def test_medians_of_a_hot_group(spark, lake):
    create_layers(spark, [lake.bronze], lake.tables_root)
    hot = spark.range(9001).select(F.lit("a").alias("g"), (F.col("id") * 7 % 9001).cast("double").alias("x"))
    medians = update_medians(spark, f"{lake.bronze}.counts", hot, "g", ["x"])
    assert rows(medians) == [("a", 4500.0)]
