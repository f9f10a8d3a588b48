"""Several writers on one table."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows
from pyspark.sql import functions as F

from marketlake.operators import upsert as upserts
from marketlake.operators.commits import CommitLog
from marketlake.operators.upsert import MONTH, commit_log, drop_old_months, follow_log, logged_months, upsert_table
from marketlake.sources.tables import create_layers, refresh_monthly


def day(month, number):
    return dt.date(2025, month, number)


@pytest.fixture
def table(spark, lake):
    create_layers(spark, [lake.silver], lake.tables_root)
    name = f"{lake.silver}.t"
    stored = [(1, day(1, 5), 1.0), (2, day(2, 5), 2.0)]
    refresh_monthly(spark.createDataFrame(stored, "id bigint, date date, x double"), name)
    return name


def put(spark, table, *data):
    source = spark.createDataFrame(list(data), "date date, x double")
    upsert_table(spark, table, source, ["date"], id_col="id", order=[F.col("x")])


def meanwhile(monkeypatch, act):
    """Run ``act`` once, after the next writer read the table and before it commits."""
    plain, waiting = upserts._commit, [act]

    def commit(*args):
        if waiting:
            waiting.pop()()
        return plain(*args)

    monkeypatch.setattr(upserts, "_commit", commit)


def test_entries_have_one_writer_each(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.newest() == 0 and log.open_entries() == []
    assert log.append(1, {"a": "é"}) and not log.append(1, {"a": 2}) and log.append(2, {"b": 3})
    assert (log.newest(), log.read(1), log.read(2)) == (2, {"a": "é"}, {"b": 3})
    log.mark_done(1)
    assert log.open_entries() == [2]
    assert not [p for p in (tmp_path / "log").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_interleaved_upserts_of_one_month(spark, table, monkeypatch):
    meanwhile(monkeypatch, lambda: put(spark, table, (day(2, 5), 20.0), (day(2, 6), 6.0), (day(2, 7), 7.0)))
    put(spark, table, (day(2, 7), 70.0), (day(2, 8), 8.0))
    found = rows(spark.table(table).drop(MONTH, "id"))
    assert found == [(day(1, 5), 1.0), (day(2, 5), 20.0), (day(2, 6), 6.0), (day(2, 7), 70.0), (day(2, 8), 8.0)]
    assert spark.table(table).select("id").distinct().count() == 5
    assert rows(spark.table(table).filter("x in (1.0, 20.0)").select("id")) == [(1,), (2,)]


def test_interleaved_upserts_of_other_months_are_merged_once(spark, table, monkeypatch):
    meanwhile(monkeypatch, lambda: put(spark, table, (day(1, 6), 6.0), (day(4, 1), 4.0)))
    merges, plain = [], upserts._merge
    monkeypatch.setattr(upserts, "_merge", lambda *args: merges.append(1) or plain(*args))
    put(spark, table, (day(2, 5), 20.0), (day(3, 1), 3.0))
    assert len(merges) == 2  # one for each writer
    found = rows(spark.table(table).drop(MONTH, "id"))
    assert found == [(day(1, 5), 1.0), (day(1, 6), 6.0), (day(2, 5), 20.0), (day(3, 1), 3.0), (day(4, 1), 4.0)]
    assert spark.table(table).select("id").distinct().count() == 5


def test_writers_in_threads(spark, table):
    batches = [[(day(2, 6 + n), float(n)), (day(3, 1), 100.0 + n), (day(4 + n, 1), 0.0)] for n in range(3)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda batch: put(spark, table, *batch), batches))
    spark.catalog.refreshTable(table)
    stored = spark.table(table)
    dates = [day(1, 5), day(2, 5), day(2, 6), day(2, 7), day(2, 8), day(3, 1), day(4, 1), day(5, 1), day(6, 1)]
    assert rows(stored.select("date")) == [(d,) for d in dates]
    assert stored.select("id").distinct().count() == len(dates)
    assert stored.filter(F.col("date") == day(3, 1)).first()["x"] in (100.0, 101.0, 102.0)


def test_a_writer_lost_after_its_commit_is_finished_by_the_next(spark, table, monkeypatch):
    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(upserts, "point_months", lost)
        with pytest.raises(RuntimeError):
            put(spark, table, (day(2, 6), 6.0))
    log = commit_log(spark, table)
    assert log.open_entries() == [1]
    put(spark, table, (day(1, 6), 6.5))
    assert log.open_entries() == []
    assert rows(spark.table(table).select("x")) == [(1.0,), (2.0,), (6.0,), (6.5,)]


def test_a_partition_moved_back_by_a_slow_writer_misleads_nobody(spark, table):
    put(spark, table, (day(2, 6), 6.0))
    old = logged_months(commit_log(spark, table), 1)["2025-02"]
    put(spark, table, (day(2, 7), 7.0))
    upserts.point_months(spark, table, ["2025-02"], old)
    put(spark, table, (day(2, 8), 8.0))
    assert rows(spark.table(table).select("x")) == [(1.0,), (2.0,), (6.0,), (7.0,), (8.0,)]
    drop_old_months(spark, table)
    follow_log(spark, table, commit_log(spark, table))
    assert spark.table(table).count() == 5


def test_a_refreshed_table_starts_a_log_of_its_own(spark, table):
    put(spark, table, (day(2, 6), 6.0))
    again = spark.createDataFrame([(1, day(2, 9), 9.0)], "id bigint, date date, x double")
    refresh_monthly(again, table)
    assert commit_log(spark, table).newest() == 0
    put(spark, table, (day(2, 10), 10.0))
    assert rows(spark.table(table).drop(MONTH)) == [(1, day(2, 9), 9.0), (2, day(2, 10), 10.0)]
