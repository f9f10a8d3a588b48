"""Insert-or-update by a unique key, as a DataFrame and on a month-partitioned table.

Several writers may upsert into one table at the same time. Each writes its months to a folder of its own and then tries
to become the next entry of the table's commit log, which says for every month which folder holds it. A writer that
comes second looks whether its months changed meanwhile: if not, it takes the next number, else it merges its batch
again with what the months hold now. Months are read from where the log says, so a partition that still points to an
older folder misleads nobody; after a commit the partitions follow the log. Ids are set aside in a second log.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from hashlib import sha1
from itertools import accumulate
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.operators.commits import CommitLog
from marketlake.operators.contract import ContractError
from marketlake.operators.dedup import keep_first, newest_first
from marketlake.operators.ordering import MAX_GROUP_ROWS, key_sketch, surrogate_key
from marketlake.session import checkpointed

MAX_BROADCAST_ROWS = 100_000
MONTH = "month"
LAST_ID = "marketlake.last_id"
#: Written tables are read by column, once or twice: the smaller files are worth the time to compress them.
CODEC = "zstd"

_STORED, _APART, _NEW, _HIT, _KNOWN, _FIRST, _PART, _PLACE, _BEFORE = (
    "_stored", "_apart", "_new", "_hit", "_known", "_first", "_part", "_place", "_before"
)


def _replaced(stored: Column, incoming: Column) -> Column:
    """Whether a row takes the place of a stored one, by their ``newer_by``."""
    return F.coalesce(stored.isNull() | (incoming >= stored), F.lit(False))


def _merge(
    target: DataFrame,
    rows: DataFrame,
    count: int,
    keys: list[str],
    id_col: str | None,
    newer_by: str | None,
    last_id: int,
    broadcast_rows: int,
) -> DataFrame:
    """``rows`` (``count`` of them, unique on ``keys``) written over ``target``."""

    # A daily batch is small: the target is then joined where it lies, without a shuffle. Both sides
    # are unique on the key, so the shuffled join beyond the limit has no hot key either.
    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if count <= broadcast_rows else df

    columns = [c for c in target.columns if c not in keys and c != id_col]
    marked = rows.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    replace = F.col("_hit").isNotNull()
    if newer_by:
        stored, incoming = F.col(newer_by), F.col(f"_new_{newer_by}")
        replace = replace & _replaced(stored, incoming)
    updated = target.join(side(marked), keys, "left").select(
        *[
            F.when(replace, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )
    present = target.join(side(rows.select(*keys)), keys, "left_semi").select(*keys)
    added = rows.join(side(present), keys, "left_anti")
    if id_col:
        added = surrogate_key(added, id_col, [F.col(k) for k in keys], start=last_id, at_most=count, unique=True)
    return updated.unionByName(added.select(*target.columns))


def _merge_by_range(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    date: str,
    order: Sequence[Column],
    id_col: str | None,
    newer_by: str | None,
) -> DataFrame:
    """``source`` written over ``target`` in one shuffle, for a batch too large to broadcast; ``date`` is one of ``keys``.

    Both sides go by ranges of date and key, so a task has all rows of its keys and few months to write. ``_stored`` tells
    the rows of the target from new ones, which have no id yet; ``_hit`` those whose key is in the batch. As in a join, a
    key that holds a NULL meets no other row.
    """
    by = [date, *[k for k in keys if k != date]]
    columns = [c for c in target.columns if c not in by and c not in (id_col, MONTH)]
    both = target.drop(MONTH).withColumn(_STORED, F.lit(True)).unionByName(
        source.drop(MONTH).withColumn(_STORED, F.lit(False)), allowMissingColumns=True
    )
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in by])
    ranged = both.repartitionByRange(*[F.col(k) for k in by]).withColumn(_APART, F.when(unknown, F.col(_STORED)))
    # The new row of a key that counts comes first, then the other new ones, then what is stored.
    spec = Window.partitionBy(*by, _APART).orderBy(_STORED, *order)
    first, whole = spec.rowsBetween(Window.unboundedPreceding, 0), spec.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    found = ranged.withColumns({
        _NEW: F.first(F.struct(*columns)).over(first),
        _HIT: ~F.first(_STORED).over(first),
        _KNOWN: F.max(_STORED).over(whole),
        _FIRST: F.row_number().over(spec) == 1,
    }).filter(F.col(_STORED) | (F.col(_FIRST) & ~F.col(_KNOWN)))
    replace = F.col(_HIT)
    if newer_by:
        replace = replace & _replaced(F.col(newer_by), F.col(f"{_NEW}.{newer_by}"))
    return found.select(*[
        F.when(replace, F.col(f"{_NEW}.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in target.columns if c != MONTH
    ], _STORED, _HIT)


def _numbered(merged: DataFrame, sizes: dict[int, int], id_col: str, last_id: int) -> DataFrame:
    """The new rows of a kept ``merged`` with the ids after ``last_id``, in its order; ``sizes`` are those of its parts."""
    parts = sorted(sizes)
    ahead = accumulate((sizes[p] for p in parts), initial=last_id)
    offsets = merged.sparkSession.createDataFrame(list(zip(parts, ahead)), f"{_PART} int, {_BEFORE} long")
    # Part number and position come from one id: part << 33 | position.
    placed = merged.filter(~F.col(_STORED)).drop(id_col).withColumn(_PLACE, F.monotonically_increasing_id())
    joined = placed.join(F.broadcast(offsets), F.shiftright(_PLACE, 33).cast("int") == F.col(_PART))
    return joined.withColumn(id_col, F.col(_BEFORE) + F.col(_PLACE).bitwiseAND((1 << 33) - 1) + 1).select(*merged.columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
    id_col: str | None = None,
    newer_by: str | None = None,
    broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``target`` with the rows of ``source`` written over it.

    One source row per key survives (``order``, default newest ``insert_datetime``). A key that
    exists gets all its non-key columns replaced, NULLs included, and keeps its ``id_col``; a new key
    is added and gets the next id after the largest one in ``target``. With ``newer_by`` an existing
    row is only replaced when the source value is at least as large, so the result does not depend on
    the order in which batches arrive.
    """
    source = source.select(*[c for c in target.columns if c != id_col])
    rows = checkpointed(keep_first(source, keys, order or newest_first(source)))  # used four times
    last_id = (target.agg(F.max(id_col)).first()[0] or 0) if id_col else 0
    return _merge(target, rows, rows.count(), list(keys), id_col, newer_by, last_id, broadcast_rows)


def month_of(date: str) -> Column:
    return F.date_format(F.col(date), "yyyy-MM")


def _detail(spark: SparkSession, table: str, name: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == name).first()["data_type"]


def table_location(spark: SparkSession, table: str) -> str:
    return _detail(spark, table, "Location")


def versions_root(spark: SparkSession, table: str) -> str:
    """Folder of the months that upserts have written, beside the table's own."""
    return f"{table_location(spark, table).rstrip('/')}-months"


def point_months(spark: SparkSession, table: str, months: Iterable[str], folder: str) -> None:
    """Let the partitions of ``months`` read from ``folder``; a month changes over at once, its old files stay."""
    known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}  # one row per calendar month
    places = {month: f"PARTITION ({MONTH} = '{month}')" for month in months}
    added = [f"{p} LOCATION '{folder}/{MONTH}={m}'" for m, p in places.items() if f"{MONTH}={m}" not in known]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")
    for month, place in places.items():  # added ones too: another writer may have added them first
        spark.sql(f"ALTER TABLE {table} {place} SET LOCATION '{folder}/{MONTH}={month}'")
    spark.catalog.refreshTable(table)


def commits_root(location: str) -> str:
    """Folder of the logs of the table at ``location``, outside of the folder that the location lies in."""
    parent, name = location.rstrip("/").rsplit("/", 1)
    return f"{parent}-commits/{name}"


def commit_log(spark: SparkSession, table: str, kind: str = "months") -> CommitLog:
    """The table's log. A table that was dropped and made again has another one, even at the same place."""
    made = sha1(_detail(spark, table, "Created Time").encode()).hexdigest()[:12]
    return CommitLog(spark, f"{commits_root(table_location(spark, table))}/{made}/{kind}")


def logged_months(log: CommitLog, number: int) -> dict[str, str]:
    """month -> folder, after entry ``number``, of all months that upserts have written."""
    return log.read(number)["months"] if number else {}


def follow_log(spark: SparkSession, table: str, log: CommitLog) -> None:
    """Let the partitions follow the log, also for writers that were lost after their commit.

    Whoever moved a partition looks at the log again afterwards, so the last one to move it has seen the last entry.
    """
    while True:
        number, unfinished = log.newest(), log.open_entries()
        if not unfinished:
            return
        months, folders = logged_months(log, number), {}
        for month in {m for n in unfinished for m in log.read(n)["changed"]}:
            folders.setdefault(months[month], []).append(month)
        for folder, changed in folders.items():
            point_months(spark, table, sorted(changed), folder)
        if log.newest() == number:
            for n in unfinished:
                log.mark_done(n)


def month_folder(spark: SparkSession, table: str, month: str) -> str:
    """Folder that the partition of ``month`` reads from, without the month's own."""
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({MONTH} = '{month}')").collect()  # no job
    return next(r["data_type"] for r in facts if r["col_name"] == "Location").rstrip("/").rsplit("/", 1)[0]


def months_as_logged(spark: SparkSession, table: str, logged: dict[str, str], months: Sequence[str]) -> DataFrame:
    """The rows of ``months``, each read from where the log says, else from where its partition does.

    They are read by path: what a merge keeps of them does not change when the table changes over.
    """
    schema, folders = spark.table(table).schema, {}
    stored = {r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for month in months:
        if month in logged or month in stored:
            folder = logged[month] if month in logged else month_folder(spark, table, month)
            folders.setdefault(folder, []).append(f"{folder}/{MONTH}={month}")
    found = [
        spark.read.schema(schema).option("basePath", folder).parquet(*paths).select(*schema.names)
        for folder, paths in folders.items()
    ]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def drop_old_months(spark: SparkSession, table: str) -> None:
    """Remove written months that no partition reads from. For quiet times: an older reader may still use them."""
    used = set()
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        month = row["partition"].split("=", 1)[1]
        used.add(f"{month_folder(spark, table, month).rsplit('/', 1)[1]}/{MONTH}={month}")
    root = spark._jvm.org.apache.hadoop.fs.Path(versions_root(spark, table))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return
    for version in files.listStatus(root):
        months = [m.getPath() for m in files.listStatus(version.getPath()) if m.isDirectory()]
        unused = [m for m in months if f"{version.getPath().getName()}/{m.getName()}" not in used]
        for path in [version.getPath()] if len(unused) == len(months) else unused:
            files.delete(path, True)


def reserve_ids(spark: SparkSession, table: str, id_col: str, count: int) -> int:
    """Set ``count`` ids aside and return the last one in use before them.

    Each reservation is an entry of a log of its own, so writers at the same time get ids of their own, and an increment
    does not scan the stored ids; only a table without an entry is scanned, once. Ids are reserved before they are
    written: a failed run leaves a gap, never a repeated id.
    """
    log = commit_log(spark, table, "ids")
    while True:
        number = log.newest()
        last = log.read(number)["last"] if number else _last_id(spark, table, id_col)
        if log.append(number + 1, {"last": last + count}):
            return last


def _last_id(spark: SparkSession, table: str, id_col: str) -> int:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == LAST_ID).first()  # of older versions
    return int(found["value"]) if found else spark.table(table).agg(F.max(id_col)).first()[0] or 0


def _of_keys(target: DataFrame, rows: DataFrame, count: int, keys: Sequence[str]) -> DataFrame:
    """The rows of a monthly table for the keys of ``rows`` (``count`` of them), whose months alone are read."""
    wanted = rows.select(*keys, MONTH).distinct()
    wanted = F.broadcast(wanted) if count <= MAX_BROADCAST_ROWS else wanted
    return target.join(wanted, [*keys, MONTH], "left_semi").select(*target.columns)


def upsert_table(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    date: str = "date",
    order: Sequence[Column] | None = None,
    id_col: str | None = None,
    newer_by: str | None = None,
    then: Callable[[DataFrame], object] | None = None,
    broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> None:
    """Upsert ``source`` into ``table``, a Parquet table partitioned by ``month`` of ``date``.

    Only the months present in the batch are read and rewritten. They are written to new folders, and their
    partitions point there once all are complete: until then, and if the job is lost, the table keeps its old months.
    Running the same batch again gives the same table. Batches of several writers are merged one after the other, in the
    order of their commits.

    A batch beyond ``broadcast_rows`` is moved once, together with the months that it touches; it is read three times,
    so keep one that is costly to compute. ``then`` is called with the rows that the table has for the keys of the batch
    afterwards.
    """
    target = spark.table(table)
    source = source.withColumn(MONTH, month_of(date)).select(*[c for c in target.columns if c != id_col])
    order = order or newest_first(source.drop(MONTH))
    counts = source.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*keys)).alias("keys")
    ).collect()  # one row per calendar month in the batch
    months, count, known = [r[MONTH] for r in counts], sum(r["n"] for r in counts), sum(r["keys"] for r in counts)
    small = known <= broadcast_rows or date not in keys or None in months
    if small or (count - known > MAX_GROUP_ROWS and key_sketch(source, keys, MAX_GROUP_ROWS).hot):
        # One row of a key leaves a task here, however many it has.
        source = checkpointed(keep_first(source, keys, order))
        found = source.groupBy(MONTH).count().collect()
        months, count = [r[MONTH] for r in found], sum(r["count"] for r in found)
    if None in months:
        raise ContractError(f"{table}: rows without {date}")
    if not months:
        if then:
            then(target.limit(0))
        return
    months = sorted(months)
    log = commit_log(spark, table)
    follow_log(spark, table, log)
    last_id = reserve_ids(spark, table, id_col, count) if id_col and small else 0
    while True:
        seen = log.newest()
        logged = logged_months(log, seen)
        touched = months_as_logged(spark, table, logged, months)
        folder, kept = f"{versions_root(spark, table)}/{uuid4().hex}", None
        if small:
            merged = _merge(touched, source, count, [*keys, MONTH], id_col, newer_by, last_id, broadcast_rows)
            written = merged.hint("rebalance", F.col(MONTH))
        else:
            written = kept = _merge_by_range(touched, source, keys, date, order, id_col, newer_by).persist()
            if id_col:
                new = kept.filter(~F.col(_STORED)).groupBy(F.spark_partition_id().alias(_PART)).count()
                sizes = {r[_PART]: r["count"] for r in new.collect()}  # one row per part
                last_id = reserve_ids(spark, table, id_col, sum(sizes.values())) if sizes else 0
                written = kept.filter(_STORED).unionByName(_numbered(kept, sizes, id_col, last_id))
            written = written.withColumn(MONTH, month_of(date))
        written.select(*target.columns).write.partitionBy(MONTH).option("compression", CODEC).parquet(folder)
        if _commit(log, seen, months, folder):
            break
        if kept:
            kept.unpersist()
    follow_log(spark, table, log)
    if then:
        # What was merged is what the table has now, if no other writer came in between.
        alone = kept is not None and not id_col and log.newest() == seen + 1
        then(kept.filter(_HIT).withColumn(MONTH, month_of(date)).select(*target.columns) if alone
             else _of_keys(spark.table(table), source, count, keys))
    if kept:
        kept.unpersist()


def replace_months(
    spark: SparkSession,
    table: str,
    compute: Callable[[], DataFrame],
    date: str = "date",
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Let ``table``, partitioned by ``month`` of ``date``, hold the rows of ``compute`` in place of all it has in their months.

    The stored rows of those months are neither read nor moved. A writer that comes second calls ``compute`` again.
    ``derive`` adds columns that follow from the others of a row: those are not moved with it.
    """
    columns = spark.table(table).columns
    log = commit_log(spark, table)
    follow_log(spark, table, log)
    while True:
        seen, folder = log.newest(), f"{versions_root(spark, table)}/{uuid4().hex}"
        rows = compute().withColumn(MONTH, month_of(date)).hint("rebalance", F.col(MONTH))
        rows = derive(rows) if derive else rows
        rows.select(*columns).write.partitionBy(MONTH).option("compression", CODEC).parquet(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)  # one folder per calendar month
        months = sorted(f.getPath().getName().split("=", 1)[1] for f in found if f.isDirectory())
        if not months or _commit(log, seen, months, folder):
            break
    follow_log(spark, table, log)


def _commit(log: CommitLog, seen: int, months: Sequence[str], folder: str) -> bool:
    """Put ``folder`` in force for ``months``; False if another writer changed one of them after entry ``seen``."""
    before = logged_months(log, seen)
    while True:
        now = logged_months(log, seen)
        if any(now.get(m) != before.get(m) for m in months):
            return False
        if log.append(seen + 1, {"months": now | dict.fromkeys(months, folder), "changed": list(months)}):
            return True
        seen = log.newest()
