"""Full refreshes that never lose the old rows: every version is a folder of its own, and a table points at one.

A refresh writes its rows to a new folder first. Only when they are complete does the table change over, by one catalog
call where the columns stay the same, else by putting a finished table of another name in its place. A job that fails
leaves the table as it was, and readers that started before the change go on with the files they know.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.upsert import CODEC, LAST_ID, commits_root, table_location

NEXT = "__next"
KEPT = 1


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def table_versions(spark: SparkSession, table: str) -> str:
    """Folder of a table's versions, beside the database's other tables."""
    database, name = table.rsplit(".", 1) if "." in table else (spark.catalog.currentDatabase(), table)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}-versions"


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _delete(spark: SparkSession, folder: str) -> None:
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def drop_old_versions(spark: SparkSession, table: str, keep: int = KEPT) -> None:
    """Remove versions that the table left behind, but for the ``keep`` newest of them: older readers may use those.

    A version's folder goes with the months that upserts have written beside it and with the log of those.
    """
    files, root = _file_system(spark, table_versions(spark, table))
    if not files.exists(root):
        return
    current = table_location(spark, table).rstrip("/").rsplit("/", 1)[1]
    found = {}
    for status in files.listStatus(root):
        name = status.getPath().getName()
        version = name.removesuffix("-months")
        if version != current:
            found.setdefault(version, []).append((status.getModificationTime(), status.getPath()))
    by_age = sorted(found.values(), key=lambda paths: max(t for t, _ in paths), reverse=True)
    for paths in by_age[keep:]:
        for _, path in paths:
            files.delete(path, True)
        version = paths[0][1].getName().removesuffix("-months")
        _delete(spark, commits_root(f"{table_versions(spark, table)}/{version}"))


def settle(spark: SparkSession, table: str) -> None:
    """Finish or undo a change-over that its driver did not survive."""
    if not spark.catalog.tableExists(f"{table}{NEXT}"):
        return
    if spark.catalog.tableExists(table):  # lost before the change: the finished rows were never in force
        spark.sql(f"DROP TABLE {table}{NEXT}")
    else:
        spark.sql(f"ALTER TABLE {table}{NEXT} RENAME TO {table}")


def _create(spark: SparkSession, table: str, schema: T.StructType, folder: str, partition_by: Sequence[str]) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{parts} LOCATION '{_quoted(folder)}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _points_at_versions(spark: SparkSession, table: str) -> bool:
    return table_location(spark, table).rstrip("/").rsplit("/", 2)[1].endswith("-versions")


def change_over(spark: SparkSession, table: str, schema: T.StructType, folder: str, partition_by: Sequence[str]) -> None:
    """Let ``table`` read from the finished ``folder``."""
    if not spark.catalog.tableExists(table):
        _create(spark, table, schema, folder, partition_by)
        return
    same = not partition_by and _shape(spark.table(table).schema) == _shape(schema)
    if same and _points_at_versions(spark, table):
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{LAST_ID}')")  # ids are given anew
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(folder)}'")
    else:
        _create(spark, f"{table}{NEXT}", schema, folder, partition_by)
        spark.sql(f"DROP TABLE {table}")  # its versions stay
        spark.sql(f"ALTER TABLE {table}{NEXT} RENAME TO {table}")
    spark.catalog.refreshTable(table)


def refresh(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Replace ``table`` by ``df`` and return the stored table; ``df`` may read from the table it replaces.

    If the rows cannot be written, the table keeps its old ones. One writer per table. ``derive`` adds columns that follow
    from the others of a row: those are not moved with it.
    """
    spark = df.sparkSession
    settle(spark, table)
    folder = f"{table_versions(spark, table)}/{uuid4().hex}"
    if partition_by:
        # Rebalancing gathers a partition value into few files and still splits a very large one.
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df = derive(df) if derive else df
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in partition_by], *partition_by)
    schema = df.schema
    writer = df.write.option("compression", CODEC)
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    except Exception:
        _delete(spark, folder)
        raise
    change_over(spark, table, schema, folder, partition_by)
    drop_old_versions(spark, table)
    return spark.table(table)
