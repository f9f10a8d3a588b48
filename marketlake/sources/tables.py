"""Table writes and reads: layer databases, full refresh, append, landing files, reports."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Sequence
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.upsert import MONTH, month_of
from marketlake.sources.versions import refresh


def create_layers(spark: SparkSession, names: Sequence[str], root: str | None = None) -> None:
    """One database per layer, below ``root`` when given."""
    for name in names:
        location = f" LOCATION '{root.rstrip('/')}/{name}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{location}")


def refresh_monthly(
    df: DataFrame, table: str, date: str = "date", derive: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Replace ``table``, partitioned by the month of ``date`` so that later upserts touch few files."""
    return refresh(df.withColumn(MONTH, month_of(date)), table, [MONTH], derive)


def append(df: DataFrame, table: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(table)


def keep_rejects(rejects: DataFrame, table: str, run: str, none: bool = False) -> None:
    """Rejected rows of one run below ``table``: the same run again replaces its own rows and no others.

    ``none`` states that there are no rejects, as a count taken on the way has shown; they are not looked for then.
    """
    spark = rejects.sparkSession
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (run = '{run}')")
        if none:
            return
    if none:
        rejects = spark.createDataFrame([], rejects.schema)
    writer = rejects.withColumn("run", F.lit(run)).write.mode("append").format("parquet").partitionBy("run")
    writer.saveAsTable(table)


def create_empty(spark: SparkSession, table: str, schema: T.StructType, monthly: bool = False) -> None:
    """``CREATE TABLE IF NOT EXISTS`` for an upsert target."""
    if spark.catalog.tableExists(table):
        return
    if monthly:
        schema = T.StructType([*schema.fields]).add(MONTH, "string")
    empty = spark.createDataFrame([], schema)
    writer = empty.write.format("parquet")
    (writer.partitionBy(MONTH) if monthly else writer).saveAsTable(table)


#: Rows of one compressed landing file, which a single task reads.
FILE_ROWS = 2_000_000


def write_landing(
    df: DataFrame, root: str, run: dt.datetime, by: Sequence[str] = (), compression: str = "none"
) -> None:
    """Headered CSV snapshot below ``root``, stamped with the run day and time.

    Folders are ``[<by>=<value>/]run_day=yyyy-MM-dd/run_time=HH-MM-SS``; a snapshot may have many files. With
    ``compression`` ``gzip`` they are ``.csv.gz``.
    """
    stamped = df.withColumn("run_day", F.lit(run.date().isoformat())).withColumn(
        "run_time", F.lit(run.strftime("%H-%M-%S"))
    )
    writer = stamped.write.mode("append").partitionBy(*by, "run_day", "run_time").option("header", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if compression != "none":
        writer = writer.option("maxRecordsPerFile", FILE_ROWS)
    writer.option("compression", compression).csv(root)


#: Folder of the rows whose folder column is empty.
UNNAMED = "unnamed"
_FOLDER = "landing_folder"


def write_landing_tree(
    df: DataFrame, root: str, run: dt.datetime, name: str, by: str | None = None, columns: Sequence[str] | None = None
) -> None:
    """Headered CSV snapshot in the dated tree: ``root[/<by>]/yyyy/Mon/dd/[<by>_]<name>_HH-MM-SS.csv``.

    ``by`` names the column whose trimmed values are the folders; rows without one go to ``unnamed``, and a slash in one
    is written ``%2F``. ``columns`` (default: all) are those of the file. A folder with many rows gets a snapshot of
    several files, ``<name>.part-<n>_HH-MM-SS.csv``, so no task holds a whole folder. Files are written beside the tree
    and then renamed into place, one by one; the same run again replaces its own.
    """
    spark = df.sparkSession
    columns, root = columns or df.columns, root.rstrip("/")
    staging = f"{root}-staging-{uuid4().hex}"
    rows = df.select(*[F.col(f"`{c}`") for c in columns])
    if by:
        folder = F.coalesce(F.nullif(F.trim(F.col(f"`{by}`").cast("string")), F.lit("")), F.lit(UNNAMED))
        rows = df.withColumn(_FOLDER, folder).select(*[F.col(f"`{c}`") for c in columns], _FOLDER)
        rows = rows.hint("rebalance", F.col(_FOLDER))  # few files for a folder; a very large one is still split
    writer = rows.write.option("header", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    (writer.partitionBy(_FOLDER) if by else writer).csv(staging)

    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    written = [path(staging)] if not by else [s.getPath() for s in files.listStatus(path(staging)) if s.isDirectory()]
    stamp = run.strftime("%H-%M-%S")
    for source in written:
        owner = unquote(source.getName().split("=", 1)[1]).replace("/", "%2F") if by else ""
        leaf = path("/".join([root, *([owner] if by else []), run.strftime("%Y/%b/%d")]))
        stem = f"{owner}_{name}" if by else name
        files.mkdirs(leaf)
        own = re.compile(rf"{re.escape(stem)}(\.part-\d+)?_{stamp}\.csv")
        for status in files.listStatus(leaf):
            if own.fullmatch(status.getPath().getName()):
                files.delete(status.getPath(), False)
        parts = sorted(s.getPath().getName() for s in files.listStatus(source) if s.getPath().getName().endswith(".csv"))
        for number, part in enumerate(parts):
            marked = f"{stem}.part-{number:05d}" if len(parts) > 1 else stem
            if not files.rename(path(source, part), path(leaf, f"{marked}_{stamp}.csv")):
                raise OSError(f"{source}/{part} could not be moved to {leaf}")
    files.delete(path(staging), True)


def write_report(results: DataFrame, path: str, run: dt.datetime) -> None:
    """Suite results as JSON lines, one run after the other."""
    results.withColumn("run_ts", F.lit(run)).write.mode("append").json(path)


def write_batch_report(results: DataFrame, path: str, batch: str) -> None:
    """Suite results of one micro-batch as JSON lines; the same batch again replaces its own."""
    results.write.mode("overwrite").json(f"{path}/batch={batch}")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Layer metrics as one headered CSV (one row per table)."""
    metrics.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table, for sites that keep the layers in a relational store."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 10_000, **options: str) -> None:
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, batchsize=str(batch), **options).save()
