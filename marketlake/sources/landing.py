"""Landing files: run-day pruning, latest snapshot per leaf folder, typed CSV scans."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.columns import path_file_ts, path_run_day, path_ticker, without_nan
from marketlake.operators.fill import MAX_BROADCAST_GROUPS
from marketlake.session import checkpointed

FILE_COLUMNS = ("file_path", "file_mtime", "run_day", "file_ts", "folder_ticker")
#: What tells the files of one snapshot in a dated tree apart, as in ``AAPL_stock.part-00002_13-16-54.csv``.
PART = r"\.part-\d+(?=_[^/]*$)"
RAW_PATH = "raw_path"
#: The whole line where a field cannot be read as its type, or where there are more or fewer fields; else NULL.
RAW_LINE = "raw_line"
# All columns are parsed, whichever are asked for, so a line is judged the same way by every query.
CSV = {
    "header": True, "quote": '"', "escape": '"', "enforceSchema": "false",
    "columnNameOfCorruptRecord": RAW_LINE, "columnPruning": "false",
}


class NoLandingFiles(LookupError):
    """A landing leaf that a load asked for has no files."""


def landing_glob(root: str, run_day: dt.date | None = None, by_ticker: bool = False) -> str:
    """Glob of one run day (or of all), so other days are never listed into the scan."""
    day = run_day.strftime("%Y/%b/%d") if run_day else "*/*/*"
    return f"{root.rstrip('/')}/{'*/' if by_ticker else ''}{day}/*.csv"


def list_files(spark: SparkSession, glob: str) -> DataFrame | None:
    """Name and time of every landing file; contents are not read.

    ``None`` when nothing matches: a missing leaf is skipped, not an error.
    """
    try:
        files = spark.read.format("binaryFile").load(glob)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    # Rows carry their file's encoded name, so files are known by that; the plain one says ticker and day.
    return files.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("modificationTime").alias("file_mtime"),
        F.col("path").alias(RAW_PATH),
    )


def file_facts(files: DataFrame) -> DataFrame:
    """What a path says: ticker folder, run day, time stamp, leaf folder. Evaluated per file, not per row."""
    names = [c for c in (RAW_PATH,) if c in files.columns]
    path = F.col(names[0] if names else "file_path")
    return files.select(
        "file_path",
        "file_mtime",
        *names,
        F.regexp_replace(path, r"(/run_time=[^/]+)?/[^/]+$", "").alias("leaf"),
        path_ticker(path).alias("folder_ticker"),
        path_run_day(path).alias("run_day"),
        path_file_ts(path).alias("file_ts"),
    )


def latest_files(facts: DataFrame) -> DataFrame:
    """The newest snapshot of every leaf: newest modification time, then the stamp in the name, then the name.

    A snapshot is one file, or all its parts.
    """
    snapshot = F.regexp_replace("file_path", PART, "")
    newest = F.max(F.struct("file_mtime", "file_ts", snapshot.alias("snapshot"))).over(Window.partitionBy("leaf"))
    found = facts.withColumn("_newest", newest).filter(F.col("_newest.snapshot") == snapshot)
    return found.select("leaf", *[c for c in facts.columns if c != "leaf"])


def latest_folders(facts: DataFrame) -> DataFrame:
    """All files of the newest run time of every leaf, for snapshots of several files."""
    newest = facts.groupBy("leaf").agg(F.max("file_ts").alias("file_ts"))
    return facts.join(newest, ["leaf", "file_ts"])


def attach_facts(rows: DataFrame, facts: DataFrame, count: int) -> DataFrame:
    """Rows of the files in ``facts`` (``count`` of them), with their file columns."""
    facts = facts.select(*FILE_COLUMNS)
    if count <= MAX_BROADCAST_GROUPS:
        facts = F.broadcast(facts)
    names = [f"`{c}`" for c in rows.columns if c not in FILE_COLUMNS]
    return rows.select("file_path", *names).join(facts, "file_path").select(*names, *FILE_COLUMNS)


def latest_snapshot(df: DataFrame) -> DataFrame:
    """Rows of the newest file of every leaf, for data that carries ``file_path`` and ``file_mtime``.

    Files are compared, not rows: each task reduces its rows to their distinct files first.
    """
    files = df.select("file_path", "file_mtime").distinct()
    newest = checkpointed(latest_files(file_facts(files)))
    return attach_facts(df, newest, newest.count())


def with_raw_line(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields]).add(RAW_LINE, "string")


def readable(rows: DataFrame) -> DataFrame:
    """The rows whose every field could be read."""
    return rows.filter(F.col(RAW_LINE).isNull()).drop(RAW_LINE)


def unreadable(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """(file_path, raw_line, reasons) of the lines that could not be read: ``unreadable:<field>`` or ``fields``."""
    names = schema.names
    texts = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    fields = F.from_csv(F.col(RAW_LINE), texts, {"quote": '"', "escape": '"'})
    lost = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"`{c}`").isNull() & F.col(f"_fields.c{i}").isNotNull() & (F.lower(f"_fields.c{i}") != "nan"),
                    F.lit(f"unreadable:{c}"),
                )
                for i, c in enumerate(names)
            ]
        )
    )
    other = (F.size(lost) == 0) | F.col(f"_fields.c{len(names)}").isNotNull()
    bad = rows.filter(F.col(RAW_LINE).isNotNull()).withColumn("_fields", fields)
    return bad.select(
        "file_path", RAW_LINE, F.when(other, F.concat(lost, F.array(F.lit("fields")))).otherwise(lost).alias("reasons")
    )


def _read_csv(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType, **options: str) -> DataFrame:
    """Typed scan of headered CSV files with the name of the file of each row, and the line where it cannot be read."""
    schema = with_raw_line(schema)
    rows = spark.read.schema(schema).options(**CSV, **options).csv(paths)
    return rows.select(*[F.col(f"`{c}`") for c in schema.names], F.col("_metadata.file_path").alias("file_path"))


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    columns = with_raw_line(schema).add("file_path", "string").add("file_mtime", "timestamp")
    columns = columns.add("run_day", "date").add("file_ts", "timestamp").add("folder_ticker", "string")
    return spark.createDataFrame([], columns)


def _absent(spark: SparkSession, schema: T.StructType, root: str, required: bool) -> DataFrame:
    if required:
        raise NoLandingFiles(f"no landing files below {root}")
    return _empty(spark, schema)


def _read(spark: SparkSession, facts: DataFrame, schema: T.StructType, **options: str) -> DataFrame:
    # The list of file names on the driver is the one Spark keeps for any file scan.
    files = facts.collect()
    rows = _read_csv(spark, [re.sub(r"([\\\[\]{}*?])", r"\\\1", f[RAW_PATH]) for f in files], schema, **options)
    return without_nan(attach_facts(rows, spark.createDataFrame(files, facts.schema), len(files)))


def read_landing(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    run_day: dt.date | None = None,
    by_ticker: bool = False,
    latest: bool = True,
    required: bool = False,
) -> DataFrame:
    """Rows of a landing tree ``<root>[/<ticker>]/yyyy/Mon/dd/*.csv`` with their file columns.

    With ``latest`` only the newest snapshot of every leaf is opened. Headers must match ``schema``. A line that cannot be
    read is kept in ``raw_line`` (see ``readable`` and ``unreadable``). Without
    files the result is empty, or ``NoLandingFiles`` is raised if they are ``required``.
    """
    files = list_files(spark, landing_glob(root, run_day, by_ticker))
    if files is None:
        return _absent(spark, schema, root, required)
    facts = file_facts(files)
    return _read(spark, latest_files(facts) if latest else facts, schema)


def ticker_from_path(df: DataFrame) -> DataFrame:
    """``ticker`` from the folder above the run day (the historic load ignores the file's own column)."""
    return df.withColumn("ticker", F.col("folder_ticker"))


def read_stamped(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    by: Sequence[str] = (),
    run_day: dt.date | None = None,
    latest: bool = True,
    required: bool = False,
) -> DataFrame:
    """Snapshots in ``[<by>=<value>/]run_day=.../run_time=...`` folders, with the same file columns.

    With ``latest`` only the files of the newest run time per leaf are opened. Files may be compressed (``.csv.gz``).
    """
    root = root.rstrip("/")
    day = run_day.isoformat() if run_day else "*"
    folders = "/".join([*[f"{name}=*" for name in by], f"run_day={day}", "run_time=*"])
    files = list_files(spark, f"{root}/{folders}/*.csv*")
    if files is None:
        return _absent(spark, schema, root, required)
    full = T.StructType([*schema.fields])
    for name in by:
        full = full.add(name, "string")
    facts = file_facts(files)
    return _read(spark, latest_folders(facts) if latest else facts, full, basePath=root)


def stream_landing(spark: SparkSession, folders: str, schema: T.StructType) -> DataFrame:
    """Landing files as they arrive, with their time stamps. Headers must match ``schema``; NaN is read as NULL."""
    rows = spark.readStream.schema(with_raw_line(schema)).options(**CSV).csv(folders)
    return without_nan(
        rows.select(
            *rows.columns,
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_modification_time").alias("file_mtime"),
            path_file_ts(F.col("_metadata.file_path")).alias("file_ts"),
        )
    )
