"""Helpers the corpus operators share: tables, stored intermediates, row keys, array expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import scratch_path

#: Characters that separate words: space and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


#: Spark's bound on the rows that a Python worker gets at once, and the bytes of ``small_batches``.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 20

#: Where ``stored`` notes what it has written, inside of ``temporary``.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage is cut, sizes are known, nothing runs twice.

    The files stay, as the result may be read at any time; inside of ``temporary`` they go at its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (noted := _written.get()) is not None:
        noted.append(path)  # before it is written, so that an unfinished one goes as well
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What ``stored`` writes inside is removed at the end: results that need it are to be written inside as well."""
    noted: list[str] = []
    token = _written.set(noted)
    try:
        yield
    finally:
        _written.reset(token)
        for path in noted:
            remove(spark, path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python workers get whole texts a megabyte at a time in what is run inside, by default up to 64 MB.

    A batch is held several times over: by the JVM, by the worker, and as the values made of it.
    """
    before = spark.conf.get(BATCH_CONF, None)
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_CONF)
        else:
            spark.conf.set(BATCH_CONF, before)


def text_key(*columns: str | Column) -> Column:
    """A 64-bit key of a row's content. Only ever used to find rows that are checked again afterwards."""
    return F.xxhash64(*columns)


def row_keys(id_col: str, text: str) -> list[Column]:
    """``key`` and ``key2``: together they tell rows apart that differ in id or text. Rows equal in both share them."""
    return [F.xxhash64(id_col, text).alias("key"), F.hash(text, id_col).alias("key2")]


def keyed_rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(row, key, key2): whole rows with their keys, whatever their columns are called."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(own.alias("row"), *row_keys(id_col, text))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_totals(values: Column) -> Column:
    """For each element of an ``array<int>`` the total of the elements before it.

    Blocks keep the cost near linear: a fold that appends to one long array would copy it at every step.
    """
    block = 256

    def scan(items: Column, start: Column) -> Column:
        return F.aggregate(
            items,
            F.struct(start.alias("total"), F.array().cast("array<int>").alias("out")),
            lambda acc, item: F.struct(
                (acc["total"] + item).alias("total"), F.concat(acc["out"], F.array(acc["total"])).alias("out")
            ),
            lambda acc: acc["out"],
        )

    def blocks(items: Column) -> Column:
        last = F.greatest(F.size(items) - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last, F.lit(block)), lambda at: F.slice(items, at + 1, block))

    def total(items: Column) -> Column:
        return F.aggregate(items, F.lit(0), lambda acc, item: acc + item)

    return bind(
        values,
        lambda items: bind(
            blocks(items),
            lambda parts: F.flatten(F.zip_with(parts, scan(F.transform(parts, total), F.lit(0)), scan)),
        ),
    )
