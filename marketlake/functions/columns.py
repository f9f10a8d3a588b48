"""Column helpers shared by the operators. All of them stay inside Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trim_strings(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Strip leading and trailing spaces from ``cols`` (default: every string column)."""
    names = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.trim(F.col(c)) for c in names})


def relative_change(now: Column, before: Column) -> Column:
    """``(now - before) / before``; NULL without a usable previous value."""
    return F.when(before.isNotNull() & (before != 0), (now - before) / before)


def change(now: Column, before: Column) -> Column:
    """``now - before``; NULL when the previous value is missing or zero."""
    return F.when(before.isNotNull() & (before != 0), now - before)


def number_text(value: Column) -> Column:
    """The whole text of a number without trailing zeros; an exponent is written out where 38 digits hold it exactly."""
    text = value.cast("string")
    plain = F.lit(None).cast("string")
    for kind in ("decimal(38,0)", "decimal(38,20)", "decimal(38,37)"):
        fixed = value.try_cast(kind)
        plain = F.coalesce(plain, F.when(fixed.cast("double") == value.cast("double"), fixed.cast("string")))
    text = F.when(text.contains("E"), F.coalesce(plain, text)).otherwise(text)
    padded = text.contains(".") & ~text.contains("E")
    return F.when(padded, F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def missing_as_null(value: Column) -> Column:
    """Treat NaN like NULL."""
    return F.when(~F.isnan(value), value)


def without_nan(df: DataFrame) -> DataFrame:
    """Every floating column with NULL for NaN."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: missing_as_null(F.col(c)) for c in floating})


def landing_day(ts: Column) -> Column:
    """``yyyy/Mon/dd`` folder of a run."""
    return F.date_format(ts, "yyyy/MMM/dd")


def landing_time(ts: Column) -> Column:
    """``HH-MM-SS`` file stamp of a run."""
    return F.date_format(ts, "HH-mm-ss")


# A landing file is [<ticker>/]yyyy/Mon/dd/<name>HH-MM-SS.csv; a snapshot written by Spark
# is run_day=yyyy-MM-dd/run_time=HH-MM-SS/<part>.csv
PATH_DAY = r"/(\d{4})/([A-Z][a-z]{2})/(\d{2})/[^/]+$"
PATH_TIME = r"(\d{2}-\d{2}-\d{2})\.csv$"
PATH_TICKER = r"([^/]+)/\d{4}/[A-Z][a-z]{2}/\d{2}/[^/]+$"
STAMP = r"/run_day=(\d{4}-\d{2}-\d{2})/run_time=(\d{2}-\d{2}-\d{2})/[^/]+$"


def path_ticker(path: Column) -> Column:
    """Folder above the run day."""
    return F.regexp_extract(path, PATH_TICKER, 1)


def _folder_day(path: Column) -> Column:
    return F.concat_ws("-", *[F.regexp_extract(path, PATH_DAY, i) for i in (1, 2, 3)])


def path_run_day(path: Column) -> Column:
    named = F.try_to_timestamp(_folder_day(path), F.lit("yyyy-MMM-dd"))
    stamped = F.try_to_timestamp(F.regexp_extract(path, STAMP, 1), F.lit("yyyy-MM-dd"))
    return F.coalesce(named, stamped).cast("date")


def path_file_ts(path: Column) -> Column:
    """Run day and time as one timestamp; NULL when the path carries no time."""
    named = F.concat(_folder_day(path), F.lit(" "), F.regexp_extract(path, PATH_TIME, 1))
    stamped = F.concat(F.regexp_extract(path, STAMP, 1), F.lit(" "), F.regexp_extract(path, STAMP, 2))
    return F.coalesce(
        F.try_to_timestamp(named, F.lit("yyyy-MMM-dd HH-mm-ss")),
        F.try_to_timestamp(stamped, F.lit("yyyy-MM-dd HH-mm-ss")),
    )
