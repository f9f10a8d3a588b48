"""Row and NULL counts per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.columns import without_nan


def null_profile(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per table: name, number of rows, NULLs over the listed columns.

    Every table is scanned once; NaN counts as NULL. The NULL total of an empty table is NULL.
    """

    def profile(name: str, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        nulls = reduce(lambda a, b: a + b, [F.sum(F.col(c).isNull().cast("long")) for c in cols])
        return without_nan(df).agg(F.count(F.lit(1)).alias("total_records"), nulls.alias("total_null_values")).select(
            F.lit(name).alias("table_name"), "total_records", "total_null_values"
        )

    return reduce(DataFrame.unionByName, [profile(n, df, cols) for n, (df, cols) in tables.items()])
