"""Ranking and de-duplication by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.ordering import MAX_GROUP_ROWS, number_rows

RANK = "rank_assigned"


def newest_first(df: DataFrame, newest: Sequence[str] = ("insert_datetime",)) -> list[Column]:
    """A total order: latest ``newest`` first, all other columns break ties."""
    lead = [c for c in newest if c in df.columns]
    return [F.col(c).desc_nulls_last() for c in lead] + [F.col(c).asc() for c in df.columns if c not in lead]


def rank_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
    name: str = RANK,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Number every row of a key; rank 1 is the survivor."""
    return number_rows(df, list(keys), list(order or newest_first(df)), name, max_group_rows)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The rank-1 row of every key.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle as well, so a
    task forwards one row per key however many copies it holds.
    """
    spec = Window.partitionBy(*keys).orderBy(*(order or newest_first(df)))
    return df.withColumn(RANK, F.row_number().over(spec)).filter(F.col(RANK) == 1).drop(RANK)


def keep_ranked(df: DataFrame, rank: str = RANK) -> DataFrame:
    """The surviving rows of a table that already carries its rank."""
    return df.filter(F.col(rank) == 1).drop(rank)


def rank_dedup(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
    keep_rank: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Survivors per key, or with ``keep_rank`` every row and its rank."""
    if keep_rank:
        return rank_rows(df, keys, order, max_group_rows=max_group_rows)
    return keep_first(df, keys, order)
