"""Look-back windows over ordered series of any length."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketlake.operators.ordering import MAX_GROUP_ROWS, key_sketch, number_sorted_rows, split_hot

BLOCK_ROWS = 100_000

_ROW, _HOME, _BLOCK = "_row", "_home", "_block"


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    lookback: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    max_group_rows: int = MAX_GROUP_ROWS,
    at_most: int | None = None,
) -> DataFrame:
    """Run ``compute(df, window)`` where ``window`` orders each series by ``time``.

    ``compute`` may look at most ``lookback`` rows back. While every series is short this is one
    shuffle on the keys. A longer series is cut into blocks of consecutive rows, and each block gets
    copies of the ``lookback`` rows before it, so values at block starts stay exact.
    ``time`` must be unique inside a series. ``at_most`` is a known bound on the rows of a series; without
    one below ``max_group_rows`` long series are looked for with a sketch, and only those are cut. Neither
    changes the result.
    """
    keys = list(keys)
    whole = Window.partitionBy(*keys).orderBy(time)
    if at_most is not None and at_most <= max_group_rows:
        return compute(df, whole)
    hot = key_sketch(df, keys, max_group_rows).hot
    if not hot:
        return compute(df, whole)
    short, long = split_hot(df, keys, hot)
    return compute(short, whole).unionByName(_over_blocks(long, keys, time, lookback, compute, max_group_rows))


def _over_blocks(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    lookback: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    max_group_rows: int,
) -> DataFrame:
    # Blocks are cut from the whole table in (keys, time) order, so all have the same size. The rows
    # before a block start belong to the same series or to another one, which the window keeps apart.
    size = max(min(max_group_rows, BLOCK_ROWS), lookback)
    numbered = number_sorted_rows(df, [*[F.col(k) for k in keys], F.col(time)], _ROW)
    home = F.expr(f"({_ROW} - 1) div {size}")
    in_tail = F.expr(f"({_ROW} - 1) % {size}") >= size - lookback
    blocks = F.when(in_tail, F.array(_HOME, F.col(_HOME) + 1)).otherwise(F.array(_HOME))
    placed = numbered.withColumn(_HOME, home).withColumn(_BLOCK, F.explode(blocks))
    done = compute(placed, Window.partitionBy(*keys, _BLOCK).orderBy(time))
    return done.filter(F.col(_BLOCK) == F.col(_HOME)).drop(_ROW, _HOME, _BLOCK)
