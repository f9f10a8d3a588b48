"""Loads that validate on the way: rules and faulty lines are counted by the job that stores the rows."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.contract import Contract, enforce, unfit
from marketlake.operators.quality import Suite
from marketlake.session import kept
from marketlake.sources.landing import RAW_LINE, readable, unreadable
from marketlake.sources.tables import keep_rejects
from marketlake.sources.versions import refresh

Counts = dict[str, int]


def stored_counts(stored: DataFrame, counts: Counts) -> Counts | None:
    """The observed counts, if they cover the stored rows exactly; the number of those is read from file footers.

    A lost executor can make Spark run a task twice and count it twice; the suite is then run over the table.
    """
    return counts if counts["n"] == stored.count() else None


def load(
    landed: DataFrame,
    schema: T.StructType,
    shape: Callable[[DataFrame], DataFrame],
    suite: Suite,
    table: str,
    run: str,
    row_wise: bool = True,
) -> Counts | None:
    """Store ``shape`` of the readable rows as ``table``, and the unreadable lines beside it, by run.

    Returns the counts of ``suite``. ``row_wise`` states that ``shape`` reads its input once and row by row; else the
    files are parsed once and ``shape`` reads the parsed rows. Unreadable lines are counted in the pass that parses
    them, and looked up only if there are any.
    """
    lines, rules = Observation(), Observation()
    seen = landed.observe(lines, F.count_if(F.col(RAW_LINE).isNotNull()).alias("unreadable"))
    with nullcontext(seen) if row_wise else kept(seen, "parsed") as rows:
        stored = refresh(suite.observe(shape(readable(rows)), rules), table)
    keep_rejects(unreadable(landed, schema), f"{table}_landing_rejects", run, lines.get["unreadable"] == 0)
    return stored_counts(stored, rules.get)


def stage(
    landed: DataFrame,
    schema: T.StructType,
    shape: Callable[[DataFrame], DataFrame],
    contract: Contract,
    suite: Suite,
    table: str,
    run: str,
    rejects: str | None = None,
) -> Counts | None:
    """As ``load``, behind a contract: typed rows to ``table``, rows that break it to ``<table>_rejects``."""
    faults, rules = Observation(), Observation()
    bad_line = F.col(RAW_LINE).isNotNull()
    rows = shape(landed)
    seen = rows.observe(
        faults,
        F.count_if(bad_line).alias("unreadable"),
        F.count_if(~bad_line & unfit(rows, contract)).alias("unfit"),
    )
    good = enforce(readable(seen), contract)[0]
    stored = refresh(suite.observe(good, rules), table)
    found, place = faults.get, rejects or f"{table}_rejects"
    keep_rejects(enforce(readable(rows), contract)[1], place, run, found["unfit"] == 0)
    lines = place.removesuffix("_rejects") + "_landing_rejects"
    keep_rejects(unreadable(landed, schema), lines, run, found["unreadable"] == 0)
    return stored_counts(stored, rules.get)
