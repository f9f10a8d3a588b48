"""Schema contracts: typed good rows, quarantined bad rows, unique keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = ("smallint", "int", "bigint")
REASONS = "reasons"
_BAD, _TYPED = "_bad", "_typed_"


@dataclass(frozen=True)
class ColumnRule:
    name: str
    type: str
    nullable: bool = False
    max_length: int | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[ColumnRule, ...]
    unique: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [rule.name for rule in self.columns]


def _converted(value: Column, source: T.DataType, target: str) -> Column:
    """``value`` as ``target``, NULL where it does not fit; fractions round to whole numbers."""
    if target in INTEGRAL and isinstance(source, T.StringType):
        value = F.round(value.try_cast("decimal(38,6)"))
    elif target in INTEGRAL and isinstance(source, (T.FractionalType, T.DecimalType)):
        value = F.round(value)
    return value.try_cast(target)


def _checks(
    df: DataFrame, contract: Contract, converted: Mapping[str, str] | None = None
) -> tuple[dict[str, Column], dict[str, Column]]:
    """Converted columns, and one named failure predicate per rule that can be broken.

    ``converted`` names the columns of ``df`` that hold converted values already.
    """
    typed, broken = {}, {}
    for rule in contract.columns:
        source = df.schema[rule.name].dataType
        value = F.col(rule.name)
        if isinstance(source, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        known = (converted or {}).get(rule.name)
        typed[rule.name] = F.col(known) if known else _converted(value, source, rule.type)
        if not rule.nullable:
            broken[f"null:{rule.name}"] = value.isNull()
        if source.simpleString() != rule.type:
            broken[f"type:{rule.name}"] = value.isNotNull() & typed[rule.name].isNull()
        if rule.max_length is not None:
            too_long = F.char_length(value.cast("string")) > rule.max_length
            broken[f"length:{rule.name}"] = F.coalesce(too_long, F.lit(False))
    return typed, broken


def _any(broken: Mapping[str, Column]) -> Column:
    return reduce(lambda a, b: a | b, broken.values(), F.lit(False))


def _reasons(broken: Mapping[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(is_bad, F.lit(why)) for why, is_bad in broken.items()]))


def unfit(df: DataFrame, contract: Contract) -> Column:
    """Whether a row of ``df`` breaks the contract."""
    return _any(_checks(df, contract)[1])


def enforce(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into rows that satisfy the contract, typed, and rejects with their reasons."""
    typed, broken = _checks(df, contract)
    bad = _any(broken)
    good = df.filter(~bad).select(*[typed[name].alias(name) for name in contract.names])
    rejects = df.filter(bad).withColumn(REASONS, _reasons(broken))
    return good, rejects


def checked(df: DataFrame, contract: Contract) -> DataFrame:
    """What ``enforce`` makes of each row, to be stored once where good rows and rejects are read several times: the typed
    values of a good row, the row itself and its reasons of a bad one. ``parted`` splits it."""
    converted = {name: f"{_TYPED}{name}" for name in contract.names}
    typed = _checks(df, contract)[0]
    rows = df.withColumns({converted[name]: value for name, value in typed.items()})
    broken = _checks(rows, contract, converted)[1]
    rows = rows.withColumn(_BAD, _any(broken))
    return rows.select(
        *[F.when(F.col(_BAD), F.col(f"`{c}`")).alias(c) for c in df.columns if c != REASONS],
        *[F.when(~F.col(_BAD), F.col(c)).alias(c) for c in converted.values()],
        F.when(F.col(_BAD), _reasons(broken)).alias(REASONS),
        _BAD,
    )


def parted(rows: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """The good rows and the rejects of ``checked`` rows, as ``enforce`` returns them."""
    good = rows.filter(~F.col(_BAD)).select(*[F.col(f"{_TYPED}{name}").alias(name) for name in contract.names])
    apart = {_BAD, *[f"{_TYPED}{name}" for name in contract.names]}
    return good, rows.filter(_BAD).select(*[F.col(f"`{c}`") for c in rows.columns if c not in apart])


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


class ContractError(ValueError):
    """A table breaks its contract and the caller asked to stop."""


def require_unique(df: DataFrame, keys: Sequence[str], table: str) -> None:
    if not unique_violations(df, keys).isEmpty():
        raise ContractError(f"{table}: duplicate keys on {', '.join(keys)}")
