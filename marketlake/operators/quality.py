"""Declarative expectations, evaluated for a whole suite in one pass over the table."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.columns import number_text, without_nan

SAMPLE_ROWS = 20


@dataclass(frozen=True)
class Expectation:
    """One rule. ``holds`` is three-valued: NULL means the rule does not apply to the row."""

    kind: str
    column: str
    other: str | None = None
    low: Any = None
    high: Any = None
    strict_low: bool = False
    strict_high: bool = False
    pattern: str | None = None
    values: tuple[str, ...] = ()

    @property
    def rule(self) -> str:
        """A stable text form, e.g. ``between(price, low=0, strict_low)``."""
        parts = [self.column]
        if self.other:
            parts.append(self.other)
        if self.low is not None:
            parts.append(f"low={self.low}")
        if self.high is not None:
            parts.append(f"high={self.high}")
        parts += [flag for flag in ("strict_low", "strict_high") if getattr(self, flag)]
        if self.pattern:
            parts.append(self.pattern)
        if self.values:
            parts.append("|".join(self.values))
        return f"{self.kind}({', '.join(parts)})"

    def missing(self) -> Column:
        """Rows the rule ignores."""
        if self.kind == "not_null":
            return F.lit(False)
        if self.kind in ("pair_ge", "pair_gt"):
            return F.col(self.column).isNull() & F.col(self.other).isNull()
        return F.col(self.column).isNull()

    def holds(self, types: dict[str, T.DataType]) -> Column:
        value = F.col(self.column)
        if self.kind == "not_null":
            return value.isNotNull()
        if self.kind == "length":
            return F.char_length(value.cast("string")).between(self.low, self.high)
        if self.kind in ("match", "not_match"):
            text = value if isinstance(types[self.column], T.StringType) else number_text(value)
            found = text.rlike(self.pattern)
            return found if self.kind == "match" else ~found
        if self.kind == "between":
            tests = []
            if self.low is not None:
                tests.append(value > self.low if self.strict_low else value >= self.low)
            if self.high is not None:
                tests.append(value < self.high if self.strict_high else value <= self.high)
            return reduce(lambda a, b: a & b, tests)
        if self.kind == "in_set":
            return value.isin(*self.values)
        if self.kind == "pair_ge":
            return value >= F.col(self.other)
        if self.kind == "pair_gt":
            return value > F.col(self.other)
        if self.kind == "same_day":
            return F.to_date(value) == F.to_date(self.other)
        raise ValueError(f"unknown expectation kind {self.kind}")

    def unexpected(self, types: dict[str, T.DataType]) -> Column:
        return F.coalesce(~self.holds(types), F.lit(False))


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column)


def length(column: str, low: int, high: int) -> Expectation:
    return Expectation("length", column, low=low, high=high)


def match(column: str, pattern: str) -> Expectation:
    return Expectation("match", column, pattern=pattern)


def not_match(column: str, pattern: str) -> Expectation:
    return Expectation("not_match", column, pattern=pattern)


def between(column: str, low=None, high=None, strict_low=False, strict_high=False) -> Expectation:
    return Expectation(
        "between", column, low=low, high=high, strict_low=strict_low, strict_high=strict_high
    )


def in_set(column: str, values) -> Expectation:
    return Expectation("in_set", column, values=tuple(values))


def pair(a: str, b: str, or_equal: bool = True) -> Expectation:
    return Expectation("pair_ge" if or_equal else "pair_gt", a, other=b)


def same_day(column: str, other: str) -> Expectation:
    return Expectation("same_day", column, other=other)


class QualityError(ValueError):
    """A suite failed and the caller asked to stop."""


@dataclass(frozen=True)
class Suite:
    name: str
    expectations: tuple[Expectation, ...] = field(default_factory=tuple)

    def __post_init__(self):
        # The same rule stated twice is evaluated once.
        object.__setattr__(self, "expectations", tuple(dict.fromkeys(self.expectations)))

    def counts(self, df: DataFrame) -> list[Column]:
        """What has to be counted: all rows, and for each rule the rows it ignores and those that break it."""
        types = {f.name: f.dataType for f in df.schema.fields}
        aggregates = [F.count(F.lit(1)).alias("n")]
        for i, rule in enumerate(self.expectations):
            aggregates.append(F.coalesce(F.count_if(rule.missing()), F.lit(0)).alias(f"m{i}"))
            aggregates.append(F.coalesce(F.count_if(rule.unexpected(types)), F.lit(0)).alias(f"u{i}"))
        return aggregates

    def observe(self, df: DataFrame, observation: Observation) -> DataFrame:
        """``df`` without NaN, counted by the job that stores it; ``observed`` turns the counts into results.

        A task that runs twice because its executor was lost is counted twice if a shuffle follows, so compare the
        number of rows with what was stored.
        """
        df = without_nan(df)
        return df.observe(observation, *self.counts(df))

    def observed(self, spark: SparkSession, counts: dict[str, int]) -> DataFrame:
        """The results of counts that were observed."""
        schema = ", ".join(f"{name} bigint" for name in counts)
        return self._results(spark.createDataFrame([tuple(counts.values())], schema))

    def run(self, df: DataFrame) -> DataFrame:
        """One row per rule. All counts come from a single aggregation. NaN counts as a missing value."""
        df = without_nan(df)
        return self._results(df.agg(*self.counts(df)))

    def _results(self, totals: DataFrame) -> DataFrame:
        results = F.array(
            *[
                F.struct(
                    F.lit(i + 1).alias("position"),
                    F.lit(rule.rule).alias("rule"),
                    F.lit(rule.column).alias("column"),
                    F.col(f"m{i}").alias("missing_count"),
                    F.col(f"u{i}").alias("unexpected_count"),
                )
                for i, rule in enumerate(self.expectations)
            ]
        )
        rows = totals.select("n", F.explode(results).alias("r")).select("n", "r.*")
        share = 100.0 * F.col("unexpected_count")
        present = F.col("n") - F.col("missing_count")
        return rows.select(
            F.lit(self.name).alias("suite"),
            "position",
            "rule",
            "column",
            (F.col("unexpected_count") == 0).alias("success"),
            F.col("n").alias("element_count"),
            "missing_count",
            "unexpected_count",
            F.when(F.col("n") > 0, 100.0 * F.col("missing_count") / F.col("n")).alias("missing_percent"),
            F.when(F.col("n") > 0, share / F.col("n")).alias("unexpected_percent_total"),
            F.when(present > 0, share / present).alias("unexpected_percent"),
        )

    @staticmethod
    def summary(results: DataFrame) -> DataFrame:
        """Evaluated, successful and failed rules per suite; a suite passes when all rules do."""
        passed = F.count_if("success")
        return results.groupBy("suite").agg(
            (passed == F.count(F.lit(1))).alias("success"),
            F.count(F.lit(1)).alias("evaluated_expectations"),
            passed.alias("successful_expectations"),
            F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
            (100.0 * passed / F.count(F.lit(1))).alias("success_percent"),
        )

    def failing_rows(self, df: DataFrame, rule: Expectation) -> DataFrame:
        """Every row that breaks ``rule``."""
        return without_nan(df).filter(rule.unexpected({f.name: f.dataType for f in df.schema.fields}))

    def samples(self, df: DataFrame, limit: int = SAMPLE_ROWS, positions: Collection[int] | None = None) -> DataFrame:
        """Up to ``limit`` unexpected values per broken rule, the smallest ones, for all rules (or ``positions``).

        Each rule reads its own columns, and a task keeps and forwards ``limit`` values of them, without a sort.
        """
        df = without_nan(df)
        types = {f.name: f.dataType for f in df.schema.fields}

        def value(rule: Expectation) -> Column:
            columns = [rule.column] + ([rule.other] if rule.other else [])
            return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])

        wanted = [(i, r) for i, r in enumerate(self.expectations, 1) if positions is None or i in positions]

        def smallest(i: int, rule: Expectation) -> DataFrame:
            hits = df.filter(rule.unexpected(types)).select(F.lit(i).alias("position"), value(rule).alias("value"))
            return hits.orderBy("value").limit(limit)

        found = reduce(DataFrame.unionByName, [smallest(i, rule) for i, rule in wanted])
        spec = Window.partitionBy("position").orderBy("value")
        ranked = found.withColumn("sample", F.row_number().over(spec))
        rules = F.array(*[F.lit(rule.rule) for rule in self.expectations])
        return ranked.select(
            F.lit(self.name).alias("suite"),
            "position",
            F.element_at(rules, F.col("position")).alias("rule"),
            "value",
            F.col("sample").cast("long").alias("sample"),
        )

    def clean(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows that break no rule, and rows that break any, with the rules they break. NaN becomes NULL."""
        df = without_nan(df)
        types = {f.name: f.dataType for f in df.schema.fields}
        broken = {rule.rule: rule.unexpected(types) for rule in self.expectations}
        bad = reduce(lambda a, b: a | b, broken.values())
        reasons = F.array_compact(F.array(*[F.when(hit, F.lit(why)) for why, hit in broken.items()]))
        return df.filter(~bad), df.filter(bad).withColumn("reasons", reasons)

    def check(self, df: DataFrame, fail_on_error: bool = False) -> DataFrame:
        """Results of :meth:`run`; raises on a broken rule only when asked to."""
        results = self.run(df)
        if fail_on_error:
            self.raise_failed(results)
        return results

    def raise_failed(self, results: DataFrame) -> None:
        failed = [r["rule"] for r in results.filter(~F.col("success")).collect()]
        if failed:
            raise QualityError(f"{self.name}: {'; '.join(failed)}")
