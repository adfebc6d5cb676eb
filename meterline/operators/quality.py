"""Data-quality checks.

All checks of a table are measured in one aggregation over it. Tests that need grouping (unique,
relationships) run as their own distributed jobs. Results are DataFrames; only the few rows of a
report ever reach the driver, and only when a gate asks for them.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.numbers import rounded
from meterline.operators.joins import unmatched_keys

# The names of the comparisons.
COMPARISONS = {"eq": operator.eq, "gt": operator.gt, "gte": operator.ge, "lt": operator.lt, "lte": operator.le}
KINDS = ("row_count", "null_check", "range_check", "custom")


class QualityError(ValueError):
    """A gate found failing checks."""


def compare(value, limit, comparison: str):
    """Apply a named comparison to plain values or Columns."""
    if comparison not in COMPARISONS:
        raise ValueError(f"unknown comparison {comparison!r}, expected one of {sorted(COMPARISONS)}")
    return COMPARISONS[comparison](value, limit)


@dataclass(frozen=True)
class Check:
    """One measured rule.

    ``custom`` takes an aggregate SQL expression: a boolean passes when true, a number is compared
    with the threshold. ``where`` limits the rows a check sees. ``minimum`` is an optional lower
    bound of a range check.
    """

    name: str
    kind: str
    column: str | None = None
    threshold: float | None = None
    comparison: str = "gt"
    expression: str | None = None
    is_boolean: bool = False
    minimum: float | None = None
    where: str | None = None
    severity: str = "error"

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown check kind {self.kind!r}, expected one of {KINDS}")
        if self.kind in ("null_check", "range_check") and not self.column:
            raise ValueError(f"{self.kind} needs a column")
        if self.kind == "custom" and not self.expression:
            raise ValueError("custom needs an expression")
        if self.comparison not in COMPARISONS:
            raise ValueError(f"unknown comparison {self.comparison!r}")
        if self.severity not in ("error", "warn"):
            raise ValueError(f"unknown severity {self.severity!r}")

    def _rows(self, c: Column) -> Column:
        return c if self.where is None else F.when(F.expr(self.where), c)

    def measure(self) -> Column:
        """Struct of the measured value and the verdict."""
        passed: Column
        if self.kind == "row_count":
            value = F.count(self._rows(F.lit(1)))
            passed = compare(value, F.lit(0 if self.threshold is None else self.threshold), self.comparison)
        elif self.kind == "null_check":
            value = F.count(self._rows(F.when(F.col(self.column).isNull(), 1)))
            passed = value == 0
        elif self.kind == "range_check":
            value = F.max(self._rows(F.col(self.column)))
            passed = F.lit(True)
            if self.threshold is not None:
                passed = compare(value, F.lit(self.threshold), self.comparison)
            if self.minimum is not None:
                passed = passed & (F.min(self._rows(F.col(self.column))) >= F.lit(self.minimum))
        else:
            if self.where is not None:
                raise ValueError("put the condition of a custom check into its expression")
            value = F.expr(self.expression)
            if self.is_boolean:
                passed = value
            else:
                passed = compare(value, F.lit(0 if self.threshold is None else self.threshold), self.comparison)
        return F.struct(
            F.lit(self.name).alias("check_name"),
            F.lit(self.kind).alias("kind"),
            F.lit(self.severity).alias("severity"),
            value.cast("double").alias("value"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check, measured in a single pass."""
    names = [f"_c{i}" for i in range(len(checks))]
    measured = df.agg(*[check.measure().alias(n) for check, n in zip(checks, names, strict=True)])
    return measured.select(F.inline(F.array(*names)))


def gate(report: DataFrame) -> list:
    """Rows of a report; raises when a check of severity ``error`` failed."""
    rows = report.collect()
    failed = [r["check_name"] for r in rows if not r["passed"] and r["severity"] == "error"]
    if failed:
        raise QualityError(f"failed checks: {', '.join(sorted(failed))}")
    return rows


@dataclass(frozen=True)
class Rule:
    """A row rule in the manner of schema tests: the failing rows are counted."""

    test: str
    column: str
    holds: str
    where: str | None = None
    severity: str = "error"

    def failures(self) -> Column:
        # NULL counts as passing, as it does in a generated "where not (...)" query.
        broken = ~F.expr(self.holds)
        return F.count_if(broken if self.where is None else broken & F.expr(self.where))


def not_null(column: str, severity: str = "error") -> Rule:
    return Rule("not_null", column, f"{column} IS NOT NULL", severity=severity)


def accepted_values(column: str, values: list) -> Rule:
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return Rule("accepted_values", column, f"{column} IN ({listed})")


def expression_is_true(column: str, expression: str, where: str | None = None, severity: str = "error") -> Rule:
    return Rule("expression_is_true", column, f"{column} {expression}", where, severity)


def run_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Failing rows per rule, all rules in one pass."""
    names = [f"_r{i}" for i in range(len(rules))]
    counted = df.agg(*[rule.failures().alias(n) for rule, n in zip(rules, names, strict=True)])
    rows = [
        F.struct(
            F.lit(rule.test).alias("test"),
            F.lit(rule.column).alias("column_name"),
            F.lit(rule.severity).alias("severity"),
            F.col(n).alias("failures"),
            (F.col(n) == 0).alias("passed"),
        )
        for rule, n in zip(rules, names, strict=True)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _single_test(failures: DataFrame, test: str, column: str) -> DataFrame:
    return failures.select(
        F.lit(test).alias("test"),
        F.lit(column).alias("column_name"),
        F.lit("error").alias("severity"),
        F.col("failures"),
        (F.col("failures") == 0).alias("passed"),
    )


def unique(df: DataFrame, column: str) -> DataFrame:
    """Number of values held by more than one row."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return _single_test(repeated.agg(F.count(F.lit(1)).alias("failures")), "unique", column)


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Number of rows whose key has no parent. NULL keys pass."""
    orphans = unmatched_keys(df, column, parent, parent_column)
    return _single_test(
        orphans.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("failures")), "relationships", column
    )


def combine(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def rule_gate(report: DataFrame) -> list:
    """Rows of a rule report; raises when a rule of severity ``error`` has failures."""
    rows = report.collect()
    failed = [f"{r['test']}({r['column_name']})" for r in rows if not r["passed"] and r["severity"] == "error"]
    if failed:
        raise QualityError(f"failed tests: {', '.join(sorted(failed))}")
    return rows


def freshness(df: DataFrame, column: str, as_of: datetime | Column, warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """Age of the newest row against two limits."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    newest = df.agg(F.max(column).alias("newest"))
    hours = (F.unix_micros(now.cast("timestamp")) - F.unix_micros("newest")) / F.lit(3_600_000_000)
    return newest.select(
        "newest",
        hours.alias("age_hours"),
        F.when(hours.isNull() | (hours > error_hours), "error")
        .when(hours > warn_hours, "warn")
        .otherwise("pass")
        .alias("status"),
    )


def split_valid(df: DataFrame, rule: str, name: str = "is_valid") -> DataFrame:
    """Tag rows with a verdict that is never NULL."""
    return df.withColumn(name, F.coalesce(F.expr(rule), F.lit(False)))


def bad_ratio(condition: str) -> str:
    """SQL for the share of rows meeting a condition; NULL on an empty table."""
    return f"count_if({condition}) * 1.0D / nullif(count(*), 0)"


def partition_validation(df: DataFrame, time: str, first: str, after: str) -> DataFrame:
    """Row count and time extent of a loaded partition, and its rows outside ``[first, after)``."""
    t = F.col(time)
    stray = (t < F.lit(first).cast("timestamp")) | (t >= F.lit(after).cast("timestamp"))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(t).alias("earliest_pickup"),
        F.max(t).alias("latest_pickup"),
        F.count_if(stray).alias("stray_rows"),
    )


def reconcile(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Row counts of both sides per key, matched with a full outer join of the counts."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    both = side(source, "source_rows").join(side(target, "target_rows"), keys, "full")
    left, right = F.coalesce("source_rows", F.lit(0)), F.coalesce("target_rows", F.lit(0))
    return both.select(
        *keys,
        left.alias("source_rows"),
        right.alias("target_rows"),
        (left == right).alias("is_match"),
        rounded(F.lit(100.0) * F.abs(left - right) / F.nullif(left, F.lit(0)), 2).alias("diff_pct"),
    )
