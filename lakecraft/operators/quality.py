"""Data-quality rules evaluated in one aggregate pass.

A suite is a list of rule objects. Row-level rules (not null, value set,
range, predicate) and the table row-count rule become conditional counts in a
single ``agg`` over the data; the per-rule report is produced by unpivoting
that one row. Key uniqueness and foreign keys need a group-by / anti join and
run as their own (partially aggregated) jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLS = ["rule", "column", "element_count", "unexpected_count", "unexpected_percent", "success"]


class QualityError(Exception):
    """Raised by :func:`run_suite` with ``raise_on_failure`` when a rule fails."""


@dataclass(frozen=True)
class NotNull:
    column: str
    mostly: float = 1.0
    name: str = "expect_column_values_to_not_be_null"

    def counts(self):
        # every row is an element, nulls are the unexpected ones
        return F.count(F.lit(1)), F.count_if(F.col(self.column).isNull())


@dataclass(frozen=True)
class InSet:
    column: str
    values: Sequence
    mostly: float = 1.0
    name: str = "expect_column_values_to_be_in_set"

    def counts(self):
        c = F.col(self.column)
        return F.count(c), F.count_if(c.isNotNull() & ~c.isin(list(self.values)))


@dataclass(frozen=True)
class Between:
    column: str
    min_value: float | None = None
    max_value: float | None = None
    mostly: float = 1.0
    name: str = "expect_column_values_to_be_between"

    def counts(self):
        c = F.col(self.column)
        ok = F.lit(True)
        if self.min_value is not None:
            ok = ok & (c >= self.min_value)
        if self.max_value is not None:
            ok = ok & (c <= self.max_value)
        return F.count(c), F.count_if(c.isNotNull() & ~ok)


@dataclass(frozen=True)
class Satisfies:
    """Row predicate (e.g. ``quantity > 0``); a null result counts as failed."""
    label: str
    predicate: str
    mostly: float = 1.0
    name: str = "expect_rows_to_satisfy"

    @property
    def column(self):
        return self.label

    def counts(self):
        return F.count(F.lit(1)), F.count_if(~F.coalesce(F.expr(self.predicate), F.lit(False)))


@dataclass(frozen=True)
class RowCountBetween:
    min_value: int | None = None
    max_value: int | None = None
    name: str = "expect_table_row_count_to_be_between"
    column: str | None = None
    mostly: float = 1.0

    def counts(self):
        n = F.count(F.lit(1))
        bad = F.lit(False)
        if self.min_value is not None:
            bad = bad | (n < self.min_value)
        if self.max_value is not None:
            bad = bad | (n > self.max_value)
        return n, F.when(bad, F.lit(1)).otherwise(F.lit(0)).cast("long")


def run_suite(df: DataFrame, rules: Sequence, raise_on_failure: bool = False) -> DataFrame:
    """Evaluate ``rules`` over ``df`` in one aggregate job; one report row per
    rule: ``rule, column, element_count, unexpected_count, unexpected_percent,
    success``. Success means ``1 - unexpected/elements >= mostly`` (an empty
    column passes); the row-count rule passes when the count is in range."""
    aggs = []
    for i, r in enumerate(rules):
        n, bad = r.counts()
        aggs += [n.cast("long").alias(f"n{i}"), bad.cast("long").alias(f"u{i}")]
    one = df.agg(*aggs)
    entries = []
    for i, r in enumerate(rules):
        n, u = F.col(f"n{i}"), F.col(f"u{i}")
        if isinstance(r, RowCountBetween):
            pct = F.lit(None).cast("double")
            ok = u == 0
        else:
            pct = F.when(n > 0, F.round(u.cast("double") * 100.0 / n.cast("double"), 4))
            ok = F.when(n == 0, F.lit(True)).otherwise(
                (n - u).cast("double") / n.cast("double") >= F.lit(float(r.mostly)))
        entries.append(F.struct(F.lit(r.name).alias("rule"),
                                F.lit(r.column).cast("string").alias("column"),
                                n.alias("element_count"), u.alias("unexpected_count"),
                                pct.alias("unexpected_percent"), ok.alias("success")))
    report = one.select(F.inline(F.array(*entries)))
    if raise_on_failure:
        failed = [r for r in report.where(~F.col("success")).collect()]   # one row per rule
        if failed:
            raise QualityError(f"{len(failed)} rule(s) failed: {[f.rule for f in failed]}")
    return report


def suite_success(report: DataFrame) -> Column:
    """Overall success of a report (aggregate expression)."""
    return F.bool_and("success")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their counts (partial aggregation)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent row (foreign-key violations)."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()     # collapsed map-side
    return child.join(p, child[child_key] == p["_pk"], "left_anti")


def required_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Missing required column names (schema check, no data read)."""
    return sorted(set(required) - set(df.columns))


def profile(df: DataFrame, columns: Sequence[str] | None = None, approx_distinct: bool = False) -> DataFrame:
    """Per-column profile in one pass: rows, nulls, null fraction, min, max
    (as text), and optionally an HLL distinct estimate (mergeable, no
    per-column shuffle blow-up as exact distinct counts would cause)."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"z{i}"),
                 F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}")]
        if approx_distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"d{i}"))
    one = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        fields = [F.lit(c).alias("column"), F.col("_n").alias("n_rows"), F.col(f"z{i}").alias("n_null"),
                  F.when(F.col("_n") > 0, F.round(F.col(f"z{i}").cast("double") / F.col("_n").cast("double"), 6))
                  .alias("null_fraction"),
                  F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value")]
        if approx_distinct:
            fields.append(F.col(f"d{i}").alias("approx_distinct"))
        rows.append(F.struct(*fields))
    return one.select(F.inline(F.array(*rows)))
