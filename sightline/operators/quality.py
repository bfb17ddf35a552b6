"""Table checks. Each returns the failing rows; the report counts them without raising.

A table can be checked while it is written: `write_checked` counts the failing rows of its row checks as
metrics observed by the write itself, so that no check reads the table again. Only repeated
values need a pass of their own, over one column of what was written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sightline.functions.columns import flag


def null_rows(col: str) -> Column:
    return F.col(col).isNull()


def foreign_values(col: str, values: list) -> Column:
    return flag(~F.col(col).isin(values))


def outside_range(col: str, low=None, high=None, where: str | None = None) -> Column:
    c = F.col(col)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return flag(bad if where is None else bad & F.expr(where))


def breaks_expression(col: str, expression: str) -> Column:
    return flag(F.expr(f"not ({col} {expression})"))


ROW_CHECKS = {
    "not_null": null_rows,
    "accepted_values": foreign_values,
    "accepted_range": outside_range,
    "expression_is_true": breaks_expression,
}


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(null_rows(col))


def unique(df: DataFrame, col: str) -> DataFrame:
    """Repeated values with how often they occur."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("occurrences"))
    return counts.filter("occurrences > 1")


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(foreign_values(col, values))


def accepted_range(
    df: DataFrame, col: str, low=None, high=None, where: str | None = None
) -> DataFrame:
    return df.filter(outside_range(col, low, high, where))


def expression_is_true(df: DataFrame, col: str, expression: str) -> DataFrame:
    return df.filter(breaks_expression(col, expression))


def _label(kind: str, model: str, col: str) -> list[Column]:
    return [F.lit(kind).alias("check"), F.lit(model).alias("model"), F.lit(col).alias("column")]


def _row_counts(checks: list[tuple]) -> list[Column]:
    """Failures of each row check, as aggregates c0, c1, ..."""
    return [
        F.count_if(ROW_CHECKS[kind](col, *args)).alias(f"c{i}")
        for i, (kind, col, *args) in enumerate(checks)
    ]


def _row_checks(checks: list[tuple]) -> list[tuple]:
    return [c for c in checks if c[0] in ROW_CHECKS]


def _repeats(df: DataFrame, model: str, checks: list[tuple]) -> list[DataFrame]:
    return [
        unique(df, col).agg(F.count("*").alias("failures")).select(*_label(kind, model, col), "failures")
        for kind, col, *_ in checks
        if kind == "unique"
    ]


def check_report(df: DataFrame, model: str, checks: list[tuple]) -> DataFrame:
    """Failures per check. All row checks of a model share one pass; `unique` needs its own.

    A check is (kind, column, *arguments).
    """
    rows = _row_checks(checks)
    parts = []
    if rows:
        entries = [
            F.struct(*_label(kind, model, col), F.col(f"c{i}").alias("failures"))
            for i, (kind, col, *_) in enumerate(rows)
        ]
        parts.append(df.agg(*_row_counts(rows)).select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionByName, parts + _repeats(df, model, checks))


@dataclass
class Checked:
    """A table as written, and the failures that were counted on the way."""

    table: DataFrame
    model: str
    checks: list[tuple]
    failures: list[int]

    def report(self) -> DataFrame:
        """Like `check_report`; the counted failures are few numbers that are there already."""
        rows = [
            (kind, self.model, col, n)
            for (kind, col, *_), n in zip(_row_checks(self.checks), self.failures)
        ]
        schema = "check string, model string, column string, failures long"
        parts = [self.table.sparkSession.createDataFrame(rows, schema)] if rows else []
        return reduce(DataFrame.unionByName, parts + _repeats(self.table, self.model, self.checks))


def write_checked(
    df: DataFrame, model: str, checks: list[tuple], write: Callable[[DataFrame], DataFrame]
) -> Checked:
    """Write a table and count its failing rows in the same job.

    `write` stores what it is given, all rows of it once, and returns the stored table. Failing rows are
    written like others: checks report, they do not raise.
    """
    rows = _row_checks(checks)
    if not rows:
        return Checked(write(df), model, checks, [])
    seen = Observation(model)
    table = write(df.observe(seen, *_row_counts(rows)))
    counted = seen.get
    return Checked(table, model, checks, [counted[f"c{i}"] for i in range(len(rows))])
