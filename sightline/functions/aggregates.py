"""Aggregate expressions. All of them combine map-side, so a hot group never reaches one task whole."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(p: Column) -> Column:
    return F.count_if(p)


def sum_where(p: Column, v: Column | int, default=0) -> Column:
    """Sum of `v` where `p`; with `default=None` a group without a hit gives null."""
    value = v if isinstance(v, Column) else F.lit(v)
    picked = F.when(p, value)
    return F.sum(picked if default is None else picked.otherwise(F.lit(default)))


def weighted_avg(x: Column, w: Column) -> Column:
    return F.sum(x * w) / F.nullif(F.sum(w), F.lit(0))


def ratio(num: Column, den: Column) -> Column:
    return num / F.nullif(den, F.lit(0))


def share(num: Column, den: Column) -> Column:
    """Unrounded percentage, null when the denominator is zero."""
    return num * F.lit(100.0) / F.nullif(den.cast("double"), F.lit(0.0))


def pct(num: Column, den: Column, zero: float | None = None, digits: int = 2) -> Column:
    out = F.round(share(num, den), digits)
    return out if zero is None else F.coalesce(out, F.lit(float(zero)))


def years_between(first: Column, last: Column) -> Column:
    return F.year(last) - F.year(first)


def days_between(first: Column, last: Column) -> Column:
    return F.datediff(last, first)
