"""Grouped profiles at one or several grains, exact medians and modes, tagged unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def at_grains(df: DataFrame, tag: str, grains: dict[str, dict[str, Column]], where=None) -> DataFrame:
    """Repeat each row once per grain under one struct key `g` (tag plus that grain's keys).

    One scan and one shuffle then serve all grains, and later results join on `g` alone.
    `where` maps a tag to the condition under which a row belongs to that grain.
    """
    names = list(dict.fromkeys(n for keys in grains.values() for n in keys))
    kinds = dict(
        df.select(
            *[next(k[n] for k in grains.values() if n in k).alias(n) for n in names]
        ).dtypes
    )
    where = where or {}
    structs = []
    for name, keys in grains.items():
        fields = [keys[n] if n in keys else F.lit(None).cast(kinds[n]) for n in names]
        g = F.struct(
            F.lit(name).alias(tag), *[f.cast(kinds[n]).alias(n) for f, n in zip(fields, names)]
        )
        structs.append(F.when(where[name], g) if name in where else g)
    return df.withColumn("g", F.explode(F.array_compact(F.array(*structs))))


def multi_grain(
    df: DataFrame, tag: str, grains: dict[str, dict[str, Column]], aggs: list[Column], where=None
) -> DataFrame:
    """Aggregate at several grains in one pass; keys outside a grain are null."""
    out = at_grains(df, tag, grains, where).groupBy("g").agg(*aggs)
    return out.select("g.*", *out.columns[1:])


def activity_span(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    """First and last activity per group with the span in days and calendar years."""
    first, last = F.min(date), F.max(date)
    return df.groupBy(*keys).agg(
        first.alias("first_date"),
        last.alias("last_date"),
        F.datediff(last, first).alias("days_of_activity"),
        (F.year(last) - F.year(first)).alias("years_of_data"),
    )


def grouped_mode(
    df: DataFrame, keys: list[str], value: str, weight: Column, out: str
) -> DataFrame:
    """Most frequent non-null value per group, the lowest among equals, as two combined sums."""
    counts = (
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("__n"))
    )
    best = F.min_by(F.col(value), F.struct(-F.col("__n"), F.col(value)))
    return counts.groupBy(*keys).agg(best.alias(out))


def value_range(value: Column) -> Column:
    """A number that never falls as the value rises: sign, exponent and 12 bits of the mantissa."""
    size = F.abs(value)
    power = F.floor(F.log2(size))
    step = F.floor((size / F.pow(F.lit(2.0), power) - 1) * 4096)
    return F.when(value == 0, F.lit(0)).otherwise(
        (F.signum(value) * ((power + 1100) * 4096 + step)).cast("long")
    )


def grouped_median(
    df: DataFrame, keys: list[str], value: str, weight: Column, out: str
) -> DataFrame:
    """Exact interpolated median per group, for groups of one grain or of many alike.

    Weights are first summed by ranges of values, and the running sums tell which ranges hold the middle
    ranks. A second pass takes the rows of these ranges alone, sums them by value and puts the
    few values left in order. So values are shuffled once, whatever the number of grains, and no
    task holds or sorts all values of a group.
    """
    v = F.col(value).cast("double")
    rows = df.filter(F.col(value).isNotNull()).select(
        *keys, v.alias("__v"), value_range(v).alias("__part"), weight.alias("__n")
    )
    by_key = W.partitionBy(*keys)
    before = by_key.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    parts = (
        rows.groupBy(*keys, "__part")
        .agg(F.sum("__n").alias("__size"))
        .withColumn("__before", F.coalesce(F.sum("__size").over(before), F.lit(0)))
        .withColumn("__total", F.sum("__size").over(by_key))
    )
    low, high = F.expr("(__total - 1) div 2"), F.expr("__total div 2")
    inside = lambda rank: (
        (rank >= F.col("__before")) & (rank < F.col("__before") + F.col("__size"))
    )
    picked = parts.filter(inside(low) | inside(high)).drop("__size")
    counts = (
        null_safe_join(rows, picked, [*keys, "__part"], "inner")
        .groupBy(*keys, "__v")
        .agg(*[F.first(c).alias(c) for c in ("__part", "__before", "__total")], F.sum("__n").alias("__n"))
    )
    run = W.partitionBy(*keys, "__part").orderBy("__v").rowsBetween(W.unboundedPreceding, -1)
    placed = counts.withColumn("__from", F.col("__before") + F.coalesce(F.sum("__n").over(run), F.lit(0)))
    holds = lambda rank: (
        (rank >= F.col("__from")) & (rank < F.col("__from") + F.col("__n"))
    )
    return placed.groupBy(*keys).agg(
        (
            (F.max(F.when(holds(low), F.col("__v"))) + F.max(F.when(holds(high), F.col("__v")))) / 2
        ).alias(out)
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which null keys match each other; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = reduce(
        lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    )
    return left.join(renamed, same, how).drop(*[f"__r_{k}" for k in keys])


def union_tagged(
    parts: dict[str, DataFrame], tag: str, columns: dict[str, str]
) -> DataFrame:
    """Stack differently shaped tables into one: missing columns become typed nulls."""
    stacked = []
    for name, df in parts.items():
        have = set(df.columns)
        stacked.append(
            df.select(
                F.lit(name).alias(tag),
                *[
                    (F.col(c) if c in have else F.lit(None)).cast(kind).alias(c)
                    for c, kind in columns.items()
                ],
            )
        )
    return reduce(DataFrame.unionByName, stacked)


def kpi_rows(df: DataFrame, kpis: list[tuple[tuple[str, ...], Column]], names: list[str]) -> DataFrame:
    """Long-format indicator table from one aggregate pass over `df`.

    Each indicator is (labels, aggregate); `names` are the label columns and the value column.
    """
    totals = df.agg(*[value.alias(f"v{i}") for i, (_, value) in enumerate(kpis)])
    rows = [
        F.struct(
            *[F.lit(text).alias(n) for text, n in zip(labels, names[:-1])],
            F.col(f"v{i}").alias(names[-1]),
        )
        for i, (labels, _) in enumerate(kpis)
    ]
    return totals.select(F.inline(F.array(*rows)))
