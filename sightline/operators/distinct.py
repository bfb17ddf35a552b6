"""Exact distinct counts that roll up like sums.

Every value gets a dense code, and the values that occur in a group become bits of a few bitmaps of
64 bits, so that a small group takes little more room than its values. Bitmaps of finer groups are OR-ed to those of coarser ones, so facts are looked at
once for all grains, and no aggregate has to expand its rows for each counted column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PARTS = 64


def dictionary(members: DataFrame) -> DataFrame:
    """kind, value, code: dense codes 1, 2, ... of the distinct values of each kind.

    Values are numbered within `PARTS` parts by their hash, and parts follow each other, so that no
    task orders all values of a kind.
    """
    part = F.pmod(F.xxhash64("value"), F.lit(PARTS)).alias("__part")
    values = members.select("kind", "value", part).distinct()
    place = F.row_number().over(W.partitionBy("kind", "__part").orderBy("value"))
    before = W.partitionBy("kind").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        values.groupBy("kind", "__part")
        .agg(F.count("*").alias("__n"))
        .withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    # At most `PARTS` rows for each kind, hence a safe broadcast.
    return (
        values.withColumn("__place", place)
        .join(F.broadcast(offsets), ["kind", "__part"])
        .select("kind", "value", (F.col("__offset") + F.col("__place")).alias("code"))
    )


def member_bitmaps(df: DataFrame, keys: list[str], kinds: dict[str, list[Column]]) -> DataFrame:
    """keys, kind, bucket, bitmap: which values of each kind occur in each group.

    A value is a tuple of texts, named by its kind; a tuple that holds a null is no value.
    """
    tuples = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.when(~F.exists(F.array(*parts), F.isnull), F.array(*parts)).alias("value"),
        )
        for kind, parts in kinds.items()
    ]
    # Groups and tuples are made distinct before tuples are spelled out by kind.
    wide = df.select(*keys, F.array(*tuples).alias("__tuples")).distinct()
    members = wide.select(*keys, F.inline("__tuples")).filter("value is not null").distinct()
    coded = members.join(dictionary(members), ["kind", "value"])
    bit = F.expr("shiftleft(1L, cast(code % 64 as int))")
    return coded.groupBy(*keys, "kind", F.expr("code div 64").alias("bucket")).agg(
        F.bit_or(bit).alias("bitmap")
    )


def member_counts(bitmaps: DataFrame, keys: list[str], names: dict[str, Column]) -> DataFrame:
    """Groups by `keys`, which may be coarser than those of the bitmaps, with the counts `names`.

    A name stands for the condition under which a bitmap (by its kind and keys) is counted.
    """
    merged = bitmaps.groupBy(*keys, "kind", "bucket").agg(F.bit_or("bitmap").alias("bitmap"))
    size = F.bit_count("bitmap").cast("long")
    return merged.groupBy(*keys).agg(
        *[F.sum(F.when(where, size).otherwise(0)).alias(name) for name, where in names.items()]
    )
