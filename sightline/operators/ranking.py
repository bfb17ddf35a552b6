"""Row numbers, ranks and top-k without ever sorting an unbounded group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline.sources.tables import durable

COPIES_PER_PIECE = 1_000_000


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in `order`. The rank limit is applied map-side before the
    shuffle, so a hot key sends one candidate per task."""
    rn = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rn).filter("__rn = 1").drop("__rn")


def _stretches(df: DataFrame, n: str, per_task: int) -> DataFrame:
    """Rows cut into stretches `__start`..`__last` of their `n` copies."""
    zero = F.lit(0).cast("long")
    starts = F.sequence(zero, F.col(n) - 1, F.lit(per_task).cast("long"))
    cut = df.withColumn("__start", F.explode(starts))
    return cut.withColumn("__last", F.least(F.col("__start") + per_task, F.col(n)) - 1)


def _pieces(counted: DataFrame, n: str, per_task: int) -> DataFrame:
    """The stretches of each row, dealt out over tasks."""
    keys = [c for c in counted.columns if c != n]
    return _stretches(counted, n, per_task).repartition("__start", *keys)


def repeat_rows(df: DataFrame, n: str, per_task: int = COPIES_PER_PIECE) -> DataFrame:
    """Each row as often as its column `n` says, written out where the row stands.

    Copies are made in stretches of `per_task`, one after the other, so a row with very many copies
    asks for little memory, and what is multiplied is never shuffled.
    """
    copies = _stretches(df, n, per_task).withColumn("__copy", F.explode(F.sequence("__start", "__last")))
    return copies.drop("__copy", "__start", "__last", n)


def spell_out_copies(df: DataFrame, out: str, per_task: int = COPIES_PER_PIECE) -> DataFrame:
    """Number the identical copies of each row 0, 1, ...

    Copies are first counted (combined map-side) and then written out again in pieces of
    `per_task`, which are dealt out so that a row with very many copies fills several tasks.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("__copies"))
    pieces = _pieces(counted, "__copies", per_task)
    return pieces.select(*df.columns, F.explode(F.sequence("__start", "__last")).alias(out))


def _hot_copies_apart(
    df: DataFrame, out: str, per_task: int = COPIES_PER_PIECE, alike: list[str] | None = None
) -> DataFrame:
    """Rows with a number `out` that tells copies apart where a row has more than `per_task` of them.

    Such rows are found by counting hashes, so that all others stay where they are; the hot ones
    alone are counted whole and spelled out. Other copies are alike and all hold 0. Copies agree in any
    columns: where no more than `per_task` rows agree in the few columns `alike`, no other is read.
    """
    if alike:
        groups = df.groupBy(F.xxhash64(*alike).alias("__hash")).agg(F.count("*").alias("__rows"))
        if groups.filter(F.col("__rows") > per_task).isEmpty():
            return df.withColumn(out, F.lit(0).cast("long"))
    named = df.withColumn("__hash", F.xxhash64(*df.columns))
    # At most one row for every `per_task` rows, hence a safe broadcast.
    counted = named.groupBy("__hash").agg(F.count("*").alias("__rows"))
    hot = durable(counted.filter(F.col("__rows") > per_task).select("__hash"))
    if hot.isEmpty():
        return df.withColumn(out, F.lit(0).cast("long"))
    rest = named.join(F.broadcast(hot), "__hash", "left_anti").drop("__hash")
    many = named.join(F.broadcast(hot), "__hash", "left_semi").drop("__hash")
    spelled = spell_out_copies(many, out, per_task)
    return rest.withColumn(out, F.lit(0).cast("long")).unionByName(spelled)


def global_row_number(
    df: DataFrame,
    order: list[Column],
    out: str,
    unique: bool = False,
    stored: bool = False,
    alike: list[str] | None = None,
) -> DataFrame:
    """Positions 1, 2, ... over one total order, without a single-task window.

    Range-sort, write, then add to each row's place in its own sort partition the number of
    rows in the partitions before it (one row per partition, the only data that is summed in
    one task). All remaining columns break ties, and so do copy numbers unless the caller
    states that rows are `unique`; hot order keys are thereby split between partitions. The
    sorted rows are written once because range bounds are sampled anew on every run.
    A caller whose frame is `stored`, hence cheap to read again, has the rows shuffled for the sort
    alone: only copies that are too many for one task are counted whole, and looked for in the columns
    `alike` first.
    """
    if unique:
        rows = df
    else:
        rows = _hot_copies_apart(df, "__copy", alike=alike) if stored else spell_out_copies(df, "__copy")
    ties = [F.col(c).asc_nulls_last() for c in rows.columns]
    placed = durable(
        rows.orderBy(*order, *ties)
        .withColumn("__place", F.monotonically_increasing_id())
        .drop("__copy")
    )
    part = F.shiftright("__place", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("__part"), F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    # One row per sort partition, hence a safe broadcast.
    numbered = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    within = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn(out, F.col("__offset") + within + 1).drop(
        "__part", "__offset", "__place"
    )


def top_k(
    df: DataFrame, order: list[Column], k: int, partition: list[str] | None = None
) -> DataFrame:
    """First `k` rows in `order`, overall or per group."""
    if partition is None:
        return df.orderBy(*order).limit(k)
    rn = F.row_number().over(W.partitionBy(*partition).orderBy(*order))
    return df.withColumn("__rn", rn).filter(F.col("__rn") <= k).drop("__rn")


def add_rank(df: DataFrame, out: str, order: list[Column], partition: list[str]) -> DataFrame:
    """Row number within groups of bounded size; `global_row_number` numbers everything else."""
    window = W.partitionBy(*partition).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window))


def ranked_top_k(
    df: DataFrame, order: list[Column], k: int, ranks: dict[str, list[str]]
) -> DataFrame:
    """First `k` rows in `order` with their rank in each of the groupings (none: overall)."""
    out = top_k(df, order, k)
    for name, partition in ranks.items():
        out = add_rank(out, name, order, partition or [F.lit(1)])
    return out
