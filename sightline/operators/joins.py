"""Enrichment joins.

Right sides are reduced to one row per key before they meet the left side. Joins carry no
broadcast hint: Spark broadcasts a side only when its measured size is under the session's
threshold, and otherwise splits hot left partitions at run time (adaptive skew join), which
also spreads identical copies and null keys. Spark does that only where both sides come
straight from a shuffle made for the join, so a right side that is already laid out by the
join keys, being grouped by them, goes through `spread_join`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline.functions import aggregates as A
from sightline.functions import columns as X


SALTS = 8
ROWS_PER_PIECE = 1_000_000
SALTS_SETTING = "sightline.join.salts"
TASKS_PER_CORE = 4


def spread_join(
    left: DataFrame, right: DataFrame, keys: list[str], salts: int | None = None
) -> DataFrame:
    """Left join to a table with one row per key, safe for hot and null keys.

    Left rows of a key are dealt to `salts` buckets, by a hash of their columns of fixed width if
    they have any, and the right rows are repeated per bucket. The session setting
    `sightline.join.salts` raises the number for large clusters.
    The added key also makes Spark shuffle the right side for this join, without which it
    would not split what is still hot (copies of one row all fall into one bucket).
    """
    salts = salts or int(left.sparkSession.conf.get(SALTS_SETTING, str(SALTS)))
    narrow = [c for c, kind in left.dtypes if kind not in ("string", "binary") and "<" not in kind]
    parts = F.xxhash64(*(narrow or left.columns))
    dealt = left.withColumn("__salt", F.pmod(parts, F.lit(salts)).cast("int"))
    repeated = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(repeated, [*keys, "__salt"], "left").drop("__salt")


def bucket_join(
    left: DataFrame,
    lookup: DataFrame,
    lat: str,
    lon: str,
    decimals: int = 1,
    keep_buckets: bool = False,
) -> DataFrame:
    """Left join to a table keyed by rounded coordinates (`lat_bucket`, `lon_bucket`)."""
    keyed = left.withColumn("lat_bucket", X.bucket(F.col(lat), decimals)).withColumn(
        "lon_bucket", X.bucket(F.col(lon), decimals)
    )
    known = lookup.filter(F.col("lat_bucket").isNotNull() & F.col("lon_bucket").isNotNull())
    out = spread_join(keyed, known, ["lat_bucket", "lon_bucket"])
    return out if keep_buckets else out.drop("lat_bucket", "lon_bucket")


def with_group_stats(
    df: DataFrame, keys: list[str], aggs: list[Column], where: Column | None = None
) -> DataFrame:
    """Add statistics of each row's group. The group table is combined map-side and joined
    back, so no task has to hold a whole group as a window would."""
    stats = (df if where is None else df.filter(where)).groupBy(*keys).agg(*aggs)
    return spread_join(df, stats, keys)


def match_keys(raw: Column, alt_matches: dict[str, str]) -> Column:
    """All left values a right text matches: itself, and each value whose word it contains."""
    extra = [F.when(raw.contains(word), F.lit(value)) for value, word in alt_matches.items()]
    return F.array_distinct(F.array_compact(F.array(raw, *extra)))


def proximity_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    max_days: int,
    on: tuple[str, str],
    alt_matches: dict[str, str] | None = None,
    right_filter: Column | None = None,
    how: str = "left",
) -> DataFrame:
    """Rows at most `max_days` apart with matching keys, as an equi-join on (key, day slot).

    A right row is listed under each key it matches and in three neighbouring slots; a left
    row stands in one slot, so every pair is found exactly once. The result holds one row per
    pair: feed it day-level tables (`day_counts`) when keys are hot, or use `nearby_events`
    when only counts and the nearest match are wanted.
    """
    width = max(max_days, 1)
    slot_of = lambda day: F.floor(X.day_number(day) / width)
    kept = right if right_filter is None else right.filter(right_filter)
    listed = (
        kept.filter(F.col(right_time).isNotNull())
        .withColumn("__slot0", slot_of(F.col(right_time)))
        .withColumn("__key", F.explode(match_keys(F.col(on[1]), alt_matches or {})))
        .withColumn("__slot", F.explode(F.array(*[F.col("__slot0") + i for i in (-1, 0, 1)])))
        .drop("__slot0")
    )
    keyed = left.withColumn("__key", F.col(on[0])).withColumn("__slot", slot_of(F.col(left_time)))
    keyed, listed = keyed.alias("l"), listed.alias("r")
    after = F.datediff(F.to_date(f"l.{left_time}"), F.to_date(f"r.{right_time}"))
    same_slot = (F.col("l.__key") == F.col("r.__key")) & (F.col("l.__slot") == F.col("r.__slot"))
    return (
        keyed.join(listed, same_slot & (F.abs(after) <= max_days), how)
        .withColumn("days_after", after)
        .withColumn("days_difference", F.abs("days_after"))
        .drop("__key", "__slot")
    )


def pairs_by_distance(
    spots: DataFrame, events: DataFrame, keys: list[str], reaches: dict[str, int]
) -> DataFrame:
    """keys, reach, pairs: how many pairs of equal keys lie within each reach and no smaller one.

    `spots` (keys or some of them, day, n) and `events` (keys, day, c) are counts by day number. `reaches`
    names numbers of days in rising order. Pairs are differences of running sums along the
    days, so work and memory follow the number of days and not that of pairs.
    """
    groups = events.select(*keys).distinct()
    asked = spots.join(groups, [k for k in keys if k in spots.columns])
    rows = (
        asked.select(*keys, "day", "n")
        .unionByName(events.select(*keys, "day", "c"), allowMissingColumns=True)
        .groupBy(*keys, "day")
        .agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    )
    by_day = W.partitionBy(*keys).orderBy("day")
    upto = lambda d: F.coalesce(
        F.sum("c").over(by_day.rangeBetween(W.unboundedPreceding, d)), F.lit(0)
    )
    inside = {name: upto(days) - upto(-days - 1) for name, days in reaches.items()}
    sums = rows.select(*keys, "n", *[c.alias(f"__{name}") for name, c in inside.items()])
    rings, before = [], F.lit(0).cast("long")
    for name in reaches:
        within = F.col(f"__{name}")
        rings.append(
            F.struct(F.lit(name).alias("reach"), (F.col("n") * (within - before)).alias("pairs"))
        )
        before = within
    spelled = sums.filter("n is not null").select(*keys, F.inline(F.array(*rings)))
    return spelled.filter("pairs > 0").groupBy(*keys, "reach").agg(F.sum("pairs").alias("pairs"))


def day_counts(df: DataFrame, key: str, time: str, out: str) -> DataFrame:
    """Rows per (key, day): what remains of a hot key is bounded by the calendar."""
    return df.groupBy(F.col(key), F.to_date(time).alias(time)).agg(F.count("*").alias(out))


def asof_pairs(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    max_days: int,
    on: tuple[str, str],
    tiebreak: list[Column],
    alt_matches: dict[str, str] | None = None,
) -> DataFrame:
    """Each left row with the last matching right row up to its day and the first from it on.

    An as-of merge for row-level tables of any size: both sides are reduced to one row per (key, day),
    on the right the first in `tiebreak`, and laid out in slots of `max_days`. A slot holds the days of
    its own and, as boundary rows, the nearest day of either neighbour, so one pass over it in
    order of the days gives both matches. What was found is joined back by key and day.
    The result has the columns of both sides (those of the right must differ), `days_after` and
    `days_difference`; left rows without a match within `max_days` are left out.
    """
    width = max(max_days, 1)
    slot = lambda day: F.floor(day / width)
    taken = F.struct(*right.columns)
    events = (
        right.filter(F.col(right_time).isNotNull())
        .select(
            F.explode(match_keys(F.col(on[1]), alt_matches or {})).alias("__key"),
            X.day_number(F.col(right_time)).alias("__day"),
            taken.alias("__right"),
            F.struct(*tiebreak).alias("__order"),
        )
        .groupBy("__key", "__day")
        .agg(F.min_by("__right", "__order").alias("__right"))
        .withColumn("__slot", slot(F.col("__day")))
    )
    ends = events.groupBy("__key", "__slot").agg(
        F.min_by(F.struct("__day", "__right"), "__day").alias("first"),
        F.max_by(F.struct("__day", "__right"), "__day").alias("last"),
    )
    carried = ends.select(
        "__key",
        F.inline(
            F.array(
                F.struct((F.col("__slot") - 1).alias("__slot"), F.col("first").alias("e")),
                F.struct((F.col("__slot") + 1).alias("__slot"), F.col("last").alias("e")),
            )
        ),
    ).select("__key", "e.*", "__slot")
    keyed = left.withColumns(
        {"__key": F.col(on[0]), "__day": X.day_number(F.col(left_time))}
    )
    spots = keyed.select("__key", "__day").filter("__day is not null").distinct()
    rows = (
        events.unionByName(carried)
        .withColumn("__event", F.col("__day"))
        .unionByName(
            spots.withColumns({"__slot": slot(F.col("__day")), "__spot": F.lit(True)}),
            allowMissingColumns=True,
        )
    )
    found = F.when(F.col("__event").isNotNull(), F.struct("__event", "__right"))
    ahead = W.partitionBy("__key", "__slot").orderBy("__day").rangeBetween(W.unboundedPreceding, 0)
    behind = W.partitionBy("__key", "__slot").orderBy(F.desc("__day")).rangeBetween(W.unboundedPreceding, 0)
    sides = F.array_distinct(
        F.array_compact(
            F.array(
                F.last(found, ignorenulls=True).over(ahead), F.last(found, ignorenulls=True).over(behind)
            )
        )
    )
    near = (
        rows.withColumn("__sides", sides)
        .filter("__spot")
        .select("__key", "__day", "__sides")
    )
    pairs = spread_join(keyed, near, ["__key", "__day"])
    return (
        pairs.select(*left.columns, "__day", F.inline("__sides"))
        .withColumn("days_after", F.col("__day") - F.col("__event"))
        .withColumn("days_difference", F.abs("days_after"))
        .filter(F.col("days_difference") <= max_days)
        .select(*left.columns, "__right.*", "days_after", "days_difference")
    )


def nearest_match(
    pairs: DataFrame, id: str, distance: str, tiebreak: list[Column], take: list[str]
) -> DataFrame:
    """The closest pair of each id as one map-side combined aggregate."""
    best = F.min_by(F.struct(*take), F.struct(F.col(distance), *tiebreak))
    return pairs.groupBy(id).agg(best.alias("__best")).select(id, "__best.*")


def nearby_events(
    spots: DataFrame,
    events: DataFrame,
    max_days: int,
    spans: dict[str, tuple[str, int]],
    tops: dict[str, str] | None = None,
) -> DataFrame:
    """For each (key, day) in `spots`, what lies within some days in `events`, without pairs.

    `events` has one row per (key, day) with additive columns, a `near` struct describing the
    day's representative event and an optional `near_same` day number. `spans` maps an output
    name to (additive column, days either side); `tops` an output name to a column whose
    greatest value within `max_days` is wanted. Both inputs hold one row per key and day, so
    a key's window is bounded by the calendar however many rows the key had.
    """
    tops = tops or {}
    added = sorted({c for c, _ in spans.values()})
    seen = spots.select("key", "day").distinct().withColumn("__spot", F.lit(True))
    merged = (
        seen.unionByName(events, allowMissingColumns=True)
        .groupBy("key", "day")
        .agg(
            F.max("__spot").alias("__spot"),
            *[F.sum(c).alias(c) for c in added],
            *[F.max(c).alias(c) for c in [*tops.values(), "near", "same_day"]],
        )
        .withColumn("__hit", F.when(F.col("near").isNotNull(), F.col("day")))
    )
    by_day = W.partitionBy("key").orderBy("day")
    upto_now = by_day.rowsBetween(W.unboundedPreceding, W.currentRow)
    from_now = W.partitionBy("key").orderBy(F.desc("day")).rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    around = by_day.rangeBetween(-max_days, max_days)
    last = lambda c, w: F.last(c, ignorenulls=True).over(w)

    def within(c: str, days: int) -> Column:
        """Sum over the days around, as a difference of two running sums (one step per row)."""
        upto = lambda d: F.sum(c).over(by_day.rangeBetween(W.unboundedPreceding, d))
        return F.coalesce(upto(days), F.lit(0)) - F.coalesce(upto(-days - 1), F.lit(0))

    looked = merged.select(
        "key",
        "day",
        "__spot",
        *[within(c, days).alias(name) for name, (c, days) in spans.items()],
        *[F.max(c).over(around).alias(name) for name, c in tops.items()],
        (F.col("day") - last("__hit", upto_now)).alias("__back"),
        last("near", upto_now).alias("__near_back"),
        (last("__hit", from_now) - F.col("day")).alias("__ahead"),
        last("near", from_now).alias("__near_ahead"),
        F.least(
            F.col("day") - last("same_day", upto_now), last("same_day", from_now) - F.col("day")
        ).alias("__same"),
    )
    closest = F.least("__back", "__ahead")
    near = F.when(F.col("__back") == closest, F.col("__near_back")).otherwise(
        F.col("__near_ahead")
    )
    return looked.filter("__spot").select(
        "key",
        "day",
        *spans,
        *tops,
        F.when(closest <= max_days, closest).alias("closest_days"),
        F.when(closest <= max_days, near).alias("near"),
        F.when(F.col("__same") <= max_days, F.col("__same")).alias("closest_same_days"),
    )


def many_tasks(df: DataFrame) -> int:
    """Tasks for a step that gives out far more rows than it reads: several for each core, and no fewer than
    the session's shuffles have."""
    spark = df.sparkSession
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(asked, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def measured_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    rows_per_piece: int = ROWS_PER_PIECE,
    counted: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Left join in which heavy keys are cut into as many pieces as their rows ask for.

    The left side's rows are counted per key first (combined map-side, the key column alone). A key with
    more than `rows_per_piece` rows is dealt to that many pieces, by a hash of the left columns, and only
    such a key's right rows are repeated. All other keys are joined as they are. `counted` is a table with
    at least as many rows of each key that is counted in place of the left one, such as what that was
    grouped from. With `tasks` the join has that many and run-time plans leave them apart: they see what a
    task reads and not how many pairs it writes.
    """
    n = F.count("*")
    heavy = (
        (left if counted is None else counted)
        .groupBy(F.col(left_key).alias("__heavy"))
        .agg(F.ceil(n / rows_per_piece).cast("int").alias("__pieces"))
        .filter("__pieces > 1")
    )
    # At most one row for every `rows_per_piece` rows of the left side, hence a safe broadcast.
    heavy = F.broadcast(heavy)
    pieces = F.coalesce("__pieces", F.lit(1))
    narrow = [c for c, kind in left.dtypes if kind not in ("string", "binary") and "<" not in kind]
    dealt = (
        left.join(heavy, F.col(left_key).eqNullSafe(F.col("__heavy")), "left")
        .withColumn("__piece", F.pmod(F.xxhash64(*(narrow or left.columns)), pieces).cast("int"))
        .drop("__heavy", "__pieces")
    )
    repeated = (
        right.join(heavy, F.col(right_key) == F.col("__heavy"), "left")
        .withColumn("__copy", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("__heavy", "__pieces")
    )
    if tasks:
        dealt = dealt.repartition(tasks, left_key, "__piece")
        repeated = repeated.repartition(tasks, right_key, "__copy")
    same = (F.col(left_key) == F.col(right_key)) & (F.col("__piece") == F.col("__copy"))
    return dealt.join(repeated, same, "left").drop("__piece", "__copy")


def day_join(
    left: DataFrame,
    right: DataFrame,
    left_date: str,
    right_date: str,
    rows_per_piece: int = ROWS_PER_PIECE,
    counted: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Left join on the calendar day; `right` should be reduced to its distinct day profiles.

    Days of very many rows, and the rows without a day, are spread by their measured size.
    """
    return measured_join(left, right, left_date, right_date, rows_per_piece, counted, tasks)


def _side(df: DataFrame, key: Column, aggs: dict[str, tuple[str, Column]], rows: str) -> DataFrame:
    builders = {
        "count": F.count,
        "sum": F.sum,
        "avg": F.avg,
        "min": F.min,
        "max": F.max,
    }
    return df.groupBy(key.alias("__key")).agg(
        F.count("*").alias(rows), *[builders[kind](c).alias(n) for n, (kind, c) in aggs.items()]
    )


def _scaled(aggs: dict[str, tuple[str, Column]], other_rows: str) -> list[Column]:
    """Each row meets every row of the other side with the same key, or stands once alone."""
    times = F.greatest(F.coalesce(F.col(other_rows), F.lit(1)), F.lit(1))
    out = []
    for name, (kind, _) in aggs.items():
        if kind == "count":
            out.append((F.coalesce(F.col(name), F.lit(0)) * times).alias(name))
        elif kind == "sum":
            out.append((F.col(name) * times).alias(name))
        else:
            out.append(F.col(name))
    return out


def joined_summary(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: Column,
    left_aggs: dict[str, tuple[str, Column]],
    right_aggs: dict[str, tuple[str, Column]],
    how: str,
    key_name: str,
    rows_name: str | None = None,
) -> DataFrame:
    """Group-by over a many-to-many join, with both sides aggregated before they meet."""
    l = _side(left, left_key, left_aggs, "__left_rows")
    r = _side(right, right_key, right_aggs, "__right_rows")
    joined = l.join(r.withColumnRenamed("__key", "__rkey"), F.expr("__key = __rkey"), how)
    one = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(1)), F.lit(1))
    rows = one("__left_rows") * one("__right_rows")
    return joined.select(
        F.coalesce("__key", "__rkey").alias(key_name),
        *([rows.alias(rows_name)] if rows_name else []),
        *_scaled(left_aggs, "__right_rows"),
        *_scaled(right_aggs, "__left_rows"),
    )


def day_summary(
    left: DataFrame,
    right: DataFrame,
    date: str,
    rows_name: str,
    left_aggs: dict[str, tuple[str, Column]],
    right_aggs: dict[str, tuple[str, Column]],
    right_daily: bool = False,
) -> DataFrame:
    """Left day join summed per day. With `right_daily` the right side counts as one row a day,
    so several right rows no longer multiply the left figures."""
    if right_daily:
        right = right.groupBy(date).agg(
            *[
                {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}[k](c)
                .alias(n)
                for n, (k, c) in right_aggs.items()
            ]
        )
        right_aggs = {n: ("max", F.col(n)) for n in right_aggs}
    key = F.col(date)
    return joined_summary(
        left, right, key, key, left_aggs, right_aggs, "left", date, rows_name
    )


def full_outer_summary(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_aggs: dict[str, tuple[str, Column]],
    right_aggs: dict[str, tuple[str, Column]],
    out_key: str | None = None,
) -> DataFrame:
    """Full outer join grouped by the shared key; rows without a key drop out."""
    known = F.col(key).isNotNull()
    return joined_summary(
        left.filter(known),
        right.filter(known),
        F.col(key),
        F.col(key),
        left_aggs,
        right_aggs,
        "full_outer",
        out_key or key,
    )


def with_share_of(
    df: DataFrame, keys: list[str], value: str, partner: str, total: str, partners: str, share: str
) -> DataFrame:
    """Add the group's total, its number of distinct partners and the row's percent share.

    For tables of pairs, in which a group has one row for each partner or few more: a group is one
    window (which may spill), so that what the rows are summed from is read once. Rows without a
    key belong to no group.
    """
    group = W.partitionBy(*keys)
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    place = F.dense_rank().over(group.orderBy(F.col(partner).asc_nulls_last()))
    out = df.withColumn("__partner", F.when(F.col(partner).isNotNull(), place))
    count = F.coalesce(F.max("__partner").over(group), F.lit(0)).cast("long")
    return (
        out.withColumn(total, F.when(known, F.sum(value).over(group)))
        .withColumn(partners, F.when(known, count))
        .withColumn(share, A.pct(F.col(value), F.col(total)))
        .drop("__partner")
    )
