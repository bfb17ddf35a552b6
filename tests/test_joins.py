from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sightline.functions import fixed_values as V
from sightline.operators import cleaning as C
from sightline.operators import joins as J
from sightline.operators.ranking import first_per_group
from sightline.plans import enrichment as E
from sightline.sources.schemas import SCHEMAS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def left(spark):
    return spark.range(300).select(
        F.col("id"),
        F.element_at(
            F.array(*[F.lit(c) for c in ("UNITED STATES", "CANADA", "X", "UNKNOWN")]),
            (F.col("id") % 4 + 1).cast("int"),
        ).alias("country"),
        F.when(
            F.col("id") % 29 > 0, F.date_add(F.lit("2000-01-01"), (F.col("id") * 5 % 1500).cast("int"))
        ).cast("timestamp_ntz").alias("seen"),
    )


@pytest.fixture
def right(spark):
    return spark.range(400).select(
        F.col("id").alias("rid"),
        F.element_at(
            F.array(*[F.lit(c) for c in ("Reno USA", "CANADA", "UNITED STATES", "X", "W CANADA USA", "Y")]),
            (F.col("id") % 6 + 1).cast("int"),
        ).alias("land"),
        F.when(
            F.col("id") % 31 > 0, F.date_add(F.lit("1999-06-01"), (F.col("id") * 7 % 1700).cast("int"))
        ).alias("fell"),
    )


def naive_pairs(left, right, days, how="left"):
    alike = (
        (F.col("country") == F.col("land"))
        | ((F.col("country") == "UNITED STATES") & F.col("land").contains("USA"))
        | ((F.col("country") == "CANADA") & F.col("land").contains("CANADA"))
    )
    after = F.datediff(F.to_date("seen"), "fell")
    near = F.abs(after) <= days
    return (
        left.join(right, near & alike & F.col("fell").isNotNull(), how)
        .withColumn("days_after", after)
        .withColumn("days_difference", F.abs(after))
    )


@pytest.mark.parametrize("days", [0, 1, 7, 365])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_proximity_join_equals_naive(left, right, same, days, how):
    got = J.proximity_join(
        left, right, "seen", "fell", days, ("country", "land"), V.CRASH_COUNTRY_WORDS, how=how
    )
    same(got, naive_pairs(left, right, days, how))
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_nearest_match(left, right, same):
    pairs = naive_pairs(left, right, 30, "inner")
    got = J.nearest_match(pairs, "id", "days_difference", [F.col("rid")], ["rid", "days_difference"])
    want = pairs.groupBy("id").agg(F.min(F.struct("days_difference", "rid")).alias("b"))
    same(got, want.select("id", "b.rid", "b.days_difference"))


def facts(spark, left, right):
    sightings = left.filter("seen is not null").select(
        F.col("id").cast("string").alias("sighting_id"),
        F.col("seen").alias("sighting_datetime"),
        F.col("seen").alias("sighting_date"),
        F.lit("c").alias("city_clean"),
        F.lit("s").alias("state_clean"),
        F.col("country").alias("country_standardized"),
        F.lit(1.0).alias("latitude_clean"),
        F.lit(1.0).alias("longitude_clean"),
        F.when(F.col("id") % 3 == 0, "DISK").otherwise("OTHER").alias("shape_clean"),
        (F.col("id") % 400).cast("double").alias("duration_seconds_clean"),
        F.when(F.col("id") % 10 == 0, "a plane").alias("comments_clean"),
    )
    crashes = right.select(
        F.col("fell").alias("crash_date"),
        F.year("fell").alias("crash_year"),
        F.concat(F.lit("p"), F.col("rid") % 9).alias("crash_location"),
        F.col("land").alias("crash_country"),
        F.concat(F.lit("t"), F.col("rid") % 5).alias("aircraft_type"),
        F.when(F.col("rid") % 4 > 0, (F.col("rid") % 150).cast("int")).alias("total_fatalities"),
    )
    return sightings, crashes


@pytest.mark.parametrize("days", [7, 90, 365])
def test_correlation_equals_brute_force(spark, left, right, days):
    sightings, crashes = facts(spark, left, right)
    crashes = crashes.unionByName(  # too early to count, though right on a sighting's day
        crashes.limit(1).withColumns(
            {"crash_date": F.lit(date(1946, 1, 1)), "crash_year": F.lit(1946)}
        )
    )
    got = {r.sighting_id: r for r in E.proximity_correlation(sightings, crashes, days).collect()}
    seen, fallen = sightings.collect(), crashes.collect()
    assert len(got) == len(seen)
    for s in seen:
        hits = []
        for c in fallen:
            if c.crash_date is None or c.crash_year < 1947:
                continue
            gap = abs((s.sighting_date.date() - c.crash_date).days)
            word = V.CRASH_COUNTRY_WORDS.get(s.country_standardized)
            if gap <= days and (
                c.crash_country == s.country_standardized or (word and word in c.crash_country)
            ):
                hits.append((gap, c))
        r = got[s.sighting_id]
        same = [g for g, c in hits if c.crash_country == s.country_standardized]
        assert r.nearby_crashes_count == max(1, len(hits))
        assert r.crashes_within_week == sum(g <= 7 for g, _ in hits)
        assert r.crashes_within_month == sum(g <= 30 for g, _ in hits)
        assert r.crashes_same_country == len(same)
        score = 1
        for limit, points in reversed(V.CORRELATION_SCORES):
            score = points if same and min(same) <= limit else score
        assert r.max_correlation_score == score
        loud = [
            next((x for n, x in V.MEDIA_LABELS if (c.total_fatalities or 0) > n), V.MEDIA_NONE)
            for _, c in hits
        ]
        assert r.max_media_attention == max(loud, default=V.MEDIA_NONE)
        if not hits:
            assert r.closest_crash_days is None and r.closest_crash_date is None
            continue
        gap, best = min(
            hits,
            key=lambda h: (
                h[0], h[1].crash_date, h[1].crash_location, h[1].aircraft_type,
                h[1].total_fatalities is None, h[1].total_fatalities or 0,
            ),
        )
        assert r.closest_crash_days == gap
        assert (
            r.closest_crash_date, r.closest_crash_location, r.closest_aircraft_type,
            r.closest_crash_fatalities,
        ) == (best.crash_date, best.crash_location, best.aircraft_type, best.total_fatalities)


def test_correlation_never_pairs_rows(spark, left, right):
    sightings, crashes = facts(spark, left, right)
    text = plan(E.proximity_correlation(sightings, crashes))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_pair_labels(spark):
    df = spark.createDataFrame([(d,) for d in (0, 1, 2, 7, 8, 30, 31, 90, 91)], "d int")
    strength = lambda ok: [
        r[0] for r in df.orderBy("d").select(E.correlation_strength(F.col("d"), F.lit(ok))).collect()
    ]
    assert strength(True) == [
        "VERY_HIGH", "VERY_HIGH", "HIGH", "HIGH", "MODERATE", "MODERATE", "LOW", "LOW", "VERY_LOW",
    ]
    assert set(strength(False)) == {"VERY_LOW"}
    dead = spark.createDataFrame([(0,), (1,), (20,), (21,), (100,), (101,), (None,)], "n int")
    got = [r[0] for r in dead.select(E.media_attention(F.col("n"))).collect()]
    assert got == [
        "MINIMAL_MEDIA", "LOW_MEDIA", "LOW_MEDIA", "MODERATE_MEDIA", "MODERATE_MEDIA",
        "HIGH_MEDIA", "MINIMAL_MEDIA",
    ]


@pytest.fixture
def two_sides(spark):
    a = spark.createDataFrame(
        [("p", 1), ("p", 2), ("q", 5), (None, 9), ("r", None)], "k string, x int"
    )
    b = spark.createDataFrame(
        [("p", 1.0), ("p", None), ("p", 3.0), ("q", 7.0), ("z", 4.0), (None, 8.0)],
        "k string, y double",
    )
    return a, b


def test_full_outer_summary_equals_naive(two_sides, same):
    a, b = two_sides
    got = J.full_outer_summary(
        a, b, "k", {"n": ("count", F.col("x")), "sx": ("sum", F.col("x")), "ax": ("avg", F.col("x"))},
        {"m": ("count", F.col("y")), "sy": ("sum", F.col("y")), "my": ("max", F.col("y"))},
    )
    naive = (
        a.join(b.withColumnRenamed("k", "j"), F.expr("k = j"), "full_outer")
        .withColumn("k", F.coalesce("k", "j")).filter("k is not null").groupBy("k")
        .agg(F.count("x").alias("n"), F.sum("x").alias("sx"), F.avg("x").alias("ax"),
             F.count("y").alias("m"), F.sum("y").alias("sy"), F.max("y").alias("my"))
    )
    same(got, naive)


def test_day_summary_equals_naive(two_sides, same):
    a, b = two_sides
    got = J.day_summary(a, b, "k", "n", {"s": ("sum", F.col("x"))}, {"v": ("avg", F.col("y"))})
    naive = (
        a.join(b.withColumnRenamed("k", "j"), F.expr("k = j"), "left").groupBy("k")
        .agg(F.count("*").alias("n"), F.sum("x").alias("s"), F.avg("y").alias("v"))
    )
    same(got, naive)
    daily = J.day_summary(
        a, b, "k", "n", {"s": ("sum", F.col("x"))}, {"v": ("avg", F.col("y"))}, right_daily=True
    )
    assert {r.k: (r.n, r.s, r.v) for r in daily.collect()} == {
        "p": (2, 3, 2.0), "q": (1, 5, 7.0), None: (1, 9, None), "r": (1, None, None),
    }


def test_shares(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 5)], "f string, t string, n int")
    out = J.with_share_of(df, ["f"], "n", "t", "total", "partners", "share")
    assert sorted(tuple(r) for r in out.select("f", "t", "total", "partners", "share").collect()) == [
        ("a", "x", 4, 2, 25.0), ("a", "y", 4, 2, 75.0), ("b", "x", 5, 1, 100.0),
    ]


def test_shares_read_their_table_once(spark):
    rows = [("a", "x", 1), ("a", "x", 3), ("a", None, 4), (None, "x", 5), (None, "y", 7), ("b", None, 0)]
    df = spark.createDataFrame(rows, "f string, t string, n int").repartition(3)
    out = J.with_share_of(df, ["f"], "n", "t", "total", "partners", "share")
    # Rows without a key have no group, and no partner is none; duplicates count once.
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(
        [
            ("a", "x", 1, 8, 1, 12.5), ("a", "x", 3, 8, 1, 37.5), ("a", None, 4, 8, 1, 50.0),
            (None, "x", 5, None, None, None), (None, "y", 7, None, None, None), ("b", None, 0, 0, 0, None),
        ],
        key=str,
    )
    assert dict(out.dtypes)["partners"] == "bigint"
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_crash_dates_are_read_from_text_once(spark):
    schema = StructType.fromDDL(SCHEMAS["crashes"])
    raw = spark.createDataFrame([tuple(None for _ in schema)], schema)
    days = E.crash_days(C.clean_crashes(raw.repartition(2)))
    # No filter by the date, which would be pushed below the point where it is read.
    assert days._jdf.queryExecution().optimizedPlan().toString().count("d-MMM-yyyy") == 1


def test_crashes_out_of_range_are_listed_nowhere(spark):
    rows = [(date(1946, 12, 31), 1946), (date(1947, 1, 1), 1947), (None, None), (date(1990, 5, 5), None)]
    df = spark.createDataFrame(rows, "crash_date date, crash_year int").withColumns(
        {
            "crash_country": F.lit("Reno USA"), "crash_location": F.lit("a"),
            "aircraft_type": F.lit("b"), "total_fatalities": F.lit(3),
        }
    )
    found = E.crash_days(df).select("key", "near.crash_date", "crashes").collect()
    assert sorted(tuple(r) for r in found) == [
        ("Reno USA", date(1947, 1, 1), 1), ("UNITED STATES", date(1947, 1, 1), 1),
    ]


@pytest.fixture
def small_skew(spark):
    """Limits low enough for a test table to count as skewed, and no broadcasts."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark):
    """Half of the rows are one city, of which half are copies of one row; a tenth have no key."""
    n = F.col("id")
    return spark.range(0, 60000, 1, 8).select(
        F.when(n % 10 == 0, None).when(n % 2 == 1, 1.0).otherwise(n % 900 / 8 + 2.5).alias("lat"),
        F.when(n % 10 == 0, None).when(n % 2 == 1, 1.0).otherwise(n % 900 / 8 + 2.5).alias("lon"),
        F.when(n % 4 == 1, "copy").otherwise(F.sha2(n.cast("string"), 256)).alias("text"),
    )


def test_hot_groups_are_split_at_run_time(spark, small_skew):
    out = J.with_group_stats(hot_rows(spark), ["lat"], [F.count("*").alias("n")])
    agg = out.agg(F.max("n"), F.count("text"))
    assert agg.collect() == [(30000, 60000)]
    assert "skew=true" in plan(agg)


def test_hot_buckets_are_split_at_run_time(spark, small_skew):
    lookup = first_per_group(
        hot_rows(spark).select(
            J.X.bucket(F.col("lat")).alias("lat_bucket"),
            J.X.bucket(F.col("lon")).alias("lon_bucket"),
            F.lit("v").alias("v"),
        ),
        ["lat_bucket", "lon_bucket"],
        [F.asc("v")],
    )
    agg = J.bucket_join(hot_rows(spark), lookup, "lat", "lon").agg(F.count("v"), F.count("text"))
    assert agg.collect() == [(54000, 60000)]
    assert "skew=true" in plan(agg)


def test_hot_days_are_split_at_run_time(spark, small_skew, left, right):
    sightings, crashes = facts(spark, left, right)
    many = spark.range(0, 60000, 1, 8).select(
        F.col("id").cast("string").alias("sighting_id"), F.sha2(F.col("id").cast("string"), 256).alias("comments_clean")
    )
    one = sightings.limit(1).drop("sighting_id", "comments_clean")
    hot = many.withColumns({c: F.lit(one.first()[c]).cast(t) for c, t in one.dtypes})
    rows = sightings.unionByName(hot)
    agg = E.proximity_correlation(rows, crashes).agg(F.count("*"), F.max("closest_crash_days"), F.max("ufo_comments"))
    assert agg.collect()[0][0] == rows.count()
    assert "skew=true" in plan(agg)


def test_bucket_join(spark):
    left = spark.createDataFrame([(1.04, 2.0), (None, 2.0), (9.0, 9.0)], "lat double, lon double")
    lookup = spark.createDataFrame(
        [(1.0, 2.0, "a"), (None, 2.0, "b")], "lat_bucket double, lon_bucket double, v string"
    )
    out = J.bucket_join(left, lookup, "lat", "lon")
    assert {r.lat: r.v for r in out.collect()} == {1.04: "a", None: None, 9.0: None}


def test_day_counts(spark):
    df = spark.createDataFrame([("a", datetime(2000, 1, 1, h)) for h in (1, 2)], "k string, t timestamp_ntz")
    assert J.day_counts(df, "k", "t", "n").collect() == [("a", date(2000, 1, 1), 2)]


@pytest.mark.parametrize("days", [0, 3, 30])
def test_asof_pairs_hold_the_nearest(left, right, same, days):
    pairs = J.asof_pairs(left, right, "seen", "fell", days, ("country", "land"), [F.col("rid")], V.CRASH_COUNTRY_WORDS)
    naive = naive_pairs(left, right, days, "inner")
    best = lambda df: df.groupBy("id").agg(
        F.min(F.struct("days_difference", "fell", "rid")).alias("b")
    ).select("id", "b.*")
    same(best(pairs), best(naive))
    assert pairs.groupBy("id").count().filter("count > 2").isEmpty()
    assert pairs.join(naive, ["id", "rid"], "left_anti").isEmpty()


@pytest.mark.parametrize("rows_per_piece", [1, 40, 10**6])
def test_measured_join_is_a_left_join(left, right, same, rows_per_piece):
    seen = left.withColumn("day", F.to_date("seen"))
    days = right.filter("rid % 3 = 0").select(F.col("fell").alias("fallen"), "rid")
    got = J.measured_join(seen, days, "day", "fallen", rows_per_piece)
    same(got, seen.join(days, F.col("day") == F.col("fallen"), "left"))


def test_a_day_with_half_of_the_rows_is_spread(spark):
    days = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 400).cast("int")
    left = spark.range(40_000).select("id", F.date_add(F.lit("2000-01-01"), days).alias("day"))
    right = spark.range(400).select(
        F.date_add(F.lit("2000-01-01"), F.col("id").cast("int")).alias("on"), F.col("id").alias("w")
    )
    for key, value in {"adaptive.enabled": "false", "autoBroadcastJoinThreshold": "-1", "shuffle.partitions": "16"}.items():
        spark.conf.set(f"spark.sql.{key}", value)
    try:
        sizes = lambda df: sorted(
            r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()
        )
        plain = sizes(left.join(right, F.col("day") == F.col("on"), "left"))
        assert plain[-1] > 10 * plain[len(plain) // 2]
        spread = sizes(J.day_join(left, right, "day", "on", rows_per_piece=200))
        assert len(spread) == 16 and sum(spread) == 40_000
        assert spread[-1] <= 3 * spread[8]
    finally:
        for key, value in {"adaptive.enabled": "true", "shuffle.partitions": "4"}.items():
            spark.conf.set(f"spark.sql.{key}", value)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_by_distance_never_pairs_days(spark, same):
    spots = spark.createDataFrame([("a", d, 2) for d in (0, 5, 40)] + [("b", 5, 1)], "k string, day int, n long")
    events = spark.createDataFrame(
        [("a", m, d, c) for m, d, c in (("x", 1, 3), ("x", 30, 1), ("y", 5, 4))], "k string, m string, day int, c long"
    )
    reaches = {"near": 1, "far": 30}
    got = J.pairs_by_distance(spots, events, ["k", "m"], reaches)
    gap = F.abs(F.col("s.day") - F.col("e.day"))
    naive = (
        spots.alias("s").join(events.alias("e"), F.col("s.k") == F.col("e.k"))
        .filter(gap <= 30)
        .groupBy("e.k", "m", F.when(gap <= 1, "near").otherwise("far").alias("reach"))
        .agg(F.sum(F.col("n") * F.col("c")).alias("pairs"))
    )
    same(got, naive)
