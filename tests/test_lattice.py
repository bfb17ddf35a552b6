"""Grains from one stored cube, exact distinct counts as bitmaps, and the plans of the summaries."""

import re

import pytest
from pyspark.sql import functions as F

from parity.oracle import AS_OF
from parity.standins import raw
from sightline.operators import cleaning as C
from sightline.operators import distinct as D
from sightline.operators import profiles as P
from sightline.plans import enrichment as E
from sightline.plans import flights as FL
from sightline.plans import sightings as S
from sightline.sources.tables import durable

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(df, name):
    return len(re.findall(rf"^[\s:+*()0-9-]*{name}\b", plan(df), re.M))


@pytest.fixture(scope="module")
def cube(spark):
    cleaned = C.clean_sightings(raw(spark, SF, "sightings"), raw(spark, SF, "coordinates"), extra=["sight_key"])
    keyed = C.standardize_sightings(durable(cleaned), id_col="sight_key")
    facts = E.location_enriched(keyed, C.coordinate_lookup(raw(spark, SF, "coordinates")))
    return durable(S.sighting_cube(facts))


@pytest.fixture(scope="module")
def flights(spark):
    return durable(FL.flight_cube(C.clean_flights(raw(spark, SF, "flights"))))


@pytest.mark.parametrize("build", [S.dashboard_summary, S.top_locations, S.by_country_time])
def test_a_summary_reads_the_cube_alone_and_few_times(cube, build):
    df = build(cube) if build is S.by_country_time else build(cube, AS_OF)
    # A year's rows come from its months, so both grains of that table hold the months' scans.
    most = 12 if build is S.by_country_time else 6
    assert 0 < nodes(df, "FileScan") <= most
    assert nodes(df, "Expand") == 0
    assert nodes(df, "BroadcastNestedLoopJoin") == nodes(df, "CartesianProduct") == 0


def test_the_traffic_report_reads_a_stored_profile(flights):
    profile = FL.traffic_profile(flights)
    assert nodes(profile, "FileScan") <= 4 and nodes(profile, "Expand") == 0
    assert nodes(FL.traffic_patterns(durable(profile)), "FileScan") <= 6


def test_values_are_shuffled_once_for_all_grains(spark):
    table = durable(spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") % 90 / 4).alias("v")))
    tagged = P.at_grains(table, "grain", {"all": {}, "by": {"k": F.col("k")}})
    df = P.grouped_median(tagged, ["g"], "v", F.lit(1), "m")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # Exchanges whose rows come straight from the files, not from an aggregate or a window.
        stages = re.split(r"^[\s:+*()0-9-]*Exchange.*$", plan(df), flags=re.M)[1:]
        raw_values = sum("FileScan" in x and "Aggregate" not in x for x in stages)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert raw_values == 1
    assert nodes(df, "FileScan") == 2


def test_dense_codes(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"),
        F.array((F.col("id") % 1700).cast("string")).alias("value"),
    )
    got = D.dictionary(rows)
    for kind in ("a", "b"):
        codes = sorted(r.code for r in got.filter(F.col("kind") == kind).collect())
        n = rows.filter(F.col("kind") == kind).select("value").distinct().count()
        assert codes == list(range(1, n + 1))
    assert got.select("kind", "value").distinct().count() == got.count()


def test_bitmaps_count_like_count_distinct(spark, same):
    rows = spark.range(120_000).select(
        (F.col("id") % 3).cast("string").alias("k"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 4).cast("string")).alias("j"),
        F.when(F.col("id") % 7 > 0, F.pmod(F.hash("id"), F.lit(50_000)).cast("string")).alias("x"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 13).cast("string")).alias("y"),
    )
    bitmaps = D.member_bitmaps(rows, ["k", "j"], {"x": [F.col("x")], "xy": [F.col("x"), F.col("y")]})
    names = {"xs": F.col("kind") == "x", "pairs": F.col("kind") == "xy"}
    for keys in (["k"], ["j"], ["k", "j"]):
        want = rows.groupBy(*keys).agg(
            F.count_distinct("x").alias("xs"),
            F.count_distinct(F.when(F.col("y").isNotNull() & F.col("x").isNotNull(), F.struct("x", "y"))).alias("pairs"),
        )
        same(D.member_counts(bitmaps, keys, names), want)
    empty = D.member_bitmaps(rows.limit(0), ["k"], {"x": [F.col("x")]})
    assert D.member_counts(empty, ["k"], {"xs": F.col("kind") == "x"}).collect() == []


def test_places_without_a_country_count_within_it_only(spark):
    rows = spark.createDataFrame(
        [(None, "r", "s", "c"), (None, "r", "t", "c"), ("A", "r", "s", "c"), ("A", "q", "s", None)],
        "country string, region string, state string, city string",
    )
    got = D.member_counts(
        S.members(rows, ["country"]), ["country"],
        {k: F.col("kind") == k for k in ("country", "state", "city", "state_name", "city_name")},
    )
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == {None: (0, 0, 0, 2, 1), "A": (1, 1, 1, 1, 1)}


def test_bitmaps_of_small_groups_are_small(spark):
    rows = spark.range(500).select((F.col("id") % 100).cast("string").alias("k"), F.col("id").cast("string").alias("x"))
    bitmaps = D.member_bitmaps(rows, ["k"], {"x": [F.col("x")]})
    assert dict(bitmaps.dtypes)["bitmap"] == "bigint"
    assert nodes(bitmaps, "SortAggregate") == 0
