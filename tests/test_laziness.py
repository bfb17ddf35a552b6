"""Building a result starts no job; only the global numbering stores a table on the way."""

import pytest

from parity import queries as parity_queries
from parity.oracle import AS_OF
from parity.standins import raw
from sightline.operators import cleaning as C
from sightline.plans import enrichment as E
from sightline.plans import flights as FL
from sightline.plans import incidents as I
from sightline.plans import sightings as S

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    read = {n: raw(spark, SF, n) for n in ("sightings", "coordinates", "crashes", "weather", "flights")}
    cleaned = C.clean_sightings(read["sightings"], read["coordinates"], extra=["sight_key"])
    return {
        **read,
        "cleaned": cleaned,
        "keyed": C.standardize_sightings(cleaned, id_col="sight_key"),
        "clean_crashes": C.clean_crashes(read["crashes"]),
        "clean_weather": C.clean_weather(read["weather"]),
        "clean_flights": C.clean_flights(read["flights"]),
    }


def results(t):
    lookup = C.coordinate_lookup(t["coordinates"])
    facts = E.location_enriched(t["keyed"], lookup)
    linked = E.proximity_correlation(facts, t["clean_crashes"])
    safety = I.weather_safety(t["clean_crashes"], t["clean_weather"])
    profile = FL.traffic_profile(FL.flight_cube(t["clean_flights"]))
    cube = S.sighting_cube(facts)
    return [
        linked,
        safety,
        E.weather_incident_analysis(t["clean_crashes"], t["clean_weather"]),
        S.dashboard_summary(cube, AS_OF),
        S.by_country_time(cube),
        S.top_locations(cube, AS_OF),
        I.suspicious_cases(linked),
        I.debunking_simple(linked),
        I.comprehensive_simple(facts, linked, safety, AS_OF),
        FL.route_volume(E.flight_volume(t["clean_flights"])),
        FL.traffic_patterns(profile),
        FL.traffic_summary(profile),
    ]


def test_no_job_before_a_result_is_asked_for(spark, inputs):
    spark.sparkContext.setJobGroup("only built", "no job expected")
    try:
        built = results(inputs)
        assert all(df.columns for df in built)
        started = spark.sparkContext.statusTracker().getJobIdsForGroup("only built")
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert list(started) == []


@pytest.mark.parametrize("name", ["comprehensive_summary", "comprehensive_simple", "metric_entity_join_models"])
def test_combined_reports_read_each_raw_table_once(spark, monkeypatch, name):
    read = []

    def counted(spark, d, table):
        read.append(table)
        return raw(spark, d, table)

    monkeypatch.setattr(parity_queries, "raw", counted)
    parity_queries.QUERIES[name](spark, SF)
    assert read.count("crashes") == 1
    assert read.count("sightings") == 1


def test_raw_rows_are_dealt_out_before_they_grow_wide(spark, tmp_path):
    events = spark.range(20).selectExpr(
        "id as event_id", "timestamp_ntz '2020-01-01 00:00:00' as ts", "'click' as event_type", "1.5e0 as value"
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    weather = raw(spark, str(tmp_path), "weather")
    plan = weather._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Day of") < plan.index("RepartitionByExpression")
    assert weather.count() == 20
