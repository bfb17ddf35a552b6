from datetime import date

import pytest
from pyspark.sql import functions as F

from parity.queries import raw
from sightline.operators import cleaning as C
from sightline.operators import profiles as P
from sightline.plans import enrichment as E
from sightline.plans import flights as FL
from sightline.plans import incidents as I
from sightline.plans import sightings as S
from sightline.sources.tables import durable

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def crashes(spark):
    return durable(C.clean_crashes(raw(spark, SF, "crashes")))


@pytest.fixture(scope="module")
def weather(spark):
    return durable(C.clean_weather(raw(spark, SF, "weather")))


@pytest.fixture(scope="module")
def enriched(spark):
    coordinates = raw(spark, SF, "coordinates")
    cleaned = C.clean_sightings(raw(spark, SF, "sightings"), coordinates, extra=["sight_key"])
    facts = C.standardize_sightings(cleaned, "sight_key")
    return durable(E.location_enriched(facts, C.coordinate_lookup(coordinates)))


def test_expanded_incidents_equal_naive_join(crashes, weather, same):
    rows = E.weather_incident_analysis(crashes, weather)
    naive = (
        crashes.filter("crash_year >= 1950")
        .join(E.with_hazards(weather), F.expr("crash_date = observation_date"), "left")
        .select(
            *E.CRASH_BLOCK,
            F.col("weather_summary"),
            F.coalesce("weather_severity", F.lit("GOOD")).alias("weather_severity"),
            F.coalesce("weather_risk_score", F.lit(0)).alias("weather_risk_score"),
            F.col("observation_date").isNotNull().alias("has_weather_data"),
        )
    )
    same(rows.select(*naive.columns), naive)
    compact = E.weather_incident_analysis(crashes, weather, expand=False)
    assert compact.agg(F.sum("weather_rows")).first()[0] == naive.count()


@pytest.mark.parametrize(
    "dead, score, label",
    [
        (51, 6, "HIGH_RISK_HIGH_CASUALTIES"), (50, 6, "MODERATE_RISK_MODERATE_CASUALTIES"),
        (20, 4, "LOW_RISK_SOME_CASUALTIES"), (0, 1, "GOOD_WEATHER_NO_CASUALTIES"),
        (0, 2, "MIXED_CONDITIONS"), (None, 0, "MIXED_CONDITIONS"),
    ],
)
def test_casualty_label(spark, dead, score, label):
    df = spark.createDataFrame(
        [(dead, score)], "total_fatalities int, weather_risk_score int"
    )
    assert df.select(E.casualty_correlation()).first()[0] == label


def test_hazard_points(spark):
    df = spark.createDataFrame(
        [
            ("STORMY", "POOR", "STRONG", 81.0, "RAIN"), ("STORMY", "POOR", "CALM", 80.0, "NONE"),
            ("RAINY", "GOOD", "CALM", 0.0, "NONE"), ("CLEAR", "GOOD", "CALM", None, ""),
            (None, None, None, None, None),
        ],
        "weather_category string, visibility_category string, wind_category string, "
        "cloud_cover_percent double, precipitation_type string",
    )
    got = [(r.weather_risk_score, r.weather_severity) for r in E.with_hazards(df).collect()]
    assert got == [(9, "EXTREME"), (5, "SEVERE"), (2, "MODERATE"), (1, "MILD"), (0, "GOOD")]


def correlation_rows(spark):
    columns = (
        "sighting_id string, sighting_date timestamp_ntz, ufo_country string, ufo_state string, "
        "ufo_shape string, ufo_duration double, nearby_crashes_count long, "
        "crashes_within_week long, crashes_within_month long, closest_crash_days int, "
        "closest_aircraft_type string, closest_crash_fatalities int, max_correlation_score int, "
        "has_aircraft_like_features boolean, false_positive_likelihood string, ufo_city string"
    )
    from datetime import datetime

    day = datetime(2000, 5, 6)
    tail = ("T", 3, 5)
    rows = [
        ("a", day, "X", "s", "DISK", 1.0, 1, 1, 1, 0, *tail, True, "HIGH_SUSPICION", "c"),
        ("b", day, "X", "s", "DISK", 1.0, 1, 1, 1, 2, *tail, False, "MODERATE_SUSPICION", "c"),
        ("c", day, "X", "s", "CONE", 1.0, 1, 0, 1, 9, *tail, True, "MODERATE_SUSPICION", "c"),
        ("d", day, "Y", "s", "CONE", 1.0, 1, 0, 1, 9, "U", 3, 3, False, "MODERATE_SUSPICION", "c"),
        ("e", day, "Y", "s", "CONE", 1.0, 1, 0, 0, 60, "U", 3, 2, False, "LOW_SUSPICION", "c"),
        ("f", day, "Y", "s", "CONE", 1.0, 1, 0, 0, None, None, None, 1, False, "MINIMAL_SUSPICION", "c"),
    ]
    return spark.createDataFrame(rows, columns)


def test_false_positive_reports(spark):
    linked = correlation_rows(spark)
    cases = {r.sighting_id: r for r in I.suspicious_cases(linked).collect()}
    assert {k: r.debunking_evidence_strength for k, r in cases.items()} == {
        "a": "STRONG_EVIDENCE", "b": "MODERATE_EVIDENCE", "c": "MODERATE_EVIDENCE",
        "d": "WEAK_EVIDENCE",
    }
    assert " within 2 days " in cases["b"].potential_explanation
    short = {r.sighting_id: r.debunking_assessment[:4] for r in I.debunking_simple(linked).collect()}
    assert short == {"a": "High", "b": "Mode", "c": "Low ", "d": "Mini", "e": "Mini"}
    ranks = {r.sighting_id: r.debunking_rank for r in I.debunking_rank(linked).collect()}
    assert ranks == {"a": 1, "b": 2, "c": 3, "d": 4}
    types = I.aircraft_type_stats(linked).collect()
    assert [(r.closest_aircraft_type, r.correlated_ufo_sightings) for r in types] == [("T", 3)]
    assert types[0].most_common_ufo_shape == "DISK"
    report = I.debunking_analysis(linked)
    kinds = dict(report.groupBy("analysis_type").count().collect())
    assert kinds == {"case_details": 4, "regional_summary": 2, "aircraft_correlation": 1}


def test_thresholds_of_weather_safety(spark, weather):
    """Aircraft types need 5 rows and countries 10."""
    day = weather.groupBy("observation_date").count().filter("count = 1").first()[0]

    def crash(kind, land, copies):
        return [(day, kind, land)] * copies

    rows = crash("four", "A", 4) + crash("five", "A", 5) + crash("ten", "B", 10)
    made = spark.createDataFrame(rows, "crash_date date, aircraft_type string, crash_country string")
    full = made.withColumns(
        {
            "crash_year": F.year("crash_date"), "crash_month": F.month("crash_date"),
            "aviation_era": F.lit("e"), "aircraft_manufacturer": F.lit("m"),
            "operator_type": F.lit("o"), "total_fatalities": F.lit(2),
            "fatality_rate_percent": F.lit(50.0), "crash_summary": F.lit("fog"),
        }
    )
    out = I.weather_safety(full, weather).filter("analysis_type like '%r%'")
    got = {(r.analysis_type, r.subcategory or r.category): r for r in out.collect()}
    kinds = {k[1] for k in got if k[0] == "aircraft_vulnerability"}
    assert kinds == {"five", "ten"}
    places = [r for k, r in got.items() if k[0] == "geographic_risk"]
    assert [(r.location, r.crash_count, r.fatality_rate) for r in places] == [("B", 10, 50.0)]
    severity = next(r for k, r in got.items() if k[0] == "weather_severity")
    assert (severity.crash_count, severity.weather_attributed, severity.risk_score) == (19, 19, 5000.0)


def test_dashboard_medians_and_distinct_counts(enriched):
    rows = S.dashboard_summary(S.sighting_cube(enriched), "2001-08-01").filter("metric_type = 'by_country'").collect()
    want = enriched.filter("has_valid_datetime").groupBy("country_standardized", "region").agg(
        F.round(F.median("duration_seconds_clean"), 2).alias("m"),
        F.count_distinct("city_clean").alias("c"),
        F.count_distinct("shape_clean").alias("s"),
    )
    want = {(r[0], r[1]): (r.m, r.c, r.s) for r in want.collect()}
    assert len(rows) == len(want)
    for r in rows:
        got = (r.median_duration_seconds, r.unique_cities, r.unique_shapes)
        assert got == want[r.country, r.region]


def test_overall_row_without_sightings(enriched):
    rows = S.dashboard_summary(S.sighting_cube(enriched.limit(0)), "2001-08-01").collect()
    assert [(r.metric_type, r.time_period, r.total_sightings, r.unique_shapes) for r in rows] == [
        ("overall", "all_time", 0, 0)
    ]


def test_no_fact_row_is_multiplied(enriched, spark):
    for table in (S.dashboard_summary(S.sighting_cube(enriched), "2001-08-01"), S.top_locations(S.sighting_cube(enriched), "2001-08-01")):
        plan = table._jdf.queryExecution().optimizedPlan().toString().splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        for i, line in enumerate(plan):
            if line.lstrip(" :+-").startswith(("Expand", "Generate explode")):
                below = [x for x in plan[i + 1 :]]
                inner = []
                for x in below:
                    if depth(x) <= depth(line):
                        break
                    inner.append(x)
                assert any("Aggregate" in x for x in inner), line


def test_recency_moves_with_the_date(enriched):
    cube = S.sighting_cube(enriched)
    def periods(day):
        rows = S.dashboard_summary(cube, day).filter("metric_type = 'recent_trends'")
        return {r.time_period for r in rows.collect()}
    assert periods("2030-01-01") == {"older"}
    assert "last_year" in periods("2001-08-01")


def test_ranks_among_top_cities_equal_full_ranks(enriched, same):
    from pyspark.sql import Window as W

    cube = S.sighting_cube(enriched)
    cities = cube.groupBy("country", "region", "state", "city").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), "country", "region", "state", "city"]
    full = cities.select(
        "country", "state", "city",
        F.row_number().over(W.orderBy(*order)).cast("long").alias("global_rank"),
        F.row_number().over(W.partitionBy("country").orderBy(*order)).alias("country_rank"),
        F.row_number().over(W.partitionBy("country", "state").orderBy(*order)).alias("state_rank"),
    ).filter("global_rank <= 10")
    got = S.top_locations(cube, "2001-08-01", cities=10).filter("location_type = 'city'")
    same(got.select(*full.columns), full)


def test_route_categories(spark):
    def volume(n, nonstop, multi):
        stops = [("NONSTOP", nonstop), ("MULTIPLE_STOPS", multi), ("ONE_STOP", n - nonstop - multi)]
        return [
            (f"c{n}", "x", f"c{n} -> x", s, k, k if s == "NONSTOP" else 0) for s, k in stops if k
        ]

    rows = volume(49, 49, 0) + volume(50, 41, 0) + volume(100, 0, 51) + volume(500, 400, 0) + volume(1000, 0, 0)
    df = spark.createDataFrame(
        rows,
        "departure_city string, arrival_city string, flight_route string, stop_category string, "
        "total_flights long, nonstop_flights long",
    ).withColumns(
        {
            "departure_time_of_day": F.lit("NIGHT"), "flight_duration_category": F.lit("LONG_HAUL"),
            "unique_airlines": F.lit(1), "connecting_flights": F.lit(0),
            "avg_flight_duration": F.lit(2.0), "avg_ticket_price": F.lit(None).cast("double"),
        }
    )
    out = {r.total_route_flights: r for r in FL.route_volume(df).collect()}
    assert {n: r.route_volume_category for n, r in out.items()} == {
        49: "VERY_LOW_VOLUME", 50: "LOW_VOLUME", 100: "MEDIUM_VOLUME", 500: "HIGH_VOLUME",
        1000: "VERY_HIGH_VOLUME",
    }
    assert {n: r.route_complexity_category for n, r in out.items()} == {
        49: "NONSTOP_ONLY", 50: "MOSTLY_NONSTOP", 100: "COMPLEX_ROUTING", 500: "MIXED_ROUTING",
        1000: "MIXED_ROUTING",
    }
    assert out[49].route_share_of_departure_city == 100.0
    assert out[49].weighted_avg_price is None and out[49].night_flight_percentage == 100.0
    assert out[1000].arrival_city_origins == 5


def test_empty_flights_give_no_division_error(spark):
    flights = C.clean_flights(raw(spark, SF, "flights")).filter("1 = 0")
    profile = FL.traffic_profile(FL.flight_cube(flights))
    assert FL.traffic_patterns(profile).collect() == []


def test_days_without_weather_and_without_date(spark):
    from datetime import datetime

    crashes = spark.createDataFrame(
        [(date(2000, 1, 1), 3), (date(2000, 1, 1), None), (date(2000, 1, 2), 1), (None, 4)],
        "event_date date, fatalities int",
    )
    weather = spark.createDataFrame(
        [(datetime(2000, 1, 1), float(h), f"d{h}") for h in range(24)],
        "event_date timestamp_ntz, temperature_c double, daily_summary string",
    )
    got = {r.event_date: tuple(r)[1:] for r in I.crashes_by_day(crashes, weather).collect()}
    assert got == {
        date(2000, 1, 1): (48, 72, 11.5, "d0"),
        date(2000, 1, 2): (1, 1, None, None),
        None: (1, 4, None, None),
    }
    daily = I.crashes_by_day(crashes, weather, weather_daily=True).collect()
    assert {r.event_date: r.crash_events for r in daily} == {
        date(2000, 1, 1): 2, date(2000, 1, 2): 1, None: 1,
    }


def test_incidents_group_crashes_once_and_spell_pairs_out_in_place(crashes, weather):
    text = lambda df: df._jdf.queryExecution().executedPlan().toString().splitlines()
    compact = text(E.weather_incident_analysis(crashes, weather, expand=False))
    assert sum("HashAggregate(keys=[crash_date" in x and "crash_summary" in x for x in compact) == 2
    spelled = text(E.weather_incident_analysis(crashes, weather))
    above = spelled[: next(i for i, x in enumerate(spelled) if "Join" in x)]
    assert not any("Exchange" in x for x in above)


@pytest.mark.parametrize("expand", [True, False])
def test_incidents_are_written_out_by_many_tasks(spark, expand):
    """Run-time plans see few bytes here and would leave one or two tasks for all pairs."""
    day = F.date_add(F.lit("2000-01-01"), (F.col("id") % 200).cast("int"))
    number = ("crash_year", "crash_month", "people_aboard", "total_fatalities", "survivors", "fatality_rate_percent")
    crashes = spark.range(2000).select(
        day.alias("crash_date"),
        *[(F.lit(2000) if c in number else F.col("id").cast("string")).alias(c) for c in E.CRASH_BLOCK[1:]],
    )
    weather = spark.range(2000).select(
        day.alias("observation_date"), F.col("id").cast("string").alias("weather_summary"),
        *[F.lit("x").alias(c) for c in ("weather_category", "visibility_category", "wind_category", "precipitation_type")],
        F.lit(1.0).alias("cloud_cover_percent"),
    )
    rows = E.weather_incident_analysis(crashes, weather, expand=expand)
    tasks = rows.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 20_000
    assert len(tasks) > 2 * spark.sparkContext.defaultParallelism
