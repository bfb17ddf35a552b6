from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sightline.operators import cleaning as C
from sightline.plans import enrichment as E
from sightline.sources.schemas import SCHEMAS


def table(spark, name, *rows):
    schema = StructType.fromDDL(SCHEMAS[name])
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def labels(df, column, order):
    return [r[0] for r in df.orderBy(order).select(column).collect()]


def weather(spark, **values):
    column, items = next(iter(values.items()))
    rows = [
        {"formatted_date": datetime(2000, 1, 1, 0, 0, i), column: v} for i, v in enumerate(items)
    ]
    return C.clean_weather(table(spark, "weather", *rows))


@pytest.mark.parametrize(
    "column, out, pairs",
    [
        ("temperature_c", "temperature_celsius", [(-101.0, None), (-100.0, -100.0), (60.0, 60.0), (61.0, None), (None, None)]),
        ("humidity", "humidity_percent", [(0.0, 0.0), (0.5, 50.0), (1.0, 100.0), (55.0, 55.0), (101.0, None), (None, None)]),
        ("wind_speed_km", "wind_speed_kmh", [(-1.0, None), (0.0, 0.0), (500.0, 500.0), (501.0, None)]),
        ("wind_bearing_degrees", "wind_bearing", [(-1.0, None), (360.0, 360.0), (361.0, None)]),
        ("visibility_km", "visibility_km_clean", [(-0.1, None), (100.0, 100.0), (100.1, None)]),
        ("loud_cover", "cloud_cover_percent", [(0.0, 0.0), (100.0, 100.0), (101.0, None)]),
        ("pressure_millibars", "pressure_mb", [(799.0, None), (800.0, 800.0), (1200.0, 1200.0), (1201.0, None)]),
        ("visibility_km", "visibility_category", [(10.0, "EXCELLENT"), (9.9, "GOOD"), (5.0, "GOOD"), (4.9, "MODERATE"), (1.5, "MODERATE"), (0.8, "POOR"), (0.79, "VERY_POOR"), (None, "UNKNOWN")]),
        ("wind_speed_km", "wind_category", [(11.9, "CALM"), (12.0, "LIGHT"), (25.0, "MODERATE"), (39.0, "STRONG"), (62.0, "VERY_STRONG"), (None, "UNKNOWN")]),
        ("summary", "weather_category", [("Sunny", "CLEAR"), ("Overcast and rain", "CLOUDY"), ("drizzle", "RAINY"), ("Sleet", "SNOWY"), ("Mist", "FOGGY"), ("Thunder", "STORMY"), ("Windy", "WINDY"), ("Dry", "OTHER"), (None, "OTHER")]),
    ],
)
def test_weather(spark, column, out, pairs):
    df = weather(spark, **{column: [a for a, _ in pairs]})
    assert labels(df, out, "observation_datetime") == [b for _, b in pairs]


def test_weather_without_time_is_dropped(spark):
    raw = table(spark, "weather", {"summary": "Clear"}, {"formatted_date": datetime(2000, 1, 1, 5)})
    assert C.clean_weather(raw).count() == 1
    assert C.thin_weather(raw).first()["event_date"] == datetime(2000, 1, 1)


def crash(spark, column, values):
    rows = [{"cn_ln": str(i), "aboard": 10, column: v} for i, v in enumerate(values)]
    return C.clean_crashes(table(spark, "crashes", *rows))


@pytest.mark.parametrize(
    "column, out, pairs",
    [
        ("fatalities", "casualty_severity", [(0, "NO_FATALITIES"), (1, "LOW_CASUALTIES"), (5, "LOW_CASUALTIES"), (6, "MODERATE_CASUALTIES"), (50, "MODERATE_CASUALTIES"), (51, "HIGH_CASUALTIES"), (200, "HIGH_CASUALTIES"), (201, "MASS_CASUALTY"), (-1, "UNKNOWN"), (None, "UNKNOWN")]),
        ("fatalities", "total_fatalities", [(0, 0), (-1, None)]),
        ("fatalities", "survivors", [(4, 6), (-1, None), (None, None)]),
        ("fatalities", "fatality_rate_percent", [(4, 40.0), (None, None)]),
        ("aboard", "has_casualty_data", [(0, False), (1, True), (None, False)]),
        ("date", "crash_year", [("1/2/1949", 1949), ("", None), ("c: ", None), ("junk", None), (None, None)]),
        ("date", "aviation_era", [("12/31/1949", "EARLY_AVIATION"), ("1/1/1950", "JET_AGE_EARLY"), ("1/1/1970", "JET_AGE_MATURE"), ("1/1/1990", "MODERN_AVIATION"), ("1/1/2010", "CONTEMPORARY"), (None, "UNKNOWN")]),
        ("date", "crash_day_of_week", [("1/7/2001", 0), ("1/8/2001", 1)]),
        ("location", "crash_country", [("City, Land", "Land"), ("A, B, C", "C"), ("City,Land", "UNKNOWN"), (None, "UNKNOWN")]),
        ("type", "aircraft_manufacturer", [("Boeing 747", "BOEING"), ("b-17", "BOEING"), ("A-320", "AIRBUS"), ("MD-80", "DOUGLAS"), ("Cessna", "CESSNA"), ("Piper", "PIPER"), ("Lockheed", "LOCKHEED"), ("fighter", "MILITARY"), ("Tu", "OTHER"), (None, "OTHER")]),
        ("operator", "operator_type", [("US Navy", "MILITARY"), ("private", "PRIVATE"), ("Freight", "CARGO"), ("charter", "CHARTER"), ("Pan Am", "COMMERCIAL"), ("UNKNOWN", "UNKNOWN"), (None, "UNKNOWN")]),
        ("time", "crash_time_raw", [(" 17:18", "17:18"), ("c: ", None), ("", None)]),
    ],
)
def test_crashes(spark, column, out, pairs):
    df = crash(spark, column, [a for a, _ in pairs])
    assert labels(df, out, "construction_number") == [b for _, b in pairs]


def flight(spark, column, values):
    rows = [{"index": i, "airline": "x", column: v} for i, v in enumerate(values)]
    return C.clean_flights(table(spark, "flights", *rows))


@pytest.mark.parametrize(
    "column, out, pairs",
    [
        ("stops", "number_of_stops", [("zero", 0), (" Five ", 5), ("3", 3), ("12", 12), ("-1", 0), ("two_or_more", 0), (None, 0)]),
        ("stops", "stop_category", [("zero", "NONSTOP"), ("one", "ONE_STOP"), ("2", "MULTIPLE_STOPS")]),
        ("departure_time", "departure_hour", [("05:00", 5), ("25:00", 25), ("Morning", None), ("7", None), (None, None)]),
        ("departure_time", "departure_time_of_day", [("05:00", "MORNING"), ("11:59", "MORNING"), ("12:00", "AFTERNOON"), ("18:00", "EVENING"), ("22:10", "NIGHT"), ("00:10", "NIGHT"), ("25:00", "UNKNOWN"), ("Morning", "UNKNOWN"), ("7", "MORNING"), (None, "UNKNOWN")]),
        ("departure_time", "departure_time_parsed", [("5:07", "05:07:00"), ("25:00", None), ("05:07:09", "05:07:09"), (None, None)]),
        ("duration", "flight_duration_hours", [(-1.0, None), (0.0, None), (24.0, 24.0), (25.0, None)]),
        ("duration", "flight_duration_category", [(-1.0, "SHORT_HAUL"), (2.0, "SHORT_HAUL"), (6.0, "MEDIUM_HAUL"), (12.0, "LONG_HAUL"), (12.1, "ULTRA_LONG_HAUL"), (None, "UNKNOWN")]),
        ("days_left", "booking_timing_category", [(-1, "LAST_MINUTE"), (1, "LAST_MINUTE"), (7, "SHORT_NOTICE"), (30, "ADVANCE"), (31, "EARLY_BOOKING"), (None, "UNKNOWN")]),
        ("days_left", "booking_lead_days", [(-1, None), (0, 0)]),
        ("price", "price_category", [(0.0, "BUDGET"), (200.0, "BUDGET"), (500.0, "MODERATE"), (1000.0, "PREMIUM"), (1001.0, "LUXURY"), (None, "UNKNOWN")]),
        ("price", "has_pricing_data", [(0.0, False), (1.0, True), (None, False)]),
        ("class", "travel_class_category", [("Premium Economy", "ECONOMY"), ("coach", "ECONOMY"), ("Business", "BUSINESS"), ("first", "FIRST"), ("premium", "PREMIUM_ECONOMY"), (None, "UNKNOWN")]),
        ("airline", "airline_region", [("Delta", "US_MAJOR"), ("klm", "EUROPEAN"), ("Qatar", "MIDDLE_EAST"), ("Air Canada", "ASIAN"), ("Qantas", "OTHER")]),
    ],
)
def test_flights(spark, column, out, pairs):
    df = flight(spark, column, [a for a, _ in pairs])
    assert labels(df, out, "flight_record_id") == [b for _, b in pairs]


def test_coordinate_lookup_prefers_states(spark):
    raw = table(
        spark,
        "coordinates",
        {"country": "B", "country_code": "b", "latitude": 1.04, "longitude": 2.0},
        {"country": "A", "country_code": "a", "latitude": 1.0, "longitude": 2.0},
        {"country": "Z", "latitude": 9.0, "longitude": 9.0, "usa_state": "Ohio", "usa_state_latitude": 5.0, "usa_state_longitude": 6.0},
        {"country": "Y", "latitude": 5.0, "longitude": 6.0, "usa_state": " "},
    )
    got = {(r.lat_bucket, r.lon_bucket): (r.coord_country, r.coord_usa_state) for r in C.coordinate_lookup(raw).collect()}
    assert got == {(1.0, 2.0): ("A", None), (5.0, 6.0): ("United States of America", "Ohio")}


def sightings(spark, *rows):
    base = {"datetime": "1/2/2000 3:04"}
    return table(spark, "sightings", *[{**base, **r} for r in rows])


def test_sightings_pipeline(spark):
    places = table(spark, "coordinates", {"country": "Land", "latitude": 1.0, "longitude": 2.0})
    raw = sightings(
        spark,
        {"city": "a", "country": "us", "duration_seconds": "60"},
        {"city": "b", "country": " USA ", "duration_seconds": "60.1", "state": "ca"},
        {"city": "c", "country": "England", "duration_seconds": "300"},
        {"city": "d", "country": "", "duration_seconds": "1800", "latitude": "1.01", "longitude": "2.04"},
        {"city": "e", "country": "zz", "duration_seconds": "3600", "shape": " "},
        {"city": "f", "duration_seconds": "3601", "comments": " "},
        {"city": "g", "datetime": "junk"},
        {"city": "h", "datetime": "junk", "date_posted": "1/3/2000", "duration_seconds": "1e3"},
    )
    cleaned = C.clean_sightings(raw, places)
    assert cleaned.count() == 8
    out = C.standardize_sightings(cleaned)
    rows = {r.city_clean: r for r in out.collect()}
    assert "G" not in rows and len(rows) == 7
    assert [rows[c].country_standardized for c in "ABCDEFH"] == [
        "UNITED STATES", "UNITED STATES", "UNITED KINGDOM", "LAND", "ZZ", "UNKNOWN", "UNKNOWN",
    ]
    assert [rows[c].duration_category for c in "ABCDEFH"] == [
        "VERY SHORT (≤1 min)", "SHORT (1-5 min)", "SHORT (1-5 min)", "MEDIUM (5-30 min)",
        "LONG (30min-1hr)", "VERY LONG (>1hr)", "UNKNOWN",
    ]
    assert rows["E"].shape_clean == "UNKNOWN" and rows["F"].comments_clean is None
    assert rows["H"].sighting_datetime == datetime(2000, 1, 3)
    assert sorted(r.sighting_id[-6:] for r in rows.values()) == [f"{i:06d}" for i in range(1, 8)]
    regions = E.location_enriched(out, C.coordinate_lookup(places))
    assert {r.city_clean: (r.region, r.coord_lookup_country) for r in regions.collect()} == {
        "A": ("US Other", None), "B": ("US West", None), "C": ("United Kingdom", None),
        "D": ("Other International", "Land"), "E": ("Other International", None),
        "F": ("Other International", None), "H": ("Other International", None),
    }


def test_city_levels(spark):
    rows = [{"city": f"c{n}", "country": "us"} for n in (4, 5, 20, 50, 100) for _ in range(n)]
    places = table(spark, "coordinates")
    out = E.location_enriched(
        C.standardize_sightings(C.clean_sightings(sightings(spark, *rows), places)),
        C.coordinate_lookup(places),
    )
    got = dict(out.select("city_clean", "city_activity_level").distinct().collect())
    assert got == {
        "C4": "MINIMAL ACTIVITY", "C5": "LOW ACTIVITY", "C20": "MEDIUM ACTIVITY",
        "C50": "HIGH ACTIVITY", "C100": "VERY HIGH ACTIVITY",
    }
    assert out.select("sighting_id").distinct().count() == 179


def test_natural_key_needs_no_shuffle(spark):
    raw = sightings(spark, {"city": "a"}).withColumn("k", F.lit(12))
    cleaned = C.clean_sightings(raw, table(spark, "coordinates"), extra=["k"])
    out = C.standardize_sightings(spark.createDataFrame(cleaned.collect(), cleaned.schema), "k")
    assert out.first().sighting_id.endswith("_000012")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_all_coordinate_matches_fan_out(spark):
    places = table(
        spark,
        "coordinates",
        {"country": "A", "latitude": 1.0, "longitude": 2.0},
        {"country": "B", "latitude": 1.0, "longitude": 2.0, "usa_state": "Ohio"},
    )
    raw = sightings(spark, {"latitude": "1.0", "longitude": "2.0"})
    assert C.clean_sightings(raw, places).count() == 1
    both = C.clean_sightings(raw, places, dedupe_coordinates=False)
    assert sorted(r.country for r in both.collect()) == ["A", "B"]


def test_coordinate_rows_that_look_the_same_meet_sightings_once(spark, same):
    from sightline.sources.schemas import SCHEMAS

    texts = dict(datetime="1/2/2000 3:04", city="a", latitude="1.0", longitude="2.0")
    fields = [f.split()[0] for f in SCHEMAS["sightings"].replace("\n", " ").split(",")]
    sightings = spark.createDataFrame([tuple(texts.get(f, "") for f in fields)], SCHEMAS["sightings"])
    places = spark.createDataFrame([("X", 1.0, 2.0, s) for s in "pppq"],
                                   "country string, latitude double, longitude double, usa_state string")
    found = C.clean_sightings(sightings, places, dedupe_coordinates=False, expand=False)
    assert sorted((r.state, r.coordinate_rows) for r in found.collect()) == [("p", 3), ("q", 1)]
    spelled = C.clean_sightings(sightings, places, dedupe_coordinates=False)
    assert sorted(r.state for r in spelled.collect()) == list("pppq")


def test_all_coordinate_matches_are_written_apart_from_the_cleaning(spark):
    """Fused with the cleaning step the copies would be made by code too long to be compiled."""
    sightings = table(spark, "sightings", *[{"latitude": "10.0", "longitude": "20.0"}] * 400)
    places = table(spark, "coordinates", *[{"latitude": 10.0, "longitude": 20.0, "country": "X"}] * 3)
    found = C.clean_sightings(sightings, places, dedupe_coordinates=False)
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    join = next(i for i, x in enumerate(plan) if "Join" in x)
    cleaning = next(i for i, x in enumerate(plan) if "RLIKE" in x)
    assert any("Exchange RoundRobinPartitioning" in x for x in plan[join:cleaning])
    tasks = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 1200
    assert len(tasks) > 2 * spark.sparkContext.defaultParallelism


def test_hours_of_flights_are_read_from_text_once(spark):
    flights = spark.createDataFrame([], SCHEMAS["flights"])
    label = C.clean_flights(flights).select("departure_time_of_day")
    plan = label._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^A-Za-z]*[0-9]") == 1
    assert "regexp_extract" not in C.clean_flights(flights)._jdf.queryExecution().optimizedPlan().toString()


def test_clock_times(spark):
    times = {
        "7:05": "07:05:00", " 07:05 ": "07:05:00", "7:05:09": "07:05:09", "23:59:59": "23:59:59", "0:00\n": "00:00:00",
        "07:05:09\n": "07:05:09", "24:00": None, "7:5": None, "7:60": None, "7": None, "Morning": None, "": None,
        "7:05:": None, "7:05:9": None, "x7:05": None, None: None,
    }
    df = spark.createDataFrame([(t,) for t in times], "t string")
    got = {r.t: r.clock for r in df.select("t", C.clock_time(F.col("t")).alias("clock")).collect()}
    assert got == times
