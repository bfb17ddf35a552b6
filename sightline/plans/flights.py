"""Flight summaries: routes, hours and airlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions import aggregates as A
from sightline.functions import columns as X
from sightline.functions import fixed_values as V
from sightline.operators.joins import with_share_of
from sightline.operators.distinct import member_bitmaps, member_counts
from sightline.operators.profiles import at_grains, union_tagged

DAYTIMES = ["MORNING", "AFTERNOON", "EVENING", "NIGHT"]
HAULS = [label for _, label in V.DURATION_BANDS] + [V.DURATION_ABOVE]
STOPS = {"nonstop": "NONSTOP", "one_stop": "ONE_STOP", "multi_stop": "MULTIPLE_STOPS"}


def route_totals(volumes: DataFrame) -> DataFrame:
    """Roll-up of the hourly volumes to routes."""
    total = F.col("total_flights")
    per = lambda c, value: A.sum_where(F.col(c) == value, total)
    return volumes.groupBy("departure_city", "arrival_city", "flight_route").agg(
        F.sum(total).alias("total_route_flights"),
        F.sum("unique_airlines").alias("airlines_serving_route"),
        *[per("departure_time_of_day", d).alias(f"{d.lower()}_flights") for d in DAYTIMES],
        F.sum("nonstop_flights").alias("total_nonstop_flights"),
        F.sum("connecting_flights").alias("total_connecting_flights"),
        A.weighted_avg(F.col("avg_flight_duration"), total).alias("weighted_avg_duration"),
        A.weighted_avg(F.col("avg_ticket_price"), total).alias("weighted_avg_price"),
        *[per("stop_category", v).alias(f"route_{n}_volume") for n, v in STOPS.items()],
        *[per("flight_duration_category", h).alias(f"{h.lower()}_flights") for h in HAULS],
    )


def route_volume(volumes: DataFrame) -> DataFrame:
    """Routes with the totals of both their cities, shares and categories."""
    total = "total_route_flights"
    routes = with_share_of(
        route_totals(volumes),
        ["departure_city"],
        total,
        "arrival_city",
        "departure_city_total_flights",
        "departure_city_destinations",
        "route_share_of_departure_city",
    )
    routes = with_share_of(
        routes,
        ["arrival_city"],
        total,
        "departure_city",
        "arrival_city_total_flights",
        "arrival_city_origins",
        "route_share_of_arrival_city",
    )
    flown = F.col(total)
    complexity = X.ladder(
        [
            (F.col("route_nonstop_volume") == flown, "NONSTOP_ONLY"),
            (F.col("route_nonstop_volume") > flown * 0.8, "MOSTLY_NONSTOP"),
            (F.col("route_multi_stop_volume") > flown * 0.5, "COMPLEX_ROUTING"),
        ],
        "MIXED_ROUTING",
    )
    return routes.withColumns(
        {
            "route_volume_category": X.atleast(flown, V.ROUTE_FLOORS, V.ROUTE_BELOW),
            **{
                f"{d.lower()}_flight_percentage": A.pct(F.col(f"{d.lower()}_flights"), flown)
                for d in DAYTIMES
            },
            "route_complexity_category": complexity,
        }
    )


def flight_cube(flights: DataFrame) -> DataFrame:
    """Complete flights counted by hour, airline and route, with additive measures.

    The finest level of all traffic summaries; a deployment stores it once.
    """
    duration, stops = F.col("flight_duration_hours"), F.col("number_of_stops")
    return (
        flights.filter("has_complete_route")
        .groupBy(
            "departure_hour",
            "departure_time_of_day",
            "airline_name",
            "airline_region",
            "departure_city",
            "arrival_city",
            "flight_route",
        )
        .agg(
            F.count("*").alias("n"),
            F.sum(duration).alias("duration_sum"),
            F.count(duration).alias("duration_n"),
            F.sum(stops).alias("stops_sum"),
            A.count_where(stops == 0).alias("nonstop"),
            *[
                A.count_where(F.col("flight_duration_category") == h).alias(h.lower())
                for h in HAULS
            ],
        )
    )


def traffic_profile(cube: DataFrame) -> DataFrame:
    """Measures by hour, by airline and overall, as roll-ups of the flight cube.

    The cube is rolled up to hours and airlines once; all grains come from that level, and so do the
    distinct counts of routes, cities and airlines, as merged bitmaps.
    """
    n = F.col("n")
    keys = ["departure_hour", "departure_time_of_day", "airline_name", "airline_region"]
    grains = {
        "hour": {c: F.col(c) for c in keys[:2]},
        "airline": {c: F.col(c) for c in keys[2:]},
        "all": {},
    }
    where = {"hour": F.col("departure_hour").isNotNull()}
    sums = ["n", "duration_sum", "duration_n", "stops_sum", "nonstop", *[h.lower() for h in HAULS]]
    level = cube.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    measures = at_grains(level, "grain", grains, where).groupBy("g").agg(
        F.sum(n).alias("flights"),
        A.ratio(F.sum("duration_sum"), F.sum("duration_n")).alias("avg_duration"),
        A.ratio(F.sum("stops_sum"), F.sum(n)).alias("avg_stops"),
        F.sum("nonstop").alias("nonstop"),
        *[A.sum_where(F.col("departure_time_of_day") == d, n).alias(d.lower()) for d in DAYTIMES],
        *[
            A.sum_where(F.col("airline_region") == r, n).alias(r.lower())
            for r in ("US_MAJOR", "EUROPEAN", "ASIAN")
        ],
        *[F.sum(h.lower()).alias(h.lower()) for h in HAULS],
    )
    names = {
        "airlines": "airline_name",
        "routes": "flight_route",
        "from_cities": "departure_city",
        "to_cities": "arrival_city",
    }
    seen = member_bitmaps(cube, keys, {k: [F.col(c)] for k, c in names.items()})
    counted = member_counts(
        at_grains(seen, "grain", grains, where), ["g"], {k: F.col("kind") == k for k in names}
    )
    return (
        measures.join(counted, "g", "left").fillna(0, list(names)).select("g.*", *[
            c for c in [*measures.columns, *names] if c != "g"
        ])
    )


def _grain(profile: DataFrame, name: str) -> DataFrame:
    return profile.filter(F.col("grain") == name)


def hourly_patterns(profile: DataFrame) -> DataFrame:
    return _grain(profile, "hour").select(
        "departure_hour",
        "departure_time_of_day",
        F.col("flights").alias("flights_in_hour"),
        F.col("airlines").alias("airlines_active_in_hour"),
        F.col("routes").alias("routes_active_in_hour"),
        F.col("avg_duration").alias("avg_duration_in_hour"),
        F.col("nonstop").alias("nonstop_flights_in_hour"),
        *[F.col(r).alias(f"{r}_flights_in_hour") for r in ("us_major", "european", "asian")],
        *[F.col(h.lower()).alias(f"{h.lower()}_in_hour") for h in HAULS],
    )


def airline_patterns(profile: DataFrame) -> DataFrame:
    total = F.col("flights")
    return _grain(profile, "airline").select(
        "airline_name",
        "airline_region",
        total.alias("total_airline_flights"),
        F.col("routes").alias("routes_served"),
        F.col("from_cities").alias("cities_served_from"),
        F.col("to_cities").alias("cities_served_to"),
        F.col("avg_duration").alias("avg_airline_duration"),
        F.col("avg_stops").alias("avg_airline_stops"),
        *[F.col(d.lower()).alias(f"airline_{d.lower()}_flights") for d in DAYTIMES],
        *[F.col(h.lower()).alias(f"airline_{h.lower()}") for h in HAULS],
        A.pct(F.col("nonstop"), total).alias("airline_nonstop_percentage"),
        X.atleast(total, V.AIRLINE_FLOORS, V.AIRLINE_BELOW).alias("airline_size_category"),
    )


def traffic_summary(profile: DataFrame) -> DataFrame:
    total = F.col("flights")
    return _grain(profile, "all").select(
        total.alias("total_flights_in_dataset"),
        F.col("airlines").alias("total_airlines"),
        F.col("routes").alias("total_routes"),
        F.col("from_cities").alias("total_departure_cities"),
        F.col("to_cities").alias("total_arrival_cities"),
        F.col("avg_duration").alias("overall_avg_duration"),
        F.col("avg_stops").alias("overall_avg_stops"),
        *[
            A.pct(F.col(c.lower()), total).alias(f"{c.lower()}_percentage")
            for c in [*DAYTIMES, *HAULS]
        ],
    )


def traffic_patterns(profile: DataFrame) -> DataFrame:
    """Hours and airlines with their share of all flights."""
    total = traffic_summary(profile).select("total_flights_in_dataset").scalar()
    share: Column = A.pct(F.col("flight_count"), total)
    hours = hourly_patterns(profile).select(
        F.col("departure_hour").cast("string").alias("category_name"),
        F.col("departure_time_of_day").alias("subcategory"),
        F.col("flights_in_hour").alias("flight_count"),
        F.col("airlines_active_in_hour").alias("airline_count"),
        F.col("routes_active_in_hour").alias("route_count"),
        F.col("avg_duration_in_hour").alias("avg_duration"),
        F.col("nonstop_flights_in_hour").alias("nonstop_count"),
    )
    airlines = airline_patterns(profile).select(
        F.col("airline_name").alias("category_name"),
        F.col("airline_region").alias("subcategory"),
        F.col("total_airline_flights").alias("flight_count"),
        F.col("routes_served").alias("route_count"),
        F.col("avg_airline_duration").alias("avg_duration"),
        F.col("airline_nonstop_percentage").alias("complexity_indicator"),
    )
    kinds = {
        **{c: "string" for c in ("category_name", "subcategory")},
        **{c: "long" for c in ("flight_count", "airline_count", "route_count")},
        "avg_duration": "double",
        "nonstop_count": "long",
        "complexity_indicator": "double",
    }
    stacked = union_tagged(
        {"HOURLY_PATTERN": hours, "AIRLINE_PATTERN": airlines}, "analysis_type", kinds
    )
    return stacked.withColumn("percentage_of_total_traffic", share)
