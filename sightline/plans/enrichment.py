"""Fact-level jobs built on the cleaned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions import aggregates as A
from sightline.functions import columns as X
from sightline.functions import fixed_values as V
from sightline.operators.joins import (
    bucket_join,
    day_join,
    many_tasks,
    match_keys,
    nearby_events,
    pairs_by_distance,
    with_group_stats,
)
from sightline.operators.ranking import repeat_rows

PLACE = ["country_standardized", "state_clean", "city_clean"]


def region_of(country: Column, state: Column) -> Column:
    return F.when(
        country == "UNITED STATES", X.by_members(state, V.STATE_REGIONS, V.STATE_REGION_ELSE)
    ).otherwise(X.by_members(country, V.COUNTRY_REGIONS, V.COUNTRY_REGION_ELSE))


def location_enriched(sightings: DataFrame, lookup: DataFrame) -> DataFrame:
    """Standardized sightings with their city's activity, a coordinate lookup and a region."""
    stats = with_group_stats(
        sightings,
        PLACE,
        [
            F.count("*").alias("city_sighting_count"),
            F.min("sighting_date").alias("city_first_sighting"),
            F.max("sighting_date").alias("city_last_sighting"),
            F.avg("latitude_clean").alias("city_avg_latitude"),
            F.avg("longitude_clean").alias("city_avg_longitude"),
        ],
        where=F.col("has_valid_datetime"),
    )
    named = lookup.select(
        "lat_bucket",
        "lon_bucket",
        F.col("coord_country").alias("coord_lookup_country"),
        F.col("coord_usa_state").alias("coord_lookup_state"),
    )
    return bucket_join(stats, named, "latitude_clean", "longitude_clean").withColumns(
        {
            "city_activity_level": X.atleast(
                F.col("city_sighting_count"), V.CITY_FLOORS, V.CITY_BELOW
            ),
            "region": region_of(F.col("country_standardized"), F.col("state_clean")),
        }
    )


def media_attention(fatalities: Column) -> Column:
    return X.ladder([(fatalities > n, label) for n, label in V.MEDIA_LABELS], V.MEDIA_NONE)


# The greatest label is wanted as text, so labels are compared by their alphabetical place.
MEDIA_BY_NAME = sorted([*[label for _, label in V.MEDIA_LABELS], V.MEDIA_NONE])


def media_place(fatalities: Column) -> Column:
    steps = [(fatalities > n, MEDIA_BY_NAME.index(label)) for n, label in V.MEDIA_LABELS]
    return X.ladder(steps, MEDIA_BY_NAME.index(V.MEDIA_NONE))


def media_name(place: Column) -> Column:
    names = F.array(*[F.lit(n) for n in MEDIA_BY_NAME])
    return F.when(place.isNotNull(), F.get(names, place)).otherwise(V.MEDIA_NONE)


def aircraft_features(shape: Column, seconds: Column, comments: Column) -> Column:
    looks = F.lit(False)
    for shapes, low, high in V.AIRCRAFT_SHAPES:
        looks = looks | X.flag(F.upper(shape).isin(shapes) & seconds.between(low, high))
    return looks | X.flag(X.contains_any(F.upper(comments), V.AIRCRAFT_WORDS))


def correlation_strength(days: Column, same_country: Column) -> Column:
    """Label of one sighting-crash pair."""
    steps = [(same_country & (days <= limit), label) for limit, label in V.CORRELATION_LABELS]
    return X.ladder(steps, V.CORRELATION_LOWEST)


def pair_labels(
    sightings: DataFrame,
    crashes: DataFrame,
    max_days: int = V.PROXIMITY_DAYS,
    alt_matches: dict[str, str] | None = None,
) -> DataFrame:
    """How many sighting-crash pairs carry each combination of labels, by sighting country.

    The labels depend on the distance in days, on the countries and places being the same and on the
    crash. Both sides are counted by day, and pairs by distance come from running sums: once for all
    pairs of a country, and once for those of the same place, which are taken off the former.
    """
    alt = V.CRASH_COUNTRY_WORDS if alt_matches is None else alt_matches
    dead, country = F.col("total_fatalities"), F.col("crash_country")
    limits = {label: min(limit, max_days) for limit, label in V.CORRELATION_LABELS}
    reaches = {**limits, V.CORRELATION_LOWEST: max_days}
    seen = (
        sightings.filter(F.col("sighting_date").isNotNull())
        .groupBy(
            F.col("country_standardized").alias("ufo_country"),
            F.col("state_clean").alias("place"),
            X.day_number(F.col("sighting_date")).alias("day"),
        )
        .agg(F.count("*").alias("n"))
    )
    fallen = (
        crashes.filter(
            (F.col("crash_year") >= V.PROXIMITY_FIRST_YEAR) & F.col("crash_date").isNotNull()
        )
        .groupBy(
            country,
            F.split_part("crash_location", F.lit(","), F.lit(1)).alias("place"),
            X.day_number(F.col("crash_date")).alias("day"),
            media_attention(dead).alias("media_attention_level"),
        )
        .agg(F.count("*").alias("c"))
        .withColumn("ufo_country", F.explode(match_keys(country, alt)))
        .withColumn("same_country", F.col("ufo_country") == country)
    )

    # Once under the country as a whole (no place), and once under the place of a same country.
    whole = lambda: F.inline(
        F.array(
            F.struct(F.lit(True).alias("whole"), F.lit("").alias("spot")),
            F.struct(F.lit(False).alias("whole"), F.col("place").alias("spot")),
        )
    )
    keys = ["ufo_country", "same_country", "media_attention_level", "whole", "spot"]
    spots = (
        seen.select("*", whole())
        .filter("whole or spot is not null")
        .groupBy("ufo_country", "whole", "spot", "day")
        .agg(F.sum("n").alias("n"))
    )
    events = (
        fallen.select("*", whole())
        .filter("whole or same_country and spot is not null")
        .groupBy(*keys, "day")
        .agg(F.sum("c").alias("c"))
    )
    strength = F.when(F.col("same_country"), F.col("reach")).otherwise(V.CORRELATION_LOWEST)
    found = (
        pairs_by_distance(spots, events, keys, reaches)
        .groupBy(*keys[:4], strength.alias("correlation_strength"))
        .agg(F.sum("pairs").alias("pairs"))
    )
    # Pairs of the same place are among those of the country, and are taken off them.
    elsewhere = F.struct(
        F.lit(False).alias("same_region"),
        F.when(F.col("whole"), F.col("pairs")).otherwise(-F.col("pairs")).alias("n"),
    )
    there = F.struct(
        F.lit(True).alias("same_region"),
        F.when(F.col("whole"), F.lit(0).cast("long")).otherwise(F.col("pairs")).alias("n"),
    )
    labels = [
        "ufo_country", "same_country", "same_region", "correlation_strength", "media_attention_level",
    ]
    return (
        found.select("*", F.inline(F.array(elsewhere, there)))
        .groupBy(*labels)
        .agg(F.sum("n").alias("pairs"))
        .filter("pairs > 0")
    )


def crash_days(crashes: DataFrame, alt_matches: dict[str, str] | None = None) -> DataFrame:
    """Crashes per (matching country, day): counts, loudest media label, representative crash.

    Within a day the representative is the first by place, aircraft type and fatalities.
    """
    alt = V.CRASH_COUNTRY_WORDS if alt_matches is None else alt_matches
    country, dead = F.col("crash_country"), F.col("total_fatalities")
    details = F.struct("crash_date", "crash_location", "aircraft_type", "total_fatalities")
    order = F.struct("crash_location", "aircraft_type", dead.isNull(), dead)
    same = F.col("key") == country
    # Other crashes are listed under no country. A filter would be pushed down to the raw rows, and
    # have every date read from its text once more.
    listed = (F.col("crash_year") >= V.PROXIMITY_FIRST_YEAR) & F.col("crash_date").isNotNull()
    return (
        crashes.select(
            country,
            "crash_date",
            "crash_location",
            "aircraft_type",
            dead,
            F.explode(F.when(listed, match_keys(country, alt))).alias("key"),
        )
        .groupBy("key", X.day_number(F.col("crash_date")).alias("day"))
        .agg(
            F.count("*").alias("crashes"),
            F.count_if(same).alias("same_country"),
            F.max(media_place(dead)).alias("media"),
            F.min_by(details, order).alias("near"),
            F.max(F.when(same, X.day_number(F.col("crash_date")))).alias("same_day"),
        )
    )


def nearby_crashes(
    sightings: DataFrame,
    crashes: DataFrame,
    max_days: int = V.PROXIMITY_DAYS,
    alt_matches: dict[str, str] | None = None,
) -> DataFrame:
    """Per (country, day) with sightings: crash counts by distance and the nearest crash."""
    spots = sightings.select(
        F.col("country_standardized").alias("key"),
        X.day_number(F.col("sighting_date")).alias("day"),
    )
    return nearby_events(
        spots,
        crash_days(crashes, alt_matches),
        max_days,
        spans={
            "crashes_nearby": ("crashes", max_days),
            "crashes_within_week": ("crashes", min(7, max_days)),
            "crashes_within_month": ("crashes", min(30, max_days)),
            "crashes_same_country": ("same_country", max_days),
        },
        tops={"media": "media"},
    )


def proximity_correlation(
    sightings: DataFrame,
    crashes: DataFrame,
    max_days: int = V.PROXIMITY_DAYS,
    alt_matches: dict[str, str] | None = None,
    count_unmatched: bool = True,
) -> DataFrame:
    """One row per sighting with what crashed nearby in time and how likely it is an aircraft.

    Every crash figure depends on the sighting's country and day only, so it is worked out
    once per (country, day) and joined back. A sighting without any crash counts as one
    nearby row unless `count_unmatched` is off.
    """
    near = nearby_crashes(sightings, crashes, max_days, alt_matches).select(
        F.col("key").alias("ufo_country"), F.col("day").alias("__day"), *_figures()
    )
    base = sightings.select(
        "sighting_id",
        "sighting_datetime",
        "sighting_date",
        F.col("city_clean").alias("ufo_city"),
        F.col("state_clean").alias("ufo_state"),
        F.col("country_standardized").alias("ufo_country"),
        F.col("latitude_clean").alias("ufo_latitude"),
        F.col("longitude_clean").alias("ufo_longitude"),
        F.col("shape_clean").alias("ufo_shape"),
        F.col("duration_seconds_clean").alias("ufo_duration"),
        F.col("comments_clean").alias("ufo_comments"),
        X.day_number(F.col("sighting_date")).alias("__day"),
    )
    found = base.join(near, ["ufo_country", "__day"], "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    features = aircraft_features(F.col("ufo_shape"), F.col("ufo_duration"), F.col("ufo_comments"))
    same_days = F.col("closest_same_days")
    high, moderate, low, minimal = V.SUSPICION_LABELS
    suspicion = X.ladder(
        [
            ((F.col("crashes_within_week") > 0) & F.col("has_aircraft_like_features"), high),
            ((F.col("crashes_within_month") > 0) & (F.col("crashes_same_country") > 0), moderate),
            (F.col("closest_crash_days") <= 90, low),
        ],
        minimal,
    )
    return (
        found.select(
            *base.columns[:-1],
            F.greatest(n("crashes_nearby"), F.lit(1 if count_unmatched else 0)).alias(
                "nearby_crashes_count"
            ),
            *[n(c).alias(c) for c in _COUNTS],
            F.col("closest_days").alias("closest_crash_days"),
            F.col("near.crash_date").alias("closest_crash_date"),
            F.col("near.crash_location").alias("closest_crash_location"),
            F.col("near.aircraft_type").alias("closest_aircraft_type"),
            F.col("near.total_fatalities").alias("closest_crash_fatalities"),
            X.ladder([(same_days <= d, s) for d, s in V.CORRELATION_SCORES], 1).alias(
                "max_correlation_score"
            ),
            features.alias("has_aircraft_like_features"),
            media_name(F.col("media")).alias("max_media_attention"),
        )
        .withColumn("false_positive_likelihood", suspicion)
    )


_COUNTS = ["crashes_within_week", "crashes_within_month", "crashes_same_country"]


def _figures() -> list[str]:
    return ["crashes_nearby", *_COUNTS, "media", "closest_days", "near", "closest_same_days"]


def hazard_flags() -> dict[str, Column]:
    """Hazards of a weather row; a missing measure is no hazard."""
    return {
        "adverse_weather": X.flag(F.col("weather_category").isin(V.ADVERSE_WEATHER)),
        "poor_visibility": X.flag(F.col("visibility_category").isin(V.POOR_VISIBILITY)),
        "high_winds": X.flag(F.col("wind_category").isin(V.HIGH_WIND)),
        "heavy_cloud_cover": X.flag(F.col("cloud_cover_percent") > V.HEAVY_COVER_ABOVE),
        "precipitation_present": X.flag(F.col("precipitation_type") != "NONE"),
    }


def risk_score() -> Column:
    score = F.lit(0)
    for name, points in V.HAZARD_POINTS.items():
        score = score + F.when(F.col(name), points).otherwise(0)
    return score


def with_hazards(weather: DataFrame) -> DataFrame:
    scored = weather.withColumns(hazard_flags()).withColumn("weather_risk_score", risk_score())
    return scored.withColumn(
        "weather_severity",
        X.atleast(F.col("weather_risk_score"), V.SEVERITY_FLOORS, V.SEVERITY_BELOW),
    )


def weather_mentioned(summary: Column) -> Column:
    return X.flag(X.contains_any(F.upper(summary), V.WEATHER_CAUSE_WORDS))


def weather_attribution() -> Column:
    severity = F.col("weather_severity")
    return X.ladder(
        [
            (F.col("weather_mentioned_in_summary"), "EXPLICIT_WEATHER_CAUSE"),
            (severity.isin("EXTREME", "SEVERE"), "LIKELY_WEATHER_FACTOR"),
            ((severity == "MODERATE") & F.col("poor_visibility"), "POSSIBLE_WEATHER_FACTOR"),
            (severity.isin("MILD", "GOOD"), "MINIMAL_WEATHER_FACTOR"),
        ],
        "UNKNOWN_WEATHER_IMPACT",
    )


def casualty_correlation() -> Column:
    score, dead = F.col("weather_risk_score"), F.col("total_fatalities")
    return X.ladder(
        [
            ((score >= 6) & (dead > 50), "HIGH_RISK_HIGH_CASUALTIES"),
            ((score >= 4) & (dead > 20), "MODERATE_RISK_MODERATE_CASUALTIES"),
            ((score >= 2) & (dead > 0), "LOW_RISK_SOME_CASUALTIES"),
            ((score < 2) & (dead == 0), "GOOD_WEATHER_NO_CASUALTIES"),
        ],
        "MIXED_CONDITIONS",
    )


def weather_profiles(weather: DataFrame, columns: list[str], rows: str) -> DataFrame:
    """Distinct weather of each day with the number of observations showing it."""
    return (
        with_hazards(weather)
        .groupBy("observation_date", *columns)
        .agg(F.count("*").alias(rows))
    )


CRASH_BLOCK = [
    "crash_date", "crash_year", "crash_month", "crash_location", "crash_country",
    "airline_operator", "aircraft_type", "aircraft_manufacturer", "operator_type",
    "people_aboard", "total_fatalities", "survivors", "fatality_rate_percent",
    "casualty_severity", "aviation_era", "crash_summary",
]
WEATHER_BLOCK = [
    "weather_summary", "weather_category", "weather_severity", "weather_risk_score",
    "visibility_category", "wind_category",
]


def weather_incident_analysis(
    crashes: DataFrame, weather: DataFrame, expand: bool = True
) -> DataFrame:
    """Crashes since 1950 with the weather of their day.

    With `expand` there is one row per crash and observation. Without it, crashes that look
    the same and observations of a day that look the same stay one row each, and
    `weather_rows` says how many pairs a row stands for. That is all the summaries need, and
    it keeps a busy day from multiplying rows by rows. What depends on the crash alone is worked
    out before the join, and pairs are written out where they are found, without a shuffle, in
    several tasks for each core.
    """
    flags = list(V.HAZARD_POINTS)
    profiles = weather_profiles(weather, [*WEATHER_BLOCK, *flags], "weather_rows")
    fallen = crashes.filter(F.col("crash_year") >= V.WEATHER_FIRST_YEAR).select(*CRASH_BLOCK)
    kept = fallen
    if expand:
        kept = kept.withColumn("__crashes", F.lit(1).cast("long"))
    else:
        kept = kept.groupBy(*CRASH_BLOCK).agg(F.count("*").alias("__crashes"))
    kept = kept.withColumn(
        "weather_mentioned_in_summary", weather_mentioned(F.col("crash_summary"))
    )
    matched = day_join(
        kept, profiles, "crash_date", "observation_date", counted=fallen, tasks=many_tasks(kept)
    ).withColumns(
        {
            **{f: X.flag(F.col(f)) for f in flags},
            "weather_risk_score": F.coalesce("weather_risk_score", F.lit(0)),
            "weather_severity": F.coalesce("weather_severity", F.lit(V.SEVERITY_BELOW)),
        }
    )
    out = matched.select(
        *CRASH_BLOCK,
        *WEATHER_BLOCK,
        *flags,
        "weather_mentioned_in_summary",
        weather_attribution().alias("weather_attribution"),
        casualty_correlation().alias("weather_casualty_correlation"),
        F.col("observation_date").isNotNull().alias("has_weather_data"),
        (F.coalesce("weather_rows", F.lit(1)) * F.col("__crashes")).alias("weather_rows"),
    )
    if not expand:
        return out
    return repeat_rows(out, "weather_rows")


FLIGHT_KEYS = [
    "departure_hour", "departure_time_of_day", "departure_city", "arrival_city", "flight_route",
    "airline_name", "airline_region", "stop_category", "flight_duration_category",
]


def flight_volume(flights: DataFrame) -> DataFrame:
    """Flight counts and measures by hour, route, airline and category.

    Airline and route are grouping keys, so their distinct counts per group are at most one
    and need no distinct aggregation.
    """
    duration, price = F.col("flight_duration_hours"), F.col("ticket_price")
    stops = F.col("number_of_stops")
    return (
        flights.filter("has_complete_route")
        .groupBy(*FLIGHT_KEYS)
        .agg(
            F.count("*").alias("total_flights"),
            *[
                f(c).alias(f"{label}_{name}")
                for name, c in (("flight_duration", duration), ("ticket_price", price))
                for label, f in (("avg", F.avg), ("min", F.min), ("max", F.max))
            ],
            F.avg(stops).alias("avg_stops"),
            A.count_where(stops == 0).alias("nonstop_flights"),
            A.count_where(stops >= 1).alias("connecting_flights"),
            A.count_where(F.col("has_valid_duration")).alias("flights_with_duration"),
            A.count_where(F.col("has_pricing_data")).alias("flights_with_pricing"),
            A.count_where(F.col("has_complete_route")).alias("flights_with_complete_route"),
        )
        .withColumns(
            {
                "unique_airlines": F.col("airline_name").isNotNull().cast("long"),
                "unique_routes": F.col("flight_route").isNotNull().cast("long"),
                "nonstop_percentage": A.pct(F.col("nonstop_flights"), F.col("total_flights")),
                "data_completeness_percentage": A.pct(
                    F.col("flights_with_duration"), F.col("total_flights")
                ),
            }
        )
    )
