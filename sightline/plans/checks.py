"""The checks each model is declared to pass."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from sightline.functions import fixed_values as V
from sightline.operators.quality import Checked, check_report, write_checked

# Fixed values: (kind, column, arguments) per model.
KNOWN = "{} is not null"


def _present(*columns: str) -> list[tuple]:
    return [("not_null", c) for c in columns]


def _bounded(column: str, low, high) -> tuple:
    return ("accepted_range", column, low, high, KNOWN.format(column))


CHECKS = {
    "clean_weather": [
        *_present("observation_datetime", "observation_date", "weather_category"),
        (
            "accepted_values",
            "weather_category",
            ["CLEAR", "CLOUDY", "RAINY", "SNOWY", "FOGGY", "STORMY", "WINDY", "OTHER"],
        ),
        (
            "accepted_values",
            "visibility_category",
            ["EXCELLENT", "GOOD", "MODERATE", "POOR", "VERY_POOR", "UNKNOWN"],
        ),
    ],
    "clean_crashes": [
        *_present("crash_date", "crash_year"),
        ("expression_is_true", "crash_year", ">= 1908"),
        (
            "accepted_values",
            "casualty_severity",
            [
                "NO_FATALITIES", "LOW_CASUALTIES", "MODERATE_CASUALTIES", "HIGH_CASUALTIES",
                "MASS_CASUALTY", "UNKNOWN",
            ],
        ),
        (
            "accepted_values",
            "operator_type",
            ["MILITARY", "PRIVATE", "CARGO", "CHARTER", "COMMERCIAL", "UNKNOWN"],
        ),
    ],
    "clean_flights": [
        ("unique", "flight_record_id"),
        *_present(
            "flight_record_id",
            "airline_name",
            "departure_city",
            "arrival_city",
            "flight_route",
            "has_complete_route",
        ),
        _bounded("departure_hour", 0, 23),
        ("expression_is_true", "number_of_stops", ">= 0"),
        ("accepted_values", "stop_category", ["NONSTOP", "ONE_STOP", "MULTIPLE_STOPS", "UNKNOWN"]),
        _bounded("flight_duration_hours", 0, 24),
        (
            "accepted_values",
            "flight_duration_category",
            ["SHORT_HAUL", "MEDIUM_HAUL", "LONG_HAUL", "ULTRA_LONG_HAUL", "UNKNOWN"],
        ),
        (
            "accepted_values",
            "travel_class_category",
            ["ECONOMY", "BUSINESS", "FIRST", "PREMIUM_ECONOMY", "UNKNOWN"],
        ),
        ("expression_is_true", "booking_lead_days", ">= 0"),
        (
            "accepted_values",
            "booking_timing_category",
            ["LAST_MINUTE", "SHORT_NOTICE", "ADVANCE", "EARLY_BOOKING", "UNKNOWN"],
        ),
        ("expression_is_true", "ticket_price", "> 0"),
        ("accepted_values", "price_category", ["BUDGET", "MODERATE", "PREMIUM", "LUXURY", "UNKNOWN"]),
        (
            "accepted_values",
            "departure_time_of_day",
            ["MORNING", "AFTERNOON", "EVENING", "NIGHT", "UNKNOWN"],
        ),
        ("accepted_values", "airline_region", ["US_MAJOR", "EUROPEAN", "MIDDLE_EAST", "ASIAN", "OTHER"]),
    ],
    "standardize_sightings": [
        ("unique", "sighting_id"),
        *_present(
            "sighting_id",
            "sighting_datetime",
            "sighting_date",
            "country_standardized",
            "has_valid_datetime",
            "has_valid_coordinates",
        ),
        ("accepted_values", "has_valid_datetime", [True, False]),
        ("accepted_values", "has_valid_coordinates", [True, False]),
        _bounded("latitude_clean", -90, 90),
        _bounded("longitude_clean", -180, 180),
    ],
    "location_enriched": [
        ("unique", "sighting_id"),
        *_present("sighting_id", "region", "city_activity_level"),
        (
            "accepted_values",
            "city_activity_level",
            V.CITY_ACTIVITY_LABELS,
        ),
    ],
    "flight_volume": [
        *_present("departure_city", "arrival_city", "flight_route", "total_flights"),
        ("expression_is_true", "total_flights", "> 0"),
        ("accepted_range", "nonstop_percentage", 0, 100),
    ],
    "sightings_with_weather": _present("event_date"),
    "crashes_by_day": _present("event_date"),
    "by_country_time": [
        *_present("country", "region", "time_grain", "total_sightings", "period_date"),
        ("accepted_values", "time_grain", ["monthly", "yearly"]),
        ("expression_is_true", "total_sightings", ">= 0"),
    ],
    "top_locations": [
        *_present("location_type", "country", "total_sightings", "global_rank"),
        ("accepted_values", "location_type", ["country", "state", "city"]),
        ("expression_is_true", "total_sightings", "> 0"),
        ("expression_is_true", "global_rank", "> 0"),
    ],
    "dashboard_summary": [
        *_present("metric_type", "total_sightings", "unique_countries"),
        ("accepted_values", "metric_type", ["overall", "by_country", "recent_trends"]),
        ("expression_is_true", "total_sightings", ">= 0"),
        ("expression_is_true", "unique_countries", ">= 0"),
    ],
    "debunking_analysis": [
        *_present("analysis_type"),
        (
            "accepted_values",
            "analysis_type",
            ["case_details", "regional_summary", "aircraft_correlation"],
        ),
        (
            "accepted_values",
            "suspicion_level",
            V.SUSPICION_LABELS,
        ),
        (
            "accepted_values",
            "evidence_strength",
            V.EVIDENCE_LABELS,
        ),
    ],
    "weather_safety": [
        *_present("analysis_type", "crash_count"),
        (
            "accepted_values",
            "analysis_type",
            [
                "weather_severity", "temporal_trends", "aircraft_vulnerability",
                "geographic_risk",
            ],
        ),
        ("expression_is_true", "crash_count", ">= 0"),
        ("expression_is_true", "risk_score", ">= 0"),
    ],
    "comprehensive_summary": [
        *_present("data_type", "category"),
        (
            "accepted_values",
            "data_type",
            ["summary_metrics", "key_insights", "regional_analysis"],
        ),
    ],
}


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """All declared checks of the given models."""
    return reduce(
        DataFrame.unionByName,
        [check_report(df, model, CHECKS[model]) for model, df in tables.items()],
    )


def store_checked(df: DataFrame, model: str, write: Callable[[DataFrame], DataFrame]) -> Checked:
    """Write a model and count the failures of its declared checks in the same job."""
    return write_checked(df, model, CHECKS[model], write)


def stored_report(models: list[Checked]) -> DataFrame:
    """All declared checks of models that were checked while they were written."""
    return reduce(DataFrame.unionByName, [m.report() for m in models])
