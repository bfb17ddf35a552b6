"""The declared order of the final tables.

The order of rows in files is no contract of Spark. A table that is to be read in order is therefore stored
with its `position`, in files that hold disjoint ranges of it: an ordered read sorts by one long, and the
first rows are found by the files' statistics, without reading the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators.ranking import global_row_number
from sightline.sources.tables import durable, write_table

# The columns each model is ordered by; `-` marks a descending one. Nulls count as
# larger than all values.
ORDERS = {
    "debunking_analysis": "analysis_type -correlation_score days_to_incident",
    "debunking_simple": "-max_correlation_score closest_crash_days",
    "route_volume": "-total_route_flights",
    "traffic_patterns": "analysis_type -flight_count",
    "comprehensive_summary": "data_type category -metric_value",
    "comprehensive_simple": "analysis_area -metric_value",
    "by_country_time": "country time_grain period_date",
    "top_locations": "location_type global_rank",
    "weather_safety": "analysis_type -risk_score -crash_count",
    "dashboard_summary": "metric_type time_period -total_sightings",
}


def declared_order(model: str) -> list[Column]:
    return [
        F.col(c[1:]).desc_nulls_first() if c.startswith("-") else F.col(c).asc_nulls_last()
        for c in ORDERS[model].split()
    ]


def ordered(model: str, df: DataFrame) -> DataFrame:
    """The rows with their `position`, 1, 2, ... in the declared order; all columns break ties."""
    return global_row_number(durable(df), declared_order(model), "position", stored=True)


def store_ordered(model: str, df: DataFrame, root: str, layer: str) -> DataFrame:
    """Write a model in its declared order, as `first_rows` and readers in order want it."""
    return write_table(ordered(model, df), root, layer, model)


def first_rows(stored: DataFrame, n: int) -> DataFrame:
    """The first `n` rows of a table stored in order; a filter on the files, not a sort of the table."""
    return stored.filter(F.col("position") <= n).orderBy("position")
