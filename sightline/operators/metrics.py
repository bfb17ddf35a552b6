"""Metrics: named measures over summary tables, grouped by dimensions and time grains."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.aggregates import count_where
from sightline.operators.profiles import grouped_median, null_safe_join

GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Model:
    """What can be asked of one table; expressions name its columns."""

    time: str
    measures: dict[str, tuple[str, str]]
    entities: dict[str, str] = field(default_factory=dict)
    dimensions: dict[str, str] = field(default_factory=dict)
    times: dict[str, str] = field(default_factory=dict)


def _same(agg: str, names: str) -> dict[str, tuple[str, str]]:
    return {n: (agg, n) for n in names.split()}


# The measures, dimensions and entities of each summary table.
MODELS = {
    "crashes_by_day": Model(
        time="event_date",
        entities={"crash_day": "event_date"},
        dimensions={"weather_summary": "any_weather_summary"},
        measures={
            "crash_events_sum": ("sum", "crash_events"),
            "total_fatalities_sum": ("sum", "total_fatalities"),
            "avg_temperature_celsius": ("average", "avg_temp_c"),
            "events_count": ("count", "event_date"),
        },
    ),
    "dashboard_summary": Model(
        time="earliest_sighting",
        times={"latest_sighting": "latest_sighting"},
        entities={"country": "country", "region": "region"},
        dimensions={c: c for c in ("metric_type", "time_period", "most_common_shape")},
        measures={
            **_same(
                "sum",
                "total_sightings sightings_with_coordinates sightings_with_comments "
                "sightings_last_year sightings_last_5_years sightings_last_10_years",
            ),
            **_same("count_distinct", "unique_countries unique_states unique_cities unique_shapes"),
            **_same("max", "years_of_data max_duration_seconds"),
            **_same(
                "average",
                "avg_duration_seconds pct_with_coordinates pct_with_comments "
                "avg_sightings_per_year",
            ),
            **_same("median", "median_duration_seconds"),
            "count_country": ("count_distinct", "country"),
            "count_region": ("count_distinct", "region"),
        },
    ),
    "debunking_analysis": Model(
        time="event_date",
        entities={"record": "record_id", "aircraft_type": "related_aircraft"},
        dimensions={
            c: c
            for c in "analysis_type location sub_location suspicion_level evidence_strength "
            "explanation".split()
        },
        measures={
            "days_to_incident": ("average", "days_to_incident"),
            "correlation_score": ("max", "correlation_score"),
            "summary_metric": ("sum", "summary_metric"),
            "count_record": ("count", "record_id"),
            "count_aircraft_type": ("count_distinct", "related_aircraft"),
        },
    ),
    "debunking_simple": Model(
        time="sighting_date",
        entities={"sighting": "sighting_id"},
        dimensions={
            c: c
            for c in "ufo_country ufo_state ufo_city ufo_shape false_positive_likelihood "
            "debunking_assessment".split()
        },
        measures={
            **_same("sum", "nearby_crashes_count crashes_within_week crashes_within_month"),
            **_same("min", "closest_crash_days"),
            **_same("max", "max_correlation_score"),
            **_same("sum_boolean", "has_aircraft_like_features"),
            "count_sighting": ("count", "sighting_id"),
        },
    ),
    # Measures that name columns the table does not have are bound to where the figure stands.
    "comprehensive_summary": Model(
        time="date_context",
        entities={"region": "location_context"},
        dimensions={c: c for c in ("data_type", "category", "location_context")},
        measures={
            "metric_value": ("sum", "metric_value"),
            "metric_percentage_avg": ("average", "metric_percentage"),
            "insight_score_avg": (
                "average", "case when data_type = 'key_insights' then metric_value end",
            ),
            "suspicious_ufo_cases_sum": (
                "sum", "case when data_type = 'regional_analysis' then metric_value end",
            ),
            "total_aviation_crashes_sum": (
                "sum", "case when data_type = 'regional_analysis' then metric_percentage end",
            ),
            "avg_weather_risk": ("average", "metric_aux"),
            "region_count": ("count", "location_context"),
        },
    ),
    "comprehensive_simple": Model(
        time="last_updated",
        entities={"analysis_area": "analysis_area"},
        dimensions={
            "analysis_area_label": "analysis_area",
            "metric_name": "metric_name",
            "description": "description",
        },
        measures={
            "simple_metric_value": ("sum", "metric_value"),
            "analysis_area_count": ("count", "analysis_area"),
        },
    ),
}

METRICS = {name: model for model, m in MODELS.items() for name in m.measures}

AGGREGATIONS = {
    "sum": F.sum,
    "average": F.avg,
    "count": F.count,
    "count_distinct": F.count_distinct,
    "min": F.min,
    "max": F.max,
    "sum_boolean": count_where,
}


def _grouping(m: Model, name: str) -> Column:
    return F.expr({**m.dimensions, **m.entities}[name]).alias(name)


def metric(
    table: DataFrame,
    name: str,
    group_by: list[str] | tuple = (),
    grain: str | None = None,
    time: str | None = None,
    spine: DataFrame | None = None,
    where: Column | None = None,
) -> DataFrame:
    """One metric over its table, by dimensions or entities and by `metric_time` at `grain`.

    With a day `spine`, every period of the spine appears and empty ones count as zero.
    """
    m = MODELS[METRICS[name]]
    agg, expression = m.measures[name]
    df = table if where is None else table.filter(where)
    keys = [_grouping(m, g) for g in group_by]
    names = list(group_by)
    if grain is not None:
        if grain not in GRAINS:
            raise ValueError(f"grain must be one of {GRAINS}")
        column = F.to_date(F.col({**m.times, m.time: m.time}[time or m.time]))
        period = column if grain == "day" else F.trunc(column, grain)
        keys.append(period.alias("metric_time"))
        names.append("metric_time")
    measured = df.select(*keys, F.expr(expression).alias("__v"))
    if agg == "median":
        names = names or ["__all"]
        if names == ["__all"]:
            measured = measured.withColumn("__all", F.lit(1))
        groups = measured.select(*names).distinct()
        medians = grouped_median(measured, names, "__v", F.lit(1), name)
        out = null_safe_join(groups, medians, names, "left").drop("__all")
    else:
        out = measured.groupBy(*names).agg(AGGREGATIONS[agg]("__v").alias(name))
    if spine is None:
        return out
    if grain is None:
        raise ValueError("a spine needs a grain")
    day = F.col("date_day")
    periods = spine.select((day if grain == "day" else F.trunc(day, grain)).alias("metric_time"))
    periods = periods.distinct()
    if group_by:
        # Every group has every period; the periods, a calendar, are one array.
        calendar = periods.agg(F.collect_list("metric_time")).scalar()
        groups = out.select(*group_by).distinct()
        periods = groups.select(*group_by, F.explode(calendar).alias("metric_time"))
    return null_safe_join(periods, out, [*group_by, "metric_time"], "left").select(
        *group_by, "metric_time", F.coalesce(F.col(name), F.lit(0)).alias(name)
    )


def model_metrics(table: DataFrame, model: str, group_by: list[str]) -> DataFrame:
    """All measures of a model side by side: one pass, and one more for each median."""
    m = MODELS[model]
    keys = [_grouping(m, g) for g in group_by]
    values = {n: f"__{n}" for n in m.measures}
    rows = table.select(*keys, *[F.expr(m.measures[n][1]).alias(v) for n, v in values.items()])
    plain = {n: agg for n, (agg, _) in m.measures.items() if agg != "median"}
    out = rows.groupBy(*group_by).agg(
        *[AGGREGATIONS[agg](values[n]).alias(n) for n, agg in plain.items()]
    )
    for n in m.measures:
        if n not in plain:
            medians = grouped_median(rows, group_by, values[n], F.lit(1), n)
            out = null_safe_join(out, medians, group_by, "left")
    return out.select(*group_by, *m.measures)


def metrics_by_entity(entity: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Several metrics side by side per shared entity; each is aggregated before the join.

    `tables` maps metric names to their tables.
    """
    out = None
    for name, table in tables.items():
        one = metric(table, name, [entity]).filter(F.col(entity).isNotNull())
        out = one if out is None else out.join(one, entity, "full_outer")
    return out
