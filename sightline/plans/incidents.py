"""Crash, weather and false-positive summaries, and the reports that combine them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions import aggregates as A
from sightline.functions import columns as X
from sightline.functions import fixed_values as V
from sightline.operators.joins import day_summary, full_outer_summary
from sightline.operators.profiles import at_grains, grouped_mode, kpi_rows, union_tagged
from sightline.operators.ranking import global_row_number, top_k
from sightline.plans.enrichment import weather_attribution, weather_mentioned, weather_profiles

SUSPICIOUS = V.SUSPICION_LABELS[:2]


def crashes_by_day(
    crashes: DataFrame, weather: DataFrame, weather_daily: bool = False
) -> DataFrame:
    """Thin crashes per day with that day's weather. Crashes count once per weather row of
    their day, unless `weather_daily` reduces the weather to one row a day first."""
    days = day_summary(
        crashes.withColumn("event_date", F.col("event_date").cast("timestamp_ntz")),
        weather,
        "event_date",
        "crash_events",
        {"total_fatalities": ("sum", F.coalesce("fatalities", F.lit(0)))},
        {
            "avg_temp_c": ("avg", F.col("temperature_c")),
            "any_weather_summary": ("min", F.col("daily_summary")),
        },
        weather_daily,
    )
    return days.filter("crash_events > 0").withColumn("event_date", F.to_date("event_date"))


def sightings_with_weather(
    sightings: DataFrame, weather: DataFrame, weather_daily: bool = False
) -> DataFrame:
    """Cleaned sightings per day with that day's weather."""
    return day_summary(
        sightings,
        weather,
        "event_date",
        "ufo_sightings",
        {"avg_duration_seconds": ("avg", F.col("duration_seconds"))},
        {
            "avg_temp_c": ("avg", F.col("temperature_c")),
            "avg_humidity": ("avg", F.col("humidity")),
            "avg_wind_speed_km": ("avg", F.col("wind_speed_km")),
            "any_weather_summary": ("min", F.col("daily_summary")),
        },
        weather_daily,
    ).filter("ufo_sightings > 0")


def _evidence(strong, week, month, otherwise, weak=None) -> Column:
    near, soon = F.col("crashes_within_week") > 0, F.col("crashes_within_month") > 0
    alike = F.col("has_aircraft_like_features")
    steps = [(near & alike, strong), (near, week), (soon & alike, month)]
    if weak is not None:
        steps.append((soon, weak))
    return X.ladder(steps, otherwise)


def suspicious_cases(correlation: DataFrame) -> DataFrame:
    """Likely false positives with the strength of the evidence and a sentence about it."""
    strong, moderate, weak, none = V.EVIDENCE_LABELS
    told = lambda text: F.concat(F.lit(text[0]), F.col("closest_crash_days"), F.lit(text[1]))
    return correlation.filter(F.col("false_positive_likelihood").isin(SUSPICIOUS)).withColumns(
        {
            "debunking_evidence_strength": _evidence(strong, moderate, moderate, none, weak),
            "potential_explanation": _evidence(
                told(V.CASE_STRONG), told(V.CASE_WEEK), told(V.CASE_MONTH), V.CASE_ELSE
            ),
        }
    )


def debunking_rank(correlation: DataFrame) -> DataFrame:
    """Suspicious cases from the most to the least convincing."""
    cases = suspicious_cases(correlation).select(
        "sighting_id",
        "false_positive_likelihood",
        "max_correlation_score",
        "closest_crash_days",
        "debunking_evidence_strength",
    )
    order = [
        F.desc("max_correlation_score"),
        F.col("closest_crash_days").asc_nulls_last(),
        F.asc("sighting_id"),
    ]
    return global_row_number(cases, order, "debunking_rank", unique=True)


def regional_stats(correlation: DataFrame) -> DataFrame:
    likely = F.col("false_positive_likelihood")
    n = F.count("*")
    return correlation.groupBy(
        "ufo_country",
        "ufo_state",
        X.period_start(F.col("sighting_date"), "year").alias("sighting_year"),
        X.period_start(F.col("sighting_date"), "month").alias("sighting_month"),
    ).agg(
        n.alias("total_suspicious_sightings"),
        A.count_where(likely == SUSPICIOUS[0]).alias("high_suspicion_count"),
        A.count_where(likely == SUSPICIOUS[1]).alias("moderate_suspicion_count"),
        F.lit(0).alias("strong_evidence_count"),
        A.count_where(F.col("has_aircraft_like_features")).alias("aircraft_like_features_count"),
        F.avg("closest_crash_days").alias("avg_days_to_crash"),
        F.avg("nearby_crashes_count").alias("avg_nearby_crashes"),
        F.sum("crashes_within_week").alias("total_crashes_within_week"),
        F.sum("crashes_within_month").alias("total_crashes_within_month"),
        A.pct(A.count_where(likely.isin(SUSPICIOUS)), n).alias("potential_false_positive_rate"),
    )


def aircraft_type_stats(correlation: DataFrame, at_least: int = 3) -> DataFrame:
    """Aircraft types nearest to several sightings, with the sightings' usual shape.

    Types and shapes are summed together first, so the second step sees few rows per type.
    """
    high = F.col("false_positive_likelihood") == SUSPICIOUS[0]
    by_shape = (
        correlation.filter(F.col("closest_aircraft_type").isNotNull())
        .groupBy("closest_aircraft_type", "ufo_shape")
        .agg(
            F.count("*").alias("n"),
            A.count_where(high).alias("high"),
            F.sum("closest_crash_days").alias("days"),
            F.count("closest_crash_days").alias("days_n"),
            F.sum("closest_crash_fatalities").alias("dead"),
            F.count("closest_crash_fatalities").alias("dead_n"),
            F.sum("ufo_duration").alias("seconds"),
            F.count("ufo_duration").alias("seconds_n"),
        )
    )
    usual = F.min_by("ufo_shape", F.when(F.col("ufo_shape").isNotNull(), F.struct(-F.col("n"), "ufo_shape")))
    return (
        by_shape.groupBy("closest_aircraft_type")
        .agg(
            F.sum("n").alias("correlated_ufo_sightings"),
            F.sum("high").alias("high_suspicion_sightings"),
            A.ratio(F.sum("days"), F.sum("days_n")).alias("avg_days_between"),
            A.ratio(F.sum("dead"), F.sum("dead_n")).alias("avg_crash_fatalities"),
            usual.alias("most_common_ufo_shape"),
            A.ratio(F.sum("seconds"), F.sum("seconds_n")).alias("avg_ufo_duration"),
        )
        .filter(F.col("correlated_ufo_sightings") >= at_least)
    )


DEBUNKING_COLUMNS = {
    "record_id": "string",
    "event_date": "timestamp_ntz",
    "location": "string",
    "sub_location": "string",
    "suspicion_level": "string",
    "evidence_strength": "string",
    "explanation": "string",
    "days_to_incident": "double",
    "related_aircraft": "string",
    "correlation_score": "int",
    "summary_metric": "double",
}


def debunking_analysis(correlation: DataFrame) -> DataFrame:
    """Single cases, regional months and aircraft types in one table."""
    cases = suspicious_cases(correlation).select(
        F.col("sighting_id").alias("record_id"),
        F.col("sighting_date").alias("event_date"),
        F.col("ufo_country").alias("location"),
        F.col("ufo_state").alias("sub_location"),
        F.col("false_positive_likelihood").alias("suspicion_level"),
        F.col("potential_explanation").alias("explanation"),
        F.col("closest_crash_days").alias("days_to_incident"),
        F.col("max_correlation_score").alias("correlation_score"),
    )
    rate = F.col("potential_false_positive_rate")
    regions = regional_stats(correlation).select(
        F.concat("ufo_country", F.lit("|"), "ufo_state").alias("record_id"),
        F.col("sighting_year").alias("event_date"),
        F.col("ufo_country").alias("location"),
        F.col("ufo_state").alias("sub_location"),
        F.concat(
            F.lit("Region shows "), rate, F.lit("% potential false positive rate")
        ).alias("explanation"),
        F.col("avg_days_to_crash").alias("days_to_incident"),
        rate.alias("summary_metric"),
    )
    kind = F.col("closest_aircraft_type")
    types = aircraft_type_stats(correlation).select(
        kind.alias("record_id"),
        F.concat(
            F.col("correlated_ufo_sightings"),
            F.lit(" UFO sightings correlated with "),
            kind,
            F.lit(" incidents"),
        ).alias("explanation"),
        F.col("avg_days_between").alias("days_to_incident"),
        F.col("high_suspicion_sightings").alias("summary_metric"),
    )
    return union_tagged(
        {"case_details": cases, "regional_summary": regions, "aircraft_correlation": types},
        "analysis_type",
        DEBUNKING_COLUMNS,
    )


def debunking_simple(correlation: DataFrame) -> DataFrame:
    return correlation.filter(
        F.col("false_positive_likelihood").isin(V.SUSPICION_LABELS[:3])
    ).select(
        "sighting_id",
        "sighting_date",
        "ufo_country",
        "ufo_state",
        "ufo_city",
        "ufo_shape",
        "false_positive_likelihood",
        "nearby_crashes_count",
        "crashes_within_week",
        "crashes_within_month",
        "closest_crash_days",
        "max_correlation_score",
        "has_aircraft_like_features",
        _evidence(V.ASSESS_STRONG, V.ASSESS_WEEK, V.ASSESS_MONTH, V.ASSESS_ELSE).alias(
            "debunking_assessment"
        ),
    )


SAFETY_COLUMNS = {
    "category": "string",
    "subcategory": "string",
    "crash_count": "long",
    "fatality_count": "long",
    "fatality_rate": "double",
    "risk_score": "double",
    "weather_attributed": "long",
    "time_period": "int",
    "location": "string",
}


def weather_outcomes(crashes: DataFrame, weather: DataFrame) -> DataFrame:
    """Crashes met by weather, summed per analysed group and weather category.

    Crashes are first summed per group, day and cause; weather per day and appearance. Only
    those sums are joined, weighted by each other's rows, instead of every crash with every
    observation of its day.
    """
    dims = [
        "crash_year", "crash_month", "aviation_era", "aircraft_manufacturer", "aircraft_type",
        "operator_type", "crash_country",
    ]
    named = lambda *names: {n: F.col(f"_{n}") for n in names}
    known = crashes.filter(
        (F.col("crash_year") >= V.WEATHER_FIRST_YEAR) & F.col("crash_date").isNotNull()
    ).select(
        "crash_date",
        "total_fatalities",
        "fatality_rate_percent",
        weather_mentioned(F.col("crash_summary")).alias("weather_mentioned_in_summary"),
        *[F.col(d).alias(f"_{d}") for d in dims],
    )
    rate, dead = F.col("fatality_rate_percent"), F.col("total_fatalities")
    grouped = (
        at_grains(
            known,
            "analysis_type",
            {
                "weather_severity": {},
                "temporal_trends": named("crash_year", "crash_month", "aviation_era"),
                "aircraft_vulnerability": named(
                    "aircraft_manufacturer", "aircraft_type", "operator_type"
                ),
                "geographic_risk": named("crash_country"),
            },
            where={"geographic_risk": F.col("_crash_country").isNotNull()},
        )
        .groupBy("g", "crash_date", "weather_mentioned_in_summary")
        .agg(
            F.count("*").alias("n"),
            F.sum(dead).alias("dead"),
            F.sum(rate).alias("rate_sum"),
            F.count(rate).alias("rate_n"),
        )
    )
    looks = weather_profiles(
        weather,
        [
            "weather_category", "weather_severity", "weather_risk_score", "adverse_weather",
            "poor_visibility", "high_winds",
        ],
        "w",
    )
    met = grouped.join(looks, F.col("crash_date") == F.col("observation_date")).withColumn(
        "weather_attribution", weather_attribution()
    )
    times = lambda c: F.sum(F.col(c) * F.col("w"))
    rows = F.col("n") * F.col("w")
    caused = F.col("weather_attribution").isin("EXPLICIT_WEATHER_CAUSE", "LIKELY_WEATHER_FACTOR")
    by_severity = F.when(
        F.col("g.analysis_type") == "weather_severity", F.col("weather_severity")
    )
    return met.groupBy("g", by_severity.alias("weather_severity"), "weather_category").agg(
        F.sum(rows).alias("n"),
        times("dead").alias("dead"),
        times("rate_sum").alias("rate_sum"),
        times("rate_n").alias("rate_n"),
        F.sum(rows * F.col("weather_risk_score")).alias("risk_sum"),
        *[
            A.sum_where(c, rows).alias(name)
            for name, c in (
                ("explicit", F.col("weather_mentioned_in_summary")),
                ("caused", caused),
                ("adverse", F.col("adverse_weather")),
                ("poor", F.col("poor_visibility")),
                ("windy", F.col("high_winds")),
            )
        ],
    )


def weather_safety(crashes: DataFrame, weather: DataFrame) -> DataFrame:
    """Severity, time, aircraft and place views of crashes with known weather."""
    outcomes = weather_outcomes(crashes, weather)
    usual = F.min_by(
        "weather_category",
        F.when(
            F.col("weather_category").isNotNull(), F.struct(-F.col("n"), F.col("weather_category"))
        ),
    )
    group_key = F.struct(
        "g.*",
        "weather_severity",
        F.when(F.col("weather_severity").isNotNull(), F.col("weather_category")).alias("category"),
    )
    totals = (
        outcomes.select(group_key.alias("k"), "*")
        .groupBy("k")
        .agg(
            *[
                F.sum(c).alias(c)
                for c in [
                    "n", "dead", "rate_sum", "rate_n", "risk_sum", "explicit", "caused",
                    "adverse",
                ]
            ],
            usual.alias("usual_weather"),
        )
        .select("k.*", "*")
        .drop("k")
    )
    n = F.col("n")
    rate = A.ratio(F.col("rate_sum"), F.col("rate_n"))
    risk = A.ratio(F.col("risk_sum"), n)
    caused = A.share(F.col("caused"), n)
    kind = F.col("analysis_type")
    choose = lambda **by: X.ladder(
        [(kind == name, value) for name, value in by.items()], None
    )
    enough = choose(aircraft_vulnerability=F.lit(5), geographic_risk=F.lit(10))
    columns = {
        "category": choose(
            weather_severity=F.col("weather_severity"),
            temporal_trends=F.col("aviation_era"),
            aircraft_vulnerability=F.col("aircraft_manufacturer"),
            geographic_risk=F.col("crash_country"),
        ),
        "subcategory": choose(
            weather_severity=F.col("category"),
            temporal_trends=F.col("crash_year").cast("string"),
            aircraft_vulnerability=F.col("aircraft_type"),
            geographic_risk=F.col("usual_weather"),
        ),
        "crash_count": n,
        "fatality_count": F.when(kind != "aircraft_vulnerability", F.col("dead")),
        "fatality_rate": choose(
            weather_severity=rate,
            temporal_trends=A.pct(F.col("adverse"), n),
            aircraft_vulnerability=rate,
            geographic_risk=F.round(rate, 2),
        ),
        "risk_score": choose(
            weather_severity=F.round(rate * caused, 2),
            temporal_trends=risk,
            aircraft_vulnerability=F.round(caused * (rate / 100.0), 2),
            geographic_risk=F.round(risk * rate / 100.0, 2),
        ),
        "weather_attributed": choose(
            weather_severity=F.col("explicit"),
            temporal_trends=F.col("explicit"),
            aircraft_vulnerability=F.col("caused"),
            geographic_risk=F.col("adverse"),
        ),
        "time_period": choose(temporal_trends=F.col("crash_month")),
        "location": choose(geographic_risk=F.col("crash_country")),
    }
    return totals.filter(n >= F.coalesce(enough, F.lit(1))).select(
        "analysis_type", *[columns[c].cast(t).alias(c) for c, t in SAFETY_COLUMNS.items()]
    )


SUMMARY_COLUMNS = {
    "category": "string",
    "subject": "string",
    "metric_value": "double",
    "metric_percentage": "double",
    "metric_aux": "double",
    "narrative": "string",
    "date_context": "timestamp_ntz",
    "location_context": "string",
}


def _indicators(df: DataFrame, rows: list[tuple[tuple, Column, Column | None]]) -> DataFrame:
    pairs = [
        (
            labels,
            F.struct(
                value.cast("double").alias("metric_value"),
                (F.lit(None) if part is None else part).cast("double").alias("metric_percentage"),
            ),
        )
        for labels, value, part in rows
    ]
    names = ["category", "subject", "narrative", "v"]
    return kpi_rows(df, pairs, names).select(*names[:-1], "v.*")


def summary_metrics(debunking: DataFrame, safety: DataFrame, enriched: DataFrame) -> DataFrame:
    case, level = F.col("analysis_type") == "case_details", F.col("suspicion_level")
    likely = A.count_where(case & level.isin(SUSPICIOUS))
    high = A.count_where(case & (level == SUSPICIOUS[0]))
    everything = enriched.agg(F.count("*").alias("n")).scalar()
    severity = F.col("analysis_type") == "weather_severity"
    crashes = F.sum(F.when(severity, F.col("crash_count")))
    explicit = F.sum(F.when(severity, F.col("weather_attributed")))
    parts = [
        _indicators(enriched, [(V.SUMMARY_TOTAL, F.count("*"), None)]),
        _indicators(
            debunking.withColumn("__all", everything),
            [
                (V.SUMMARY_EXPLAINED, likely, A.pct(likely, F.max("__all"), zero=0)),
                (V.SUMMARY_HIGH, high, A.pct(high, A.count_where(case), zero=0)),
            ],
        ),
        _indicators(
            safety,
            [
                (V.SUMMARY_CRASHES, crashes, None),
                (V.SUMMARY_ATTRIBUTED, explicit, A.pct(explicit, crashes)),
            ],
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def key_insights(debunking: DataFrame, safety: DataFrame, k: int = 5) -> DataFrame:
    """Top findings of each view; unknown scores come last and equals go by name."""
    kind = F.col("analysis_type")
    columns = {c: t for c, t in SUMMARY_COLUMNS.items() if c not in ("metric_percentage", "metric_aux")}

    def best(rows: DataFrame, score: str, ties: list[str]) -> DataFrame:
        order = [F.col(score).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]
        return top_k(rows, order, k)

    cases = best(
        debunking.filter(
            (kind == "case_details") & (F.col("suspicion_level") == SUSPICIOUS[0])
        ),
        "correlation_score",
        ["record_id"],
    ).select(
        F.lit("most_suspicious_location").alias("subject"),
        F.col("correlation_score").alias("metric_value"),
        F.col("explanation").alias("narrative"),
        F.col("event_date").alias("date_context"),
        F.col("location").alias("location_context"),
    )
    score, crashes = F.col("risk_score"), F.col("crash_count")
    weather = best(
        safety.filter(kind == "weather_severity"), "risk_score", ["category", "subcategory"]
    ).select(
        F.lit("highest_weather_risk").alias("subject"),
        score.alias("metric_value"),
        F.concat(
            F.lit("Weather danger index: "), score, F.lit(" with "), crashes, F.lit(" crashes")
        ).alias("narrative"),
        F.col("category").alias("location_context"),
    )
    places = best(safety.filter(kind == "geographic_risk"), "risk_score", ["location"]).select(
        F.lit("most_dangerous_region").alias("subject"),
        score.alias("metric_value"),
        F.concat(
            crashes,
            F.lit(" crashes with "),
            F.col("fatality_rate"),
            F.lit("% average fatality rate"),
        ).alias("narrative"),
        F.col("location").alias("location_context"),
    )
    del columns["category"]
    return union_tagged(
        {"ufo_debunking": cases, "aviation_weather": weather, "aviation_geographic": places},
        "category",
        columns,
    )


def regional_correlation(debunking: DataFrame, safety: DataFrame) -> DataFrame:
    """Both analyses per location, as a full outer join of two per-location aggregates."""
    kind, level = F.col("analysis_type"), F.col("suspicion_level")
    risky = lambda c: F.when(kind == "geographic_risk", F.col(c))
    regions = full_outer_summary(
        debunking,
        safety,
        "location",
        {
            "suspicious_ufo_cases": ("count", F.when(kind == "case_details", 1)),
            "high_suspicion_ufos": ("count", F.when(level == SUSPICIOUS[0], 1)),
            "avg_ufo_correlation": ("avg", F.col("correlation_score")),
        },
        {
            "total_aviation_crashes": ("sum", risky("crash_count")),
            "avg_weather_risk": ("avg", risky("risk_score")),
            "weather_crashes": ("sum", risky("weather_attributed")),
        },
        "region",
    )
    crashes = F.col("total_aviation_crashes")
    high, moderate, low = V.REGION_ACTIVITY_LABELS
    level_name = X.ladder(
        [
            ((F.col("high_suspicion_ufos") > 5) & (crashes > 20), high),
            ((F.col("suspicious_ufo_cases") > 10) & (crashes > 10), moderate),
        ],
        low,
    )
    return regions.withColumn("regional_activity_level", level_name)


def comprehensive_summary(
    debunking: DataFrame, safety: DataFrame, enriched: DataFrame
) -> DataFrame:
    """Indicators, top findings and regions in one long table."""
    cases, crashes = F.col("suspicious_ufo_cases"), F.col("total_aviation_crashes")
    regions = regional_correlation(debunking, safety).select(
        F.col("regional_activity_level").alias("category"),
        F.col("region").alias("subject"),
        cases.alias("metric_value"),
        crashes.alias("metric_percentage"),
        F.col("avg_weather_risk").alias("metric_aux"),
        F.concat(
            F.lit("Region with "),
            cases,
            F.lit(" suspicious UFO cases and "),
            crashes,
            F.lit(" crashes"),
        ).alias("narrative"),
        F.col("region").alias("location_context"),
    )
    return union_tagged(
        {
            "summary_metrics": summary_metrics(debunking, safety, enriched),
            "key_insights": key_insights(debunking, safety),
            "regional_analysis": regions,
        },
        "data_type",
        SUMMARY_COLUMNS,
    )


def comprehensive_simple(
    enriched: DataFrame, correlation: DataFrame, safety: DataFrame, as_of: str
) -> DataFrame:
    """Nine counts with fixed names; one aggregate pass per input."""
    names = ["analysis_area", "metric_name", "description", "metric_value"]
    active = F.col("city_activity_level").isin(V.CITY_ACTIVITY_LABELS[:2])
    likely, kind = F.col("false_positive_likelihood"), F.col("analysis_type")
    parts = [
        (
            enriched,
            [
                (V.KPI_SIGHTINGS, F.count("*")),
                (V.KPI_COUNTRIES, F.count_distinct("country_standardized")),
                (V.KPI_ACTIVE, A.count_where(active)),
            ],
        ),
        (
            correlation,
            [
                (V.KPI_SUSPICIOUS, A.count_where(likely.isin(SUSPICIOUS))),
                (V.KPI_HIGH, A.count_where(likely == SUSPICIOUS[0])),
                (V.KPI_FEATURES, A.count_where(F.col("has_aircraft_like_features"))),
            ],
        ),
        (
            safety,
            [
                (V.KPI_RISKS, A.count_where(kind == "weather_severity")),
                (V.KPI_AREAS, A.count_where(kind == "geographic_risk")),
                (V.KPI_TYPES, A.count_where(kind == "aircraft_vulnerability")),
            ],
        ),
    ]
    rows = [kpi_rows(df, kpis, names) for df, kpis in parts]
    return (
        rows[0]
        .unionByName(rows[1])
        .unionByName(rows[2])
        .select(
            "analysis_area",
            "metric_name",
            "metric_value",
            "description",
            F.lit(as_of).cast("timestamp_ntz").alias("last_updated"),
        )
    )
