"""One query per operator and job, over the raw stand-ins, with its reference SQL.

Jobs whose inputs are stored tables in the reference data flow (enriched sightings,
correlations, summary tables) read them through `durable`, as a deployment would read the
written table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity import oracle
from parity.oracle import AS_OF, statement
from parity.standins import EXTRA, raw
from sightline.functions import columns as X
from sightline.functions import fixed_values as V
from sightline.operators import cleaning as C
from sightline.operators import joins as J
from sightline.operators import metrics as M
from sightline.operators import quality as Q
from sightline.operators.profiles import activity_span
from sightline.operators.ranking import repeat_rows
from sightline.plans import enrichment as E
from sightline.plans import flights as FL
from sightline.plans import incidents as I
from sightline.plans import sightings as S
from sightline.plans.checks import CHECKS, store_checked, stored_report
from sightline.plans.orders import ORDERS, ordered
from sightline.sources.tables import (
    commit_table,
    date_spine,
    durable,
    read_source,
    read_table,
    refresh_partitions,
    register_view,
    row_counts,
    sample_table,
    shared_folder,
    spine_over,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, so that the order of summation does not show."""
    return df.select(
        *[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    )


def query(name: str, sql: str, doubles: str = "", shown=rounded) -> Callable[[Query], Query]:
    """`shown` is the identity where a query rounds its few rows before they are multiplied."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: shown(build(spark, sf_dir))
        SQL[name] = statement(sql, doubles.split())
        return build

    return register


# ---- inputs -------------------------------------------------------------------------------


def sightings(spark, d):
    return C.clean_sightings(
        raw(spark, d, "sightings"), raw(spark, d, "coordinates"), extra=["sight_key"]
    )


def cleaned(spark, d):
    """With `sighting_id` from the global sequence, from the stored first cleaning."""
    return C.standardize_sightings(durable(sightings(spark, d)).drop("sight_key"))


def keyed(spark, d):
    return C.standardize_sightings(sightings(spark, d), id_col="sight_key")


def enriched(spark, d, named=None):
    return E.location_enriched(
        cleaned(spark, d) if named is None else named,
        C.coordinate_lookup(raw(spark, d, "coordinates")),
    )


def crashes(spark, d):
    return C.clean_crashes(raw(spark, d, "crashes"))


def weather(spark, d):
    return C.clean_weather(raw(spark, d, "weather"))


def thin_weather(spark, d):
    return C.thin_weather(raw(spark, d, "weather"))


def flights(spark, d):
    return C.clean_flights(raw(spark, d, "flights"))


def volumes(spark, d):
    return E.flight_volume(flights(spark, d))


def correlation(spark, d, named=None, fallen=None):
    """Needs no column of the enriched facts beyond those of the cleaned ones."""
    return E.proximity_correlation(
        cleaned(spark, d) if named is None else named,
        crashes(spark, d) if fallen is None else fallen,
    )


def safety(spark, d, fallen=None):
    return I.weather_safety(
        crashes(spark, d) if fallen is None else fallen, weather(spark, d)
    )


def fallen_once(spark, d):
    """Cleaned crashes as a stored table, with the columns that correlation and safety report ask for."""
    return durable(
        crashes(spark, d).select(
            "crash_date", "crash_year", "crash_month", "crash_location", "crash_country",
            "aircraft_type", "aircraft_manufacturer", "operator_type", "aviation_era",
            "total_fatalities", "fatality_rate_percent", "crash_summary",
        )
    )


def crash_days(spark, d):
    return I.crashes_by_day(C.thin_crashes(crashes(spark, d)), thin_weather(spark, d))


def traffic(spark, d):
    return FL.traffic_profile(durable(FL.flight_cube(flights(spark, d))))


def cube(spark, d):
    """The cube as the table that a deployment stores; the raw tables are read for it once."""
    return durable(S.sighting_cube(enriched(spark, d)))


def dashboard(spark, d):
    return S.dashboard_summary(cube(spark, d), AS_OF)


def stored_source(spark, d, name):
    """The raw table as a file of the source layer, read back through its declared schema."""
    root = f"{shared_folder(spark)}/layers-{uuid.uuid4().hex}"
    write_table(raw(spark, d, name), root, "raw", name)
    extra = EXTRA.get(name, "").replace(",", "").split()[:1]
    read = read_source(spark, name, f"{root}/raw", null_tokens=["\\N"])
    if not extra:
        return read
    return read_table(spark, root, "raw", name).select(*read.columns, *extra)


# ---- sources and sinks ----------------------------------------------------------------------

for _source, _doubles in {
    "sightings": "",
    "crashes": "",
    "weather": "temperature_c apparent_temperature_c humidity wind_speed_km wind_bearing_degrees "
    "visibility_km loud_cover pressure_millibars",
    "flights": "duration price",
    "coordinates": "latitude longitude usa_state_latitude usa_state_longitude",
}.items():
    query(f"scan_{_source}", f"select * from raw_{_source}", _doubles)(
        lambda spark, d, n=_source: stored_source(spark, d, n)
    )


SPINE_START = "1900-01-01"


@query(
    "date_spine",
    f"select u as sighting_date, count(k.sighting_date) as sightings from (select cast(unnest("
    f"generate_series(least(date '{SPINE_START}', (select min(cast(sighting_date as date)) from cleaned)), "
    f"greatest(date '{AS_OF}', (select max(cast(sighting_date as date)) from cleaned)), "
    f"interval 1 day)) as date) as u) "
    "left join (select cast(sighting_date as date) as sighting_date from cleaned) k "
    "on k.sighting_date = u group by u",
)
def _(spark, d):
    days = cleaned(spark, d).groupBy(F.to_date("sighting_date").alias("date_day")).agg(
        F.count("*").alias("n")
    )
    # No sighting is left out: the declared days reach as far as those of the data.
    declared = date_spine(spark, SPINE_START, AS_OF)
    spine = spine_over(declared.unionByName(days.select("date_day")), "date_day")
    return spine.join(days, "date_day", "left").select(
        F.col("date_day").alias("sighting_date"), F.coalesce("n", F.lit(0)).alias("sightings")
    )


@query(
    "row_counts",
    " union all ".join(
        f"select '{n}' as mart_name, count(*) as row_count from {step}"
        for n, step in {
            "by_country_time": "country_time",
            "comprehensive_simple": "comprehensive_short",
            "dashboard_summary": "dashboard",
            "debunking_analysis": "debunking",
            "debunking_simple": "debunking_short",
            "top_locations": "locations",
        }.items()
    ),
)
def _(spark, d):
    named = cleaned(spark, d)
    facts = enriched(spark, d, named)
    linked = durable(correlation(spark, d, named))
    cube = durable(S.sighting_cube(facts))
    return row_counts(
        {
            "by_country_time": S.by_country_time(cube),
            "comprehensive_simple": I.comprehensive_simple(facts, linked, safety(spark, d), AS_OF),
            "dashboard_summary": S.dashboard_summary(cube, AS_OF),
            "debunking_analysis": I.debunking_analysis(linked),
            "debunking_simple": I.debunking_simple(linked),
            "top_locations": S.top_locations(cube, AS_OF),
        }
    )


@query(
    "stored_partition",
    "select crash_date, crash_year, crash_country, total_fatalities from crashes "
    "where crash_year = 1996 and total_fatalities > 10",
)
def _(spark, d):
    # A view over a table partitioned by year: the year picks folders, the rest is pushed down.
    root = f"{shared_folder(spark)}/layers-{uuid.uuid4().hex}"
    stored = write_table(crashes(spark, d), root, "core", "crashes", partition_by=["crash_year"])
    register_view(stored, "stored_crashes")
    return spark.sql(
        "select crash_date, crash_year, crash_country, total_fatalities from stored_crashes "
        "where crash_year = 1996 and total_fatalities > 10"
    )


@query(
    "refreshed_partition",
    """select crash_date, crash_year, crash_country, total_fatalities from crashes
      where crash_year = 1995 or crash_year = 1996 and total_fatalities > 10""",
)
def _(spark, d):
    # Only the partition that the new rows belong to is replaced; its neighbour keeps its files.
    root = f"{shared_folder(spark)}/layers-{uuid.uuid4().hex}"
    columns = ["crash_date", "crash_country", "total_fatalities", "crash_year"]
    fallen = crashes(spark, d).select(*columns)
    write_table(fallen, root, "core", "crashes", partition_by=["crash_year"])
    grave = fallen.filter("crash_year = 1996 and total_fatalities > 10")
    table = refresh_partitions(grave, root, "core", "crashes", ["crash_year"])
    return table.filter(F.col("crash_year").isin(1995, 1996))


@query(
    "committed_table",
    """select crash_date, crash_country, total_fatalities * 2 as total_fatalities from crashes
      where total_fatalities > 10""",
)
def _(spark, d):
    # The second version is written from the first.
    root = f"{shared_folder(spark)}/layers-{uuid.uuid4().hex}"
    columns = ["crash_date", "crash_country", "total_fatalities"]
    first = commit_table(crashes(spark, d).select(*columns), root, "core", "crashes")
    grave = first.filter("total_fatalities > 10")
    doubled = grave.withColumn("total_fatalities", F.col("total_fatalities") * 2)
    return commit_table(doubled, root, "core", "crashes")


@query("sample_top_locations", "select * from locations order by location_type, global_rank limit 100",
       "avg_duration_seconds median_duration_seconds center_latitude center_longitude pct_with_coordinates")
def _(spark, d):
    table = S.top_locations(cube(spark, d), AS_OF)
    return sample_table(table, 100, [F.asc("location_type"), F.asc("global_rank")])


@query(
    "sample_by_country_time",
    "select * from country_time order by country nulls last, region nulls last, time_grain, "
    "period_date nulls last limit 100",
    "avg_duration_seconds median_duration_seconds max_duration_seconds pct_with_coordinates "
    "pct_with_comments avg_latitude avg_longitude",
)
def _(spark, d):
    keys = ["country", "region", "time_grain", "period_date"]
    table = S.by_country_time(cube(spark, d))
    return sample_table(table, 100, [F.col(c).asc_nulls_last() for c in keys])


@query(
    "sample_ordered",
    "select * from cleaned_keyed order by sighting_datetime, sighting_id limit 100",
    "duration_seconds_clean latitude_clean longitude_clean",
)
def _(spark, d):
    return sample_table(keyed(spark, d), 100, [F.asc("sighting_datetime"), F.asc("sighting_id")])


# ---- cleaning -------------------------------------------------------------------------------


@query(
    "coerce_timestamp_report",
    f"""select rule, count(*) as rows from (select case
      when try_strptime(datetime, '%m/%d/%Y %H:%M') is not null then 'us_minutes'
      when {oracle.day_text('datetime')} is not null then 'generic'
      when try_cast(datetime as double) > 10000000000 then 'epoch_millis'
      when {oracle.day_text('date_posted')} is not null then 'fallback' else 'none' end as rule
      from raw_sightings) group by rule""",
)
def _(spark, d):
    return C.coerce_report(raw(spark, d, "sightings"), "datetime", "date_posted")


_SECONDS = f"({oracle.number('duration_seconds')})"


@query(
    "split_duration",
    f"""select datetime, city, state, country, shape, duration_seconds as duration,
      cast(floor({_SECONDS} / 3600) as bigint) as duration_hours,
      cast(floor(({_SECONDS} % 3600) / 60) as bigint) as duration_minutes,
      comments, latitude, longitude from raw_sightings""",
)
def _(spark, d):
    return C.split_duration(raw(spark, d, "sightings"))


query("clean_sightings", "select * from sightings", "duration_seconds latitude longitude")(sightings)


@query(
    "clean_sightings_all_coordinates",
    """select c.* exclude (state, country, geo_day_key),
      coalesce(c.state, nullif(r.usa_state, '')) as state,
      coalesce(c.country, nullif(r.country, '')) as country
      from (select * replace (u.state as state, u.country as country) from sightings s
        join (select sight_key, nullif(state, '') as state, nullif(country, '') as country
          from raw_sightings) u using (sight_key)) c
      left join raw_coordinates r on round(c.latitude, 1) = round(r.latitude, 1)
        and round(c.longitude, 1) = round(r.longitude, 1)""",
    "duration_seconds latitude longitude",
    shown=lambda df: repeat_rows(rounded(df), "coordinate_rows"),
)
def _(spark, d):
    return C.clean_sightings(
        raw(spark, d, "sightings"),
        raw(spark, d, "coordinates"),
        dedupe_coordinates=False,
        extra=["sight_key"],
        expand=False,
    ).drop("geo_day_key")


@query(
    "standardize_sightings",
    "select * from cleaned_numbered",
    "duration_seconds_clean latitude_clean longitude_clean",
)
def _(spark, d):
    return cleaned(spark, d)


query(
    "standardize_keyed_sightings",
    "select * from cleaned_keyed",
    "duration_seconds_clean latitude_clean longitude_clean",
)(keyed)
query(
    "clean_weather",
    "select * from weather",
    "temperature_celsius apparent_temperature_celsius humidity_percent wind_speed_kmh wind_bearing "
    "visibility_km_clean cloud_cover_percent pressure_mb",
)(weather)
query(
    "thin_weather",
    "select * from thin_weather",
    "temperature_c apparent_temperature_c humidity wind_speed_km wind_bearing_degrees visibility_km "
    "pressure_millibars",
)(thin_weather)
query("clean_crashes", "select * from crashes", "fatality_rate_percent")(crashes)
query("thin_crashes", "select * from thin_crashes")(
    lambda spark, d: C.thin_crashes(crashes(spark, d))
)
query("clean_flights", "select * from flights", "flight_duration_hours ticket_price")(flights)
query("coordinate_lookup", "select * from lookup", "lat_bucket lon_bucket")(
    lambda spark, d: C.coordinate_lookup(raw(spark, d, "coordinates"))
)


@query(
    "label_distribution",
    f"""select {oracle.families('type', V.MANUFACTURER_WORDS, "'OTHER'")} as maker,
      count(*) as rows from raw_crashes group by 1""",
)
def _(spark, d):
    kind = F.upper("type")
    steps = [(X.contains_any(kind, words), label) for label, words in V.MANUFACTURER_WORDS]
    return C.label_distribution(
        C.classify(raw(spark, d, "crashes"), "maker", steps, "OTHER"), "maker"
    )


# ---- enrichment -----------------------------------------------------------------------------

query(
    "location_enriched",
    "select * from enriched",
    "duration_seconds_clean latitude_clean longitude_clean city_avg_latitude city_avg_longitude",
)(enriched)


@query(
    "proximity_join",
    """select ufo_country, cast(sighting_date as date) as sighting_date, crash_date,
      crash_country, count(distinct sighting_id) as sightings, count(*) as pairs,
      cast(datediff('day', crash_date, sighting_date) as int) as days_after,
      cast(abs(datediff('day', crash_date, sighting_date)) as int) as days_difference
      from (select u.sighting_id, u.country_standardized as ufo_country, u.sighting_date,
          c.crash_date, c.crash_country
        from enriched u join crash_listing c on c.listed_as = u.country_standardized
          and abs(datediff('day', c.crash_date, u.sighting_date)) <= 7)
      group by all""",
)
def _(spark, d):
    # Day-level on both sides: the number of pairs is carried as a product, never spelled out.
    left = J.day_counts(enriched(spark, d), "country_standardized", "sighting_date", "sightings")
    events = crashes(spark, d).filter(F.col("crash_year") >= V.PROXIMITY_FIRST_YEAR)
    right = J.day_counts(events, "crash_country", "crash_date", "crashes")
    pairs = J.proximity_join(
        left,
        right,
        "sighting_date",
        "crash_date",
        7,
        ("country_standardized", "crash_country"),
        V.CRASH_COUNTRY_WORDS,
        how="inner",
    )
    return pairs.select(
        F.col("country_standardized").alias("ufo_country"),
        "sighting_date",
        "crash_date",
        "crash_country",
        "sightings",
        (F.col("sightings") * F.col("crashes")).alias("pairs"),
        "days_after",
        "days_difference",
    )


@query(
    "nearest_match",
    """select sighting_id, closest_crash_days, closest_crash_date, closest_crash_location,
      closest_aircraft_type, closest_crash_fatalities from correlation
      where closest_crash_days is not null""",
)
def _(spark, d):
    events = crashes(spark, d).filter(F.col("crash_year") >= V.PROXIMITY_FIRST_YEAR)
    dead = F.col("total_fatalities")
    order = [F.col("crash_location"), F.col("aircraft_type"), dead.isNull(), dead]
    pairs = J.asof_pairs(
        enriched(spark, d).select("sighting_id", "country_standardized", "sighting_date"),
        events.select("crash_date", "crash_country", "crash_location", "aircraft_type", dead),
        "sighting_date",
        "crash_date",
        V.PROXIMITY_DAYS,
        ("country_standardized", "crash_country"),
        order,
        V.CRASH_COUNTRY_WORDS,
    )
    details = ["crash_date", "crash_location", "aircraft_type", "total_fatalities"]
    best = J.nearest_match(
        pairs, "sighting_id", "days_difference", [F.col("crash_date")], ["days_difference", *details]
    )
    return best.select(
        "sighting_id",
        F.col("days_difference").cast("int").alias("closest_crash_days"),
        F.col("crash_date").alias("closest_crash_date"),
        F.col("crash_location").alias("closest_crash_location"),
        F.col("aircraft_type").alias("closest_aircraft_type"),
        F.col("total_fatalities").alias("closest_crash_fatalities"),
    )


@query(
    "pair_labels",
    """select ufo_country, same_country, same_country and state_clean = crash_place as same_region,
      case when same_country and days <= 1 then 'VERY_HIGH' when same_country and days <= 7 then 'HIGH'
        when same_country and days <= 30 then 'MODERATE' when same_country and days <= 90 then 'LOW'
        else 'VERY_LOW' end as correlation_strength,
      case when total_fatalities > 100 then 'HIGH_MEDIA' when total_fatalities > 20 then 'MODERATE_MEDIA'
        when total_fatalities > 0 then 'LOW_MEDIA' else 'MINIMAL_MEDIA' end as media_attention_level,
      count(*) as pairs
      from (select u.country_standardized as ufo_country, u.state_clean, c.total_fatalities,
          split_part(c.crash_location, ',', 1) as crash_place,
          u.country_standardized = c.crash_country as same_country,
          abs(datediff('day', c.crash_date, u.sighting_date)) as days
        from enriched u join crash_listing c on c.listed_as = u.country_standardized
          and abs(datediff('day', c.crash_date, u.sighting_date)) <= 365)
      group by all""",
)
def _(spark, d):
    return E.pair_labels(enriched(spark, d), crashes(spark, d))


query(
    "proximity_correlation",
    "select * from correlation",
    "ufo_latitude ufo_longitude ufo_duration",
)(correlation)


@query(
    "weather_incident_analysis",
    "select *, count(*) as weather_rows from incidents group by all",
    "fatality_rate_percent",
    shown=lambda df: df,
)
def _(spark, d):
    # The rate, the only double, follows from other columns of a crash, so rounding merges no groups.
    fallen = rounded(crashes(spark, d))
    return E.weather_incident_analysis(fallen, weather(spark, d), expand=False)


query(
    "weather_incident_rows", "select * from incidents", "fatality_rate_percent", shown=lambda df: df
)(lambda spark, d: E.weather_incident_analysis(rounded(crashes(spark, d)), weather(spark, d)))


query(
    "flight_volume",
    "select * from volumes",
    "avg_flight_duration min_flight_duration max_flight_duration avg_ticket_price min_ticket_price "
    "max_ticket_price avg_stops nonstop_percentage data_completeness_percentage",
)(volumes)

# ---- summary tables -------------------------------------------------------------------------

query("crashes_by_day", "select * from crash_days", "avg_temp_c")(crash_days)


@query(
    "crashes_by_day_daily_weather",
    """select c.event_date, count(*) as crash_events,
      cast(sum(coalesce(c.fatalities, 0)) as bigint) as total_fatalities,
      any_value(w.t) as avg_temp_c, any_value(w.s) as any_weather_summary
      from thin_crashes c left join (select event_date, avg(temperature_c) as t,
        min(daily_summary) as s from thin_weather group by 1) w on c.event_date = w.event_date
      group by 1""",
    "avg_temp_c",
)
def _(spark, d):
    return I.crashes_by_day(
        C.thin_crashes(crashes(spark, d)), thin_weather(spark, d), weather_daily=True
    )


@query(
    "sightings_with_weather",
    "select * from sighting_days",
    "avg_duration_seconds avg_temp_c avg_humidity avg_wind_speed_km",
)
def _(spark, d):
    return I.sightings_with_weather(sightings(spark, d), thin_weather(spark, d))


@query("debunking_analysis", "select * from debunking", "days_to_incident summary_metric")
def _(spark, d):
    return I.debunking_analysis(durable(correlation(spark, d)))


query("debunking_simple", "select * from debunking_short")(
    lambda spark, d: I.debunking_simple(correlation(spark, d))
)


@query(
    "suspicious_cases",
    """select sighting_id, false_positive_likelihood, debunking_evidence_strength,
      potential_explanation from cases""",
)
def _(spark, d):
    return I.suspicious_cases(correlation(spark, d)).select(
        "sighting_id",
        "false_positive_likelihood",
        "debunking_evidence_strength",
        "potential_explanation",
    )


@query(
    "debunking_rank",
    """select sighting_id, false_positive_likelihood, max_correlation_score, closest_crash_days,
      debunking_evidence_strength, row_number() over (order by max_correlation_score desc,
        closest_crash_days nulls last, sighting_id) as debunking_rank from cases""",
)
def _(spark, d):
    return I.debunking_rank(correlation(spark, d))


@query(
    "aircraft_type_stats",
    "select * from aircraft_types",
    "avg_days_between avg_crash_fatalities avg_ufo_duration",
)
def _(spark, d):
    return I.aircraft_type_stats(correlation(spark, d))


query(
    "dashboard_summary",
    "select * from dashboard",
    "avg_duration_seconds median_duration_seconds max_duration_seconds pct_with_coordinates "
    "pct_with_comments avg_sightings_per_year",
)(dashboard)
query(
    "by_country_time",
    "select * from country_time",
    "avg_duration_seconds median_duration_seconds max_duration_seconds pct_with_coordinates "
    "pct_with_comments avg_latitude avg_longitude",
)(lambda spark, d: S.by_country_time(cube(spark, d)))
query(
    "top_locations",
    "select * from locations",
    "avg_duration_seconds median_duration_seconds center_latitude center_longitude "
    "pct_with_coordinates",
)(lambda spark, d: S.top_locations(cube(spark, d), AS_OF))


@query(
    "activity_span",
    """select country_standardized, min(sighting_date) as first_date,
      max(sighting_date) as last_date,
      cast(datediff('day', min(sighting_date), max(sighting_date)) as int) as days_of_activity,
      cast(year(max(sighting_date)) - year(min(sighting_date)) as int) as years_of_data
      from cleaned_keyed group by 1""",
)
def _(spark, d):
    return activity_span(cleaned(spark, d), ["country_standardized"], "sighting_date")


query("weather_safety", "select * from safety", "fatality_rate risk_score")(safety)
query(
    "route_volume",
    "select * from route_report",
    "weighted_avg_duration weighted_avg_price route_share_of_departure_city "
    "route_share_of_arrival_city morning_flight_percentage afternoon_flight_percentage "
    "evening_flight_percentage night_flight_percentage",
)(lambda spark, d: FL.route_volume(volumes(spark, d)))
query(
    "traffic_patterns",
    "select * from traffic_report",
    "avg_duration complexity_indicator percentage_of_total_traffic",
)(lambda spark, d: FL.traffic_patterns(durable(traffic(spark, d))))
query("hourly_patterns", "select * from hours", "avg_duration_in_hour")(
    lambda spark, d: FL.hourly_patterns(traffic(spark, d))
)
query(
    "airline_patterns",
    "select * from airlines",
    "avg_airline_duration avg_airline_stops airline_nonstop_percentage",
)(lambda spark, d: FL.airline_patterns(traffic(spark, d)))
query(
    "traffic_summary",
    "select * from traffic",
    "overall_avg_duration overall_avg_stops "
    + " ".join(f"{c.lower()}_percentage" for c in [*FL.DAYTIMES, *FL.HAULS]),
)(lambda spark, d: FL.traffic_summary(traffic(spark, d)))


@query(
    "comprehensive_summary",
    "select * from comprehensive",
    "metric_value metric_percentage metric_aux",
)
def comprehensive(spark, d, named=None):
    named = cleaned(spark, d) if named is None else named
    fallen = fallen_once(spark, d)
    linked = durable(correlation(spark, d, named, fallen))
    return I.comprehensive_summary(
        durable(I.debunking_analysis(linked)),
        durable(safety(spark, d, fallen)),
        enriched(spark, d, named),
    )


@query("comprehensive_simple", "select * from comprehensive_short")
def comprehensive_short(spark, d):
    named, fallen = cleaned(spark, d), fallen_once(spark, d)
    return I.comprehensive_simple(
        enriched(spark, d, named),
        correlation(spark, d, named, fallen),
        safety(spark, d, fallen),
        AS_OF,
    )


# ---- checks ---------------------------------------------------------------------------------


@query(
    "dq_not_null",
    "select * from crashes where crash_date is null",
    "fatality_rate_percent",
)
def _(spark, d):
    return Q.not_null(crashes(spark, d), "crash_date")


@query(
    "dq_unique",
    """select flight_record_id, count(*) as occurrences from flights group by 1
      having count(*) > 1""",
)
def _(spark, d):
    return Q.unique(flights(spark, d), "flight_record_id")


@query(
    "dq_accepted_values",
    """select flight_record_id, flight_route, flight_duration_category from flights
      where flight_duration_category not in ('SHORT_HAUL', 'MEDIUM_HAUL', 'LONG_HAUL')""",
)
def _(spark, d):
    bad = Q.accepted_values(
        flights(spark, d), "flight_duration_category", ["SHORT_HAUL", "MEDIUM_HAUL", "LONG_HAUL"]
    )
    return bad.select("flight_record_id", "flight_route", "flight_duration_category")


@query(
    "dq_accepted_range",
    """select flight_record_id, flight_route, departure_hour from flights
      where departure_hour is not null and departure_hour not between 0 and 23""",
)
def _(spark, d):
    bad = Q.accepted_range(
        flights(spark, d), "departure_hour", 0, 23, "departure_hour is not null"
    )
    return bad.select("flight_record_id", "flight_route", "departure_hour")


@query(
    "dq_expression",
    """select flight_record_id, flight_route, ticket_price from flights
      where not ticket_price > 100""",
    "ticket_price",
)
def _(spark, d):
    bad = Q.expression_is_true(flights(spark, d), "ticket_price", "> 100")
    return bad.select("flight_record_id", "flight_route", "ticket_price")


_STEPS_OF = {
    "clean_weather": "weather",
    "clean_crashes": "crashes",
    "clean_flights": "flights",
    "standardize_sightings": "cleaned_numbered",
    "location_enriched": "enriched",
    "flight_volume": "volumes",
    "crashes_by_day": "crash_days",
    "weather_safety": "safety",
    "sightings_with_weather": "sighting_days",
    "by_country_time": "country_time",
    "top_locations": "locations",
    "dashboard_summary": "dashboard",
    "debunking_analysis": "debunking",
    "comprehensive_summary": "comprehensive",
}


def _check_sql(model: str, kind: str, col: str, *args) -> str:
    step = _STEPS_OF[model]
    if kind == "unique":
        source = f"(select {col} from {step} where {col} is not null group by 1 having count(*) > 1)"
        bad = "true"
    else:
        source = step
        bad = {
            "not_null": lambda: f"{col} is null",
            "accepted_values": lambda v: f"{col} not in ({', '.join(map(_literal, v))})",
            "accepted_range": lambda lo, hi, *w: f"({col} < {lo} or {col} > {hi})",
            "expression_is_true": lambda e: f"not ({col} {e})",
        }[kind](*args)
    return (
        f"select '{kind}' as \"check\", '{model}' as model, '{col}' as \"column\", "
        f"count(*) filter ({bad}) as failures from {source}"
    )


def _literal(v) -> str:
    return str(v).lower() if isinstance(v, bool) else oracle.text(v)


@query(
    "dq_report",
    " union all ".join(_check_sql(m, *check) for m in _STEPS_OF for check in CHECKS[m]),
)
def _(spark, d):
    # Every model is written once, from the stored models it is built on, and checked as it is written.
    root = f"{shared_folder(spark)}/layers-{uuid.uuid4().hex}"
    models = []

    def store(model, df):
        checked = store_checked(df, model, lambda t: write_table(t, root, "models", model))
        models.append(checked)
        return checked.table

    seen, hourly = durable(sightings(spark, d)), thin_weather(spark, d)
    conditions = store("clean_weather", weather(spark, d))
    fallen = store("clean_crashes", crashes(spark, d))
    flown = store("clean_flights", flights(spark, d))
    named = store("standardize_sightings", C.standardize_sightings(seen.drop("sight_key")))
    lookup = C.coordinate_lookup(raw(spark, d, "coordinates"))
    facts = store("location_enriched", E.location_enriched(named, lookup))
    store("flight_volume", E.flight_volume(flown))
    store("crashes_by_day", I.crashes_by_day(C.thin_crashes(fallen), hourly))
    risks = store("weather_safety", I.weather_safety(fallen, conditions))
    store("sightings_with_weather", I.sightings_with_weather(seen, hourly))
    counted = durable(S.sighting_cube(facts))
    store("by_country_time", S.by_country_time(counted))
    store("top_locations", S.top_locations(counted, AS_OF))
    store("dashboard_summary", S.dashboard_summary(counted, AS_OF))
    linked = durable(E.proximity_correlation(facts, fallen))
    cases = store("debunking_analysis", I.debunking_analysis(linked))
    store("comprehensive_summary", I.comprehensive_summary(cases, risks, facts))
    return stored_report(models)


# ---- metrics --------------------------------------------------------------------------------


@query(
    "metric_sum",
    """select cast(date_trunc('month', event_date) as date) as metric_time,
      cast(sum(crash_events) as bigint) as crash_events_sum from crash_days group by 1""",
)
def _(spark, d):
    return M.metric(crash_days(spark, d), "crash_events_sum", grain="month")


@query(
    "metric_average",
    """select any_weather_summary as weather_summary,
      cast(date_trunc('year', event_date) as date) as metric_time,
      avg(avg_temp_c) as avg_temperature_celsius from crash_days group by 1, 2""",
    "avg_temperature_celsius",
)
def _(spark, d):
    return M.metric(
        crash_days(spark, d), "avg_temperature_celsius", ["weather_summary"], grain="year"
    )


@query(
    "metric_count",
    """select cast(date_trunc('week', event_date) as date) as metric_time,
      count(event_date) as events_count from crash_days group by 1""",
)
def _(spark, d):
    return M.metric(crash_days(spark, d), "events_count", grain="week")


@query(
    "metric_count_distinct",
    "select metric_type, count(distinct country) as count_country from dashboard group by 1",
)
def _(spark, d):
    return M.metric(dashboard(spark, d), "count_country", ["metric_type"])


@query(
    "metric_min",
    """select ufo_country, cast(min(closest_crash_days) as int) as closest_crash_days
      from debunking_short group by 1""",
)
def _(spark, d):
    return M.metric(
        I.debunking_simple(correlation(spark, d)), "closest_crash_days", ["ufo_country"]
    )


@query(
    "metric_max",
    """select metric_type, time_period, max(years_of_data) as years_of_data
      from dashboard group by 1, 2""",
)
def _(spark, d):
    return M.metric(dashboard(spark, d), "years_of_data", ["metric_type", "time_period"])


@query(
    "metric_median",
    """select metric_type, median(median_duration_seconds) as median_duration_seconds
      from dashboard group by 1""",
    "median_duration_seconds",
)
def _(spark, d):
    return M.metric(dashboard(spark, d), "median_duration_seconds", ["metric_type"])


@query(
    "metric_sum_boolean",
    """select cast(date_trunc('day', sighting_date) as date) as metric_time,
      count(*) filter (has_aircraft_like_features) as has_aircraft_like_features
      from debunking_short group by 1""",
)
def _(spark, d):
    return M.metric(
        I.debunking_simple(correlation(spark, d)), "has_aircraft_like_features", grain="day"
    )


@query(
    "metric_spine_fill",
    """select u as metric_time, coalesce(n, 0) as total_fatalities_sum from (select cast(unnest(
      generate_series((select min(event_date) from crash_days),
        (select max(event_date) from crash_days), interval 1 day)) as date) as u)
      left join (select event_date, total_fatalities as n from crash_days) on event_date = u""",
)
def _(spark, d):
    days = crash_days(spark, d)
    spine = spine_over(days, "event_date")
    return M.metric(days, "total_fatalities_sum", grain="day", spine=spine)


@query(
    "metric_spine_fill_by_dimension",
    """select g.weather_summary, p.metric_time, coalesce(n, 0) as crash_events_sum
      from (select distinct any_weather_summary as weather_summary from crash_days) g
      cross join (select distinct cast(date_trunc('month', u) as date) as metric_time from (
        select unnest(generate_series((select min(event_date) from crash_days),
          (select max(event_date) from crash_days), interval 1 day)) as u)) p
      left join (select any_weather_summary as weather_summary,
        cast(date_trunc('month', event_date) as date) as metric_time,
        cast(sum(crash_events) as bigint) as n from crash_days group by 1, 2) m
        on m.weather_summary is not distinct from g.weather_summary
          and m.metric_time = p.metric_time""",
)
def _(spark, d):
    days = crash_days(spark, d)
    return M.metric(
        days,
        "crash_events_sum",
        ["weather_summary"],
        grain="month",
        spine=spine_over(days, "event_date"),
    )


def _measures_sql(model: str, step: str, by: list[str], doubles: str) -> str:
    m = M.MODELS[model]
    whole = "cast(sum({0}) as bigint)"
    form = {
        "sum": whole, "average": "avg({0})", "count": "count({0})", "min": "min({0})",
        "count_distinct": "count(distinct {0})", "max": "max({0})", "median": "median({0})",
        "sum_boolean": "count(*) filter ({0})",
    }
    keys = [f"{ {**m.dimensions, **m.entities}[g]} as {g}" for g in by]
    parts = []
    for name, (agg, expression) in m.measures.items():
        as_double = agg == "sum" and name in doubles.split()
        parts.append(f"{('sum({0})' if as_double else form[agg]).format(expression)} as {name}")
    return f"select {', '.join([*keys, *parts])} from {step} group by all"


def _cases(spark, d):
    return I.debunking_analysis(durable(correlation(spark, d)))


for _model, (_step, _by, _build, _doubles) in {
    "crashes_by_day": ("crash_days", ["weather_summary"], crash_days, "avg_temperature_celsius"),
    "dashboard_summary": (
        "dashboard",
        ["metric_type"],
        dashboard,
        "max_duration_seconds avg_duration_seconds pct_with_coordinates pct_with_comments "
        "avg_sightings_per_year median_duration_seconds",
    ),
    "debunking_analysis": (
        "debunking", ["analysis_type"], _cases, "days_to_incident summary_metric",
    ),
    "debunking_simple": (
        "debunking_short",
        ["ufo_country"],
        lambda spark, d: I.debunking_simple(correlation(spark, d)),
        "",
    ),
    "comprehensive_summary": (
        "comprehensive",
        ["data_type"],
        comprehensive,
        "metric_value metric_percentage_avg insight_score_avg suspicious_ufo_cases_sum "
        "total_aviation_crashes_sum avg_weather_risk",
    ),
    "comprehensive_simple": ("comprehensive_short", ["analysis_area_label"], comprehensive_short, ""),
}.items():
    query(f"metrics_of_{_model}", _measures_sql(_model, _step, _by, _doubles), _doubles)(
        lambda spark, d, model=_model, by=_by, build=_build: M.model_metrics(
            build(spark, d), model, by
        )
    )


@query(
    "metric_entity_join",
    """select country, total_sightings, years_of_data from (
      select country, cast(sum(total_sightings) as bigint) as total_sightings,
        max(years_of_data) as years_of_data
      from dashboard where country is not null group by 1)""",
)
def _(spark, d):
    table = durable(dashboard(spark, d))
    return M.metrics_by_entity("country", {"total_sightings": table, "years_of_data": table})


@query(
    "metric_entity_join_models",
    """select coalesce(a.region, b.region) as region, total_sightings, metric_value from (
      select region, cast(sum(total_sightings) as bigint) as total_sightings from dashboard
        where region is not null group by 1) a
      full outer join (select location_context as region, sum(metric_value) as metric_value
        from comprehensive where location_context is not null group by 1) b on a.region = b.region""",
    "metric_value",
)
def _(spark, d):
    # Both models are built on the same numbered sightings, which are stored once.
    named = cleaned(spark, d)
    counted = durable(S.sighting_cube(enriched(spark, d, named)))
    return M.metrics_by_entity(
        "region",
        {
            "total_sightings": S.dashboard_summary(counted, AS_OF),
            "metric_value": comprehensive(spark, d, named),
        },
    )


# ---- declared order -------------------------------------------------------------------------


def _position_sql(model: str, columns: list[str], doubles: list[str]) -> str:
    """Positions over values rounded like those of the query, nulls as the largest values."""
    keys = [
        f"{c[1:]} desc nulls first" if c.startswith("-") else f"{c} nulls last"
        for c in [*ORDERS[model].split(), *columns]
    ]
    shown = ", ".join(f"round({c}, 6) as {c}" if c in doubles else c for c in columns)
    step = {**_STEPS_OF, **_MORE_STEPS}[model]
    return (
        f"select *, row_number() over (order by {', '.join(keys)}) as position "
        f"from (select {shown} from {step})"
    )


_MORE_STEPS = {
    "debunking_simple": "debunking_short",
    "route_volume": "route_report",
    "traffic_patterns": "traffic_report",
    "comprehensive_simple": "comprehensive_short",
}
for _model, _columns, _doubles in (
    ("debunking_analysis", "analysis_type record_id event_date location suspicion_level explanation "
     "days_to_incident correlation_score summary_metric", "days_to_incident summary_metric"),
    ("debunking_simple", "sighting_id max_correlation_score closest_crash_days", ""),
    ("route_volume", "departure_city arrival_city flight_route total_route_flights", ""),
    ("traffic_patterns", "analysis_type category_name subcategory flight_count", ""),
    ("comprehensive_summary", "data_type category subject metric_value narrative location_context "
     "date_context metric_percentage metric_aux", "metric_value metric_percentage metric_aux"),
    ("comprehensive_simple", "analysis_area metric_name metric_value", ""),
    ("by_country_time", "country region time_grain period_date total_sightings", ""),
    ("top_locations", "location_type global_rank country region state city", ""),
    ("weather_safety", "analysis_type risk_score crash_count category subcategory location time_period",
     "risk_score"),
    ("dashboard_summary", "metric_type time_period total_sightings country region", ""),
):
    query(
        f"ordered_{_model}", _position_sql(_model, _columns.split(), _doubles.split())
    )(
        lambda spark, d, model=_model, columns=_columns.split(): ordered(
            model, QUERIES[model](spark, d).select(*columns)
        )
    )
