"""Cleaning jobs: raw tables to typed, classified tables. All narrow except where noted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions import columns as X
from sightline.functions import fixed_values as V
from sightline.operators.joins import bucket_join, many_tasks
from sightline.operators.ranking import first_per_group, global_row_number, repeat_rows

UNKNOWN = "UNKNOWN"


def classify(df: DataFrame, out: str, steps, default=None) -> DataFrame:
    """Add a label column from ordered (condition, label) steps."""
    return df.withColumn(out, X.ladder(steps, default))


def label_distribution(df: DataFrame, out: str) -> DataFrame:
    return df.groupBy(out).agg(F.count("*").alias("rows"))


def coerce_report(df: DataFrame, col: str, fallback: str | None = None) -> DataFrame:
    """How many rows each timestamp rule reads."""
    rule = X.timestamp_rule_name(F.col(col), F.col(fallback) if fallback else None)
    return df.groupBy(rule.alias("rule")).agg(F.count("*").alias("rows"))


def split_duration(sightings: DataFrame) -> DataFrame:
    seconds = X.parse_number(F.col("duration_seconds"))
    return sightings.select(
        "datetime",
        "city",
        "state",
        "country",
        "shape",
        F.col("duration_seconds").alias("duration"),
        F.floor(seconds / 3600).alias("duration_hours"),
        F.floor((seconds % 3600) / 60).alias("duration_minutes"),
        "comments",
        "latitude",
        "longitude",
    )


def coordinate_lookup(coordinates: DataFrame) -> DataFrame:
    """One (country, state) per coordinate bucket; a known state wins, then the country name.

    A row that names a state counts only for that state, never for the country beside it.
    """
    named = F.trim(F.coalesce("usa_state", F.lit(""))) != ""
    rows = coordinates.select(
        X.bucket(F.when(named, F.col("usa_state_latitude")).otherwise(F.col("latitude"))).alias(
            "lat_bucket"
        ),
        X.bucket(F.when(named, F.col("usa_state_longitude")).otherwise(F.col("longitude"))).alias(
            "lon_bucket"
        ),
        F.when(named, F.lit(V.STATE_COUNTRY)).otherwise(F.col("country")).alias("coord_country"),
        F.when(named, F.col("usa_state")).alias("coord_usa_state"),
        F.when(named, F.lit(V.STATE_COUNTRY_CODE))
        .otherwise(F.col("country_code"))
        .alias("country_code"),
    )
    preference = [
        F.col("coord_usa_state").isNull().asc(),
        F.col("coord_country").asc_nulls_last(),
        F.col("coord_usa_state").asc_nulls_last(),
        F.col("country_code").asc_nulls_last(),
    ]
    return first_per_group(rows, ["lat_bucket", "lon_bucket"], preference)


def raw_coordinate_pairs(coordinates: DataFrame) -> DataFrame:
    """Undeduplicated form: the country's bucket with whatever state stands on the same row.

    Rows that look the same are one row, and `coordinate_rows` says how many they are.
    """
    return coordinates.groupBy(
        X.bucket(F.col("latitude")).alias("lat_bucket"),
        X.bucket(F.col("longitude")).alias("lon_bucket"),
        F.col("country").alias("coord_country"),
        F.col("usa_state").alias("coord_usa_state"),
    ).agg(F.count("*").alias("coordinate_rows"))


def clean_sightings(
    sightings: DataFrame,
    coordinates: DataFrame,
    dedupe_coordinates: bool = True,
    extra=(),
    expand: bool = True,
) -> DataFrame:
    """Typed sightings with day, buckets and country/state filled in from coordinates.

    `extra` names source columns to carry along, such as a natural key. Without deduplication a
    sighting stands once per matching coordinate row; `expand=False` leaves matches that look
    the same as one row, with their number in `coordinate_rows`.
    """
    stamp = X.coerce_timestamp(F.col("datetime"), F.col("date_posted"))
    typed = sightings.select(
        stamp.alias("event_datetime"),
        *[X.blank_to_null(F.col(c)).alias(c) for c in ("city", "state", "country", "shape")],
        X.parse_number(F.col("duration_seconds")).alias("duration_seconds"),
        X.blank_to_null(F.col("duration_hours_min")).alias("duration_hours_min"),
        X.blank_to_null(F.col("comments")).alias("comments"),
        "date_posted",
        X.parse_number(F.col("latitude")).alias("latitude"),
        X.parse_number(F.col("longitude")).alias("longitude"),
        *extra,
    ).withColumn("event_date", X.day_of(F.col("event_datetime")))
    if dedupe_coordinates:
        lookup = coordinate_lookup(coordinates).drop("country_code")
    else:
        lookup = raw_coordinate_pairs(coordinates)
        # Dealt out evenly, and apart from the wide cleaning step: fused with it, the code that writes the
        # matches would be too long to be compiled.
        typed = typed.repartition(many_tasks(typed))
    found = bucket_join(typed, lookup, "latitude", "longitude", keep_buckets=True)
    rows = F.coalesce("coordinate_rows", F.lit(1).cast("long")).alias("coordinate_rows")
    out = found.select(
        X.surrogate_key(
            X.stamp_text(F.col("event_date")),
            X.bucket_text(F.col("lat_bucket")),
            X.bucket_text(F.col("lon_bucket")),
        ).alias("geo_day_key"),
        "event_datetime",
        "event_date",
        "city",
        F.coalesce("state", X.blank_to_null(F.col("coord_usa_state"))).alias("state"),
        F.coalesce("country", X.blank_to_null(F.col("coord_country"))).alias("country"),
        "shape",
        "duration_seconds",
        "duration_hours_min",
        "comments",
        "date_posted",
        "latitude",
        "longitude",
        *extra,
        *([] if dedupe_coordinates else [rows]),
    )
    if dedupe_coordinates or not expand:
        return out
    return repeat_rows(out, "coordinate_rows")


def standardize_sightings(cleaned: DataFrame, id_col: str | None = None) -> DataFrame:
    """Country synonyms, categories, flags and `sighting_id`.

    Without `id_col` the id is a hash plus the position in one global order (a range sort and
    one written table); the input is then read three times and should be a stored table. A source with a natural key should name it: the id is then the hash
    plus that key and the job has no shuffle at all.
    """
    country = F.trim(F.upper("country"))
    shape = F.trim(F.upper("shape"))
    seconds = F.col("duration_seconds")
    day = F.col("event_date")
    comments = F.trim("comments")
    out = cleaned.filter(F.col("event_datetime").isNotNull()).select(
        F.col("event_datetime").alias("sighting_datetime"),
        day.alias("sighting_date"),
        F.year(day).alias("sighting_year"),
        F.month(day).alias("sighting_month"),
        (F.dayofweek(day) - 1).alias("sighting_day_of_week"),
        F.quarter(day).alias("sighting_quarter"),
        *[X.upper_trim(F.col(c), UNKNOWN).alias(f"{c}_clean") for c in ("city", "state", "country")],
        F.when(F.coalesce(country, F.lit("")) == "", UNKNOWN)
        .otherwise(X.by_members(country, V.COUNTRY_SYNONYMS, country))
        .alias("country_standardized"),
        F.when(F.coalesce(shape, F.lit("")) == "", UNKNOWN).otherwise(shape).alias("shape_clean"),
        seconds.alias("duration_seconds_clean"),
        X.upto(seconds, V.SIGHTING_BANDS, V.SIGHTING_ABOVE, UNKNOWN).alias("duration_category"),
        F.col("duration_hours_min").alias("duration_hours"),
        F.lit(None).cast("int").alias("duration_minutes"),
        F.col("latitude").alias("latitude_clean"),
        F.col("longitude").alias("longitude_clean"),
        X.blank_to_null(comments).alias("comments_clean"),
        F.col("event_datetime").isNotNull().alias("has_valid_datetime"),
        (F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).alias(
            "has_valid_coordinates"
        ),
        X.flag(country != "").alias("has_country_data"),
        "geo_day_key",
        *([id_col] if id_col else []),
    )
    identity = X.surrogate_key(
        X.stamp_text(F.col("sighting_datetime")),
        *[F.col(c) for c in ("city_clean", "state_clean", "country_clean", "shape_clean")],
        sep="|",
    )
    if id_col:
        suffix = X.sequence_suffix(F.col(id_col))
        return out.withColumn("sighting_id", F.concat(identity, F.lit("_"), suffix)).drop(id_col)
    order = ["sighting_datetime", "country_clean", "state_clean", "city_clean"]
    numbered = global_row_number(
        out, [F.col(c).asc_nulls_last() for c in order], "sequence", stored=True, alike=order
    )
    suffix = X.sequence_suffix(F.col("sequence"))
    return numbered.withColumn("sighting_id", F.concat(identity, F.lit("_"), suffix)).drop(
        "sequence"
    )


def thin_weather(weather: DataFrame) -> DataFrame:
    return weather.filter(F.col("formatted_date").isNotNull()).select(
        F.col("formatted_date").alias("event_datetime"),
        X.day_of(F.col("formatted_date")).alias("event_date"),
        "summary",
        "precip_type",
        "temperature_c",
        "apparent_temperature_c",
        "humidity",
        "wind_speed_km",
        "wind_bearing_degrees",
        "visibility_km",
        "pressure_millibars",
        "daily_summary",
    )


def clean_weather(weather: DataFrame) -> DataFrame:
    ts = F.col("formatted_date")
    humidity = F.col("humidity")
    return weather.filter(ts.isNotNull()).select(
        ts.alias("observation_datetime"),
        F.to_date(ts).alias("observation_date"),
        F.year(ts).alias("observation_year"),
        F.month(ts).alias("observation_month"),
        F.dayofmonth(ts).alias("observation_day"),
        F.hour(ts).alias("observation_hour"),
        X.upper_trim(F.col("summary"), UNKNOWN).alias("weather_summary"),
        X.upper_trim(F.col("precip_type"), "NONE").alias("precipitation_type"),
        X.upper_trim(F.col("daily_summary"), "").alias("daily_summary_clean"),
        X.in_range(F.col("temperature_c"), *V.TEMPERATURE_LIMITS).alias("temperature_celsius"),
        X.in_range(F.col("apparent_temperature_c"), *V.TEMPERATURE_LIMITS).alias(
            "apparent_temperature_celsius"
        ),
        F.when(humidity.between(0, 1), humidity * 100)
        .when(humidity.between(0, 100), humidity)
        .alias("humidity_percent"),
        X.in_range(F.col("wind_speed_km"), *V.WIND_LIMITS).alias("wind_speed_kmh"),
        X.in_range(F.col("wind_bearing_degrees"), *V.BEARING_LIMITS).alias("wind_bearing"),
        X.in_range(F.col("visibility_km"), *V.VISIBILITY_LIMITS).alias("visibility_km_clean"),
        X.in_range(F.col("loud_cover"), *V.COVER_LIMITS).alias("cloud_cover_percent"),
        X.in_range(F.col("pressure_millibars"), *V.PRESSURE_LIMITS).alias("pressure_mb"),
        X.by_words(F.col("summary"), V.WEATHER_WORDS, "OTHER").alias("weather_category"),
        X.atleast(
            F.col("visibility_km"), V.VISIBILITY_FLOORS, V.VISIBILITY_BELOW, UNKNOWN
        ).alias("visibility_category"),
        X.upto(F.col("wind_speed_km"), V.WIND_BANDS, V.WIND_ABOVE, UNKNOWN, strict=True).alias(
            "wind_category"
        ),
        ts.isNotNull().alias("has_valid_datetime"),
        X.flag(F.col("visibility_km") >= 0).alias("has_visibility_data"),
        X.flag(F.col("wind_speed_km") >= 0).alias("has_wind_data"),
    )


def clean_crashes(crashes: DataFrame) -> DataFrame:
    day = X.parse_date(F.trim("date"))
    aboard, fatalities = F.col("aboard"), F.col("fatalities")
    counted = (aboard > 0) & (fatalities >= 0)
    place = F.col("location")
    return crashes.withColumn("crash_date", day).select(
        "crash_date",
        F.year("crash_date").alias("crash_year"),
        F.month("crash_date").alias("crash_month"),
        F.dayofmonth("crash_date").alias("crash_day"),
        (F.dayofweek("crash_date") - 1).alias("crash_day_of_week"),
        F.when(~F.col("time").isin("", "c: "), F.trim("time")).alias("crash_time_raw"),
        F.trim(F.coalesce(place, F.lit(UNKNOWN))).alias("crash_location"),
        F.when(place.contains(", "), F.trim(F.substring_index(place, ",", -1)))
        .otherwise(UNKNOWN)
        .alias("crash_country"),
        X.upper_trim(F.col("operator"), UNKNOWN).alias("airline_operator"),
        F.trim(F.coalesce("flight_number", F.lit(""))).alias("flight_number_clean"),
        F.trim(F.coalesce("route", F.lit(""))).alias("flight_route"),
        X.upper_trim(F.col("type"), UNKNOWN).alias("aircraft_type"),
        X.upper_trim(F.col("registration"), "").alias("aircraft_registration"),
        F.trim(F.coalesce("cn_ln", F.lit(""))).alias("construction_number"),
        F.when(aboard >= 0, aboard).alias("people_aboard"),
        F.when(fatalities >= 0, fatalities).alias("total_fatalities"),
        F.when(F.col("ground") >= 0, F.col("ground")).alias("ground_fatalities"),
        F.when(counted, aboard - fatalities).alias("survivors"),
        F.when(counted, F.round(fatalities * F.lit(100.0) / aboard, 2)).alias(
            "fatality_rate_percent"
        ),
        F.when(F.col("summary") != "", F.trim("summary")).alias("crash_summary"),
        X.by_words(F.col("type"), V.MANUFACTURER_WORDS, "OTHER").alias("aircraft_manufacturer"),
        X.by_words(
            F.col("operator"),
            V.OPERATOR_WORDS,
            F.when(F.col("operator") != UNKNOWN, "COMMERCIAL").otherwise(UNKNOWN),
        ).alias("operator_type"),
        X.within(fatalities, V.CASUALTY_RANGES, UNKNOWN, above=V.CASUALTY_ABOVE).alias(
            "casualty_severity"
        ),
        X.upto(F.year("crash_date"), V.ERA_BANDS, V.ERA_ABOVE, UNKNOWN, strict=True).alias(
            "aviation_era"
        ),
        F.col("crash_date").isNotNull().alias("has_valid_date"),
        X.flag(aboard > 0).alias("has_casualty_data"),
        X.flag(place != "").alias("has_location_data"),
    )


def thin_crashes(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        X.surrogate_key(F.col("crash_date"), F.col("crash_location")).alias("location_day_key"),
        F.col("crash_date").alias("event_date"),
        F.col("crash_time_raw").alias("time_col"),
        F.col("crash_location").alias("location"),
        F.col("airline_operator").alias("operator"),
        F.col("people_aboard").alias("aboard"),
        F.col("total_fatalities").alias("fatalities"),
        F.col("ground_fatalities").alias("ground"),
        F.col("crash_summary").alias("summary"),
        "has_valid_date",
    )


def stops_number(c):
    """Stop words or digits to a count; anything else is zero."""
    words = {w: n for n, w in enumerate(V.STOP_WORDS)}
    number = X.try_whole(F.trim(c))
    steps = [(F.upper(F.trim(c)) == w, n) for w, n in words.items()]
    return X.ladder(steps, F.greatest(F.coalesce(number, F.lit(0)), F.lit(0)))


def clock_time(c):
    """`HH:mm:ss` text of a valid time of day, else null."""
    hm = r"^([01]?\d|2[0-3]):([0-5]\d)(?::([0-5]\d))?$"
    text = F.trim(c)
    # One match tells that the text is valid; after that its parts are known by their places.
    wide = F.when(F.instr(text, ":") == 2, F.concat(F.lit("0"), text)).otherwise(text)
    seconds = F.when(F.substring(wide, 6, 1) == ":", F.substring(wide, 6, 3)).otherwise(":00")
    return F.when(text.rlike(hm), F.concat(F.substring(wide, 1, 5), seconds))


def clean_flights(flights: DataFrame) -> DataFrame:
    departure = F.col("departure_time")
    # The daytime label also reads a bare hour without a colon; the hour column does not. The hour is a column
    # of its own, or each limit of the label would read it from the text again.
    label_hour = F.col("__hour")
    hour = F.when(departure.contains(":"), label_hour)
    duration, price, lead = F.col("duration"), F.col("price"), F.col("days_left")
    start = X.upper_trim(F.col("source_city"), UNKNOWN)
    end = X.upper_trim(F.col("destination_city"), UNKNOWN)
    stops = F.col("number_of_stops")
    return (
        flights.filter(F.col("airline").isNotNull())
        .withColumns(
            {
                "number_of_stops": stops_number(F.col("stops")),
                "__hour": X.try_whole(F.substring_index(departure, ":", 1)),
            }
        )
        .select(
            F.col("index").alias("flight_record_id"),
            X.upper_trim(F.col("airline"), UNKNOWN).alias("airline_name"),
            X.upper_trim(F.col("flight"), "").alias("flight_number"),
            start.alias("departure_city"),
            end.alias("arrival_city"),
            F.concat(start, F.lit(" -> "), end).alias("flight_route"),
            departure.alias("departure_time_raw"),
            F.col("arrival_time").alias("arrival_time_raw"),
            clock_time(departure).alias("departure_time_parsed"),
            clock_time(F.col("arrival_time")).alias("arrival_time_parsed"),
            hour.alias("departure_hour"),
            stops,
            X.ladder(
                [(stops == 0, "NONSTOP"), (stops == 1, "ONE_STOP"), (stops >= 2, "MULTIPLE_STOPS")],
                UNKNOWN,
            ).alias("stop_category"),
            F.when((duration > 0) & (duration <= 24), duration).alias("flight_duration_hours"),
            X.upto(duration, V.DURATION_BANDS, V.DURATION_ABOVE, UNKNOWN).alias(
                "flight_duration_category"
            ),
            X.upper_trim(F.col("class"), UNKNOWN).alias("travel_class"),
            X.by_words(F.col("class"), V.CLASS_WORDS, UNKNOWN).alias("travel_class_category"),
            F.when(lead >= 0, lead).alias("booking_lead_days"),
            X.upto(lead, V.LEAD_BANDS, V.LEAD_ABOVE, UNKNOWN).alias("booking_timing_category"),
            F.when(price > 0, price).alias("ticket_price"),
            X.upto(price, V.PRICE_BANDS, V.PRICE_ABOVE, UNKNOWN).alias("price_category"),
            X.within(label_hour, V.DAYTIME_RANGES, UNKNOWN).alias("departure_time_of_day"),
            X.by_words(F.col("airline"), V.AIRLINE_WORDS, "OTHER").alias("airline_region"),
            X.flag(departure != "").alias("has_departure_time"),
            X.flag(F.col("arrival_time") != "").alias("has_arrival_time"),
            X.flag(duration > 0).alias("has_valid_duration"),
            X.flag(price > 0).alias("has_pricing_data"),
            (
                X.flag(F.col("source_city") != "") & X.flag(F.col("destination_city") != "")
            ).alias("has_complete_route"),
        )
    )
