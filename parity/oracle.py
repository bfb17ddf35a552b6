"""The same results as plain SQL for DuckDB, written as naive joins and group-bys.

Each named step is a query over other steps; `statement` puts the ones a result needs into a
WITH clause. Limits and labels come from the same fixed values as the jobs; the boundaries
themselves are pinned by the unit tests.
"""

from __future__ import annotations

import re

from parity.standins import STATEMENTS, raw_sql
from sightline.functions import fixed_values as V

AS_OF = "2001-08-01"


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def bands(c: str, limits, above: str, default: str | None = None, op: str = "<=") -> str:
    last = f"{c} {'>' if op == '<=' else '>='} {limits[-1][0]}"
    whens = [f"when {c} {op} {n} then {text(label)}" for n, label in limits]
    return f"case {' '.join(whens)} when {last} then {text(above)} else {_default(default)} end"


def floors(c: str, limits, below: str, default: str | None = None) -> str:
    whens = " ".join(f"when {c} >= {n} then {text(label)}" for n, label in limits)
    if default is None:
        return f"case {whens} else {text(below)} end"
    return f"case {whens} when {c} is not null then {text(below)} else {text(default)} end"


def _default(default: str | None) -> str:
    return "null" if default is None else text(default)


def any_word(c: str, words) -> str:
    return "(" + " or ".join(f"upper({c}) like '%{w}%'" for w in words) + ")"


def families(c: str, groups, default: str) -> str:
    whens = " ".join(f"when {any_word(c, words)} then {text(label)}" for label, words in groups)
    return f"case {whens} else {default} end"


def members(c: str, groups: dict, default: str) -> str:
    whens = " ".join(
        f"when {c} in ({', '.join(map(text, values))}) then {text(label)}"
        for label, values in groups.items()
    )
    return f"case {whens} else {default} end"


def limited(c: str, limits) -> str:
    return f"case when {c} between {limits[0]} and {limits[1]} then {c} end"


def pct(num: str, den: str) -> str:
    return f"round({num} * 100.0e0 / nullif(cast({den} as double), 0), 2)"


def number(c: str) -> str:
    return f"case when regexp_matches({c}, '^[+-]?[0-9]+(\\.[0-9]+)?$') then cast({c} as double) end"


def listed(c: str, values) -> str:
    return f"{c} in ({', '.join(map(text, values))})"


def day_text(c: str) -> str:
    """`M/d/yyyy [H:mm]` or `yyyy-M-d`."""
    return (
        f"coalesce(try_strptime({c}, '%m/%d/%Y %H:%M'), try_strptime({c}, '%m/%d/%Y'), "
        f"case when regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') "
        f"then try_cast({c} as timestamp) end)"
    )


def millis(c: str) -> str:
    return (
        f"timestamp '1970-01-01' + to_seconds(cast(floor(try_cast({c} as double) / 1000) as bigint))"
    )


COERCED = f"""coalesce({day_text('datetime')},
  case when try_cast(datetime as double) > 10000000000 then {millis('datetime')} end,
  case when regexp_matches(datetime, '^[0-9]{{10,13}}$') then {millis('datetime')} end,
  {day_text('date_posted')})"""

STEPS: dict[str, str] = {f"raw_{name}": raw_sql(name) for name in STATEMENTS}

STEPS["lookup"] = f"""
select lat_bucket, lon_bucket, coord_country, coord_usa_state, country_code from (
  select round(case when named then usa_state_latitude else latitude end, 1) as lat_bucket,
    round(case when named then usa_state_longitude else longitude end, 1) as lon_bucket,
    case when named then {text(V.STATE_COUNTRY)} else country end as coord_country,
    case when named then usa_state end as coord_usa_state,
    case when named then {text(V.STATE_COUNTRY_CODE)} else country_code end as country_code
  from (select *, coalesce(trim(usa_state), '') <> '' as named from raw_coordinates))
qualify row_number() over (partition by lat_bucket, lon_bucket order by
  coord_usa_state is null, coord_country nulls last, coord_usa_state nulls last,
  country_code nulls last) = 1"""

STEPS["typed"] = f"""
select {COERCED} as event_datetime,
  nullif(city, '') as city, nullif(state, '') as state, nullif(country, '') as country,
  nullif(shape, '') as shape, {number('duration_seconds')} as duration_seconds,
  nullif(duration_hours_min, '') as duration_hours_min, nullif(comments, '') as comments,
  date_posted, {number('latitude')} as latitude, {number('longitude')} as longitude, sight_key
from raw_sightings"""

STEPS["sightings"] = """
select md5(coalesce(strftime(date_trunc('day', event_datetime), '%Y-%m-%d %H:%M:%S'), '') || '-' ||
    coalesce(cast(cast(round(latitude, 1) as decimal(18, 1)) as varchar), '') || '-' ||
    coalesce(cast(cast(round(longitude, 1) as decimal(18, 1)) as varchar), '')) as geo_day_key,
  event_datetime, cast(date_trunc('day', event_datetime) as timestamp) as event_date, city,
  coalesce(state, nullif(coord_usa_state, '')) as state,
  coalesce(country, nullif(coord_country, '')) as country,
  shape, duration_seconds, duration_hours_min, comments, date_posted, latitude, longitude, sight_key
from typed left join lookup
  on round(latitude, 1) = lat_bucket and round(longitude, 1) = lon_bucket"""

_IDENTITY = (
    "md5(concat_ws('|', strftime(sighting_datetime, '%Y-%m-%d %H:%M:%S'), city_clean, state_clean, "
    "country_clean, shape_clean))"
)

STEPS["cleaned"] = f"""
select event_datetime as sighting_datetime, event_date as sighting_date,
  cast(year(event_date) as int) as sighting_year, cast(month(event_date) as int) as sighting_month,
  cast(dayofweek(event_date) as int) as sighting_day_of_week,
  cast(quarter(event_date) as int) as sighting_quarter,
  trim(upper(coalesce(city, 'UNKNOWN'))) as city_clean,
  trim(upper(coalesce(state, 'UNKNOWN'))) as state_clean,
  trim(upper(coalesce(country, 'UNKNOWN'))) as country_clean,
  case when coalesce(trim(country), '') = '' then 'UNKNOWN'
    else {members('trim(upper(country))', V.COUNTRY_SYNONYMS, 'trim(upper(country))')}
    end as country_standardized,
  case when coalesce(trim(shape), '') = '' then 'UNKNOWN' else trim(upper(shape)) end as shape_clean,
  duration_seconds as duration_seconds_clean,
  {bands('duration_seconds', V.SIGHTING_BANDS, V.SIGHTING_ABOVE, 'UNKNOWN')} as duration_category,
  duration_hours_min as duration_hours, cast(null as int) as duration_minutes,
  latitude as latitude_clean, longitude as longitude_clean,
  nullif(trim(comments), '') as comments_clean,
  true as has_valid_datetime,
  latitude is not null and longitude is not null as has_valid_coordinates,
  coalesce(trim(country) <> '', false) as has_country_data, geo_day_key, sight_key
from sightings where event_datetime is not null"""

STEPS["cleaned_keyed"] = f"""
select * exclude (sight_key),
  {_IDENTITY} || '_' || lpad(cast(sight_key as varchar),
    greatest(6, length(cast(sight_key as varchar)))::int, '0') as sighting_id
from cleaned"""

_TIES = (
    "sighting_datetime, country_clean, state_clean, city_clean, sighting_date, shape_clean, "
    "country_standardized, duration_seconds_clean nulls last, duration_hours nulls last, "
    "latitude_clean nulls last, longitude_clean nulls last, comments_clean nulls last"
)
STEPS["cleaned_numbered"] = f"""
select * exclude (sight_key, n), {_IDENTITY} || '_' || lpad(cast(n as varchar),
    greatest(6, length(cast(n as varchar)))::int, '0') as sighting_id
from (select *, row_number() over (order by {_TIES}) as n from cleaned)"""

STEPS["enriched"] = f"""
select c.*, l.coord_country as coord_lookup_country, l.coord_usa_state as coord_lookup_state,
  s.city_sighting_count, s.city_first_sighting, s.city_last_sighting, s.city_avg_latitude,
  s.city_avg_longitude,
  {floors('s.city_sighting_count', V.CITY_FLOORS, V.CITY_BELOW)} as city_activity_level,
  case when c.country_standardized = 'UNITED STATES' then
    {members('c.state_clean', V.STATE_REGIONS,
             text(V.STATE_REGION_ELSE))}
    else {members('c.country_standardized', V.COUNTRY_REGIONS, text(V.COUNTRY_REGION_ELSE))}
    end as region
from cleaned_numbered c
left join (
  select country_standardized, state_clean, city_clean, count(*) as city_sighting_count,
    min(sighting_date) as city_first_sighting, max(sighting_date) as city_last_sighting,
    avg(latitude_clean) as city_avg_latitude, avg(longitude_clean) as city_avg_longitude
  from cleaned_numbered where has_valid_datetime group by 1, 2, 3) s
  using (country_standardized, state_clean, city_clean)
left join lookup l
  on round(c.latitude_clean, 1) = l.lat_bucket and round(c.longitude_clean, 1) = l.lon_bucket"""

_CRASH_DAY = (
    f"coalesce({day_text('trim(date)')}, case when regexp_matches(trim(date), "
    "'^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}$') then try_strptime(trim(date), '%d-%b-%Y') end)"
)
STEPS["crashes"] = f"""
select crash_date, cast(year(crash_date) as int) as crash_year,
  cast(month(crash_date) as int) as crash_month, cast(day(crash_date) as int) as crash_day,
  cast(dayofweek(crash_date) as int) as crash_day_of_week,
  case when time not in ('', 'c: ') then trim(time) end as crash_time_raw,
  trim(coalesce(location, 'UNKNOWN')) as crash_location,
  case when location like '%, %' then trim(split_part(location, ',', -1)) else 'UNKNOWN'
    end as crash_country,
  trim(upper(coalesce(operator, 'UNKNOWN'))) as airline_operator,
  trim(coalesce(flight_number, '')) as flight_number_clean, trim(coalesce(route, '')) as flight_route,
  trim(upper(coalesce(type, 'UNKNOWN'))) as aircraft_type,
  trim(upper(coalesce(registration, ''))) as aircraft_registration,
  trim(coalesce(cn_ln, '')) as construction_number,
  case when aboard >= 0 then aboard end as people_aboard,
  case when fatalities >= 0 then fatalities end as total_fatalities,
  case when ground >= 0 then ground end as ground_fatalities,
  case when aboard > 0 and fatalities >= 0 then aboard - fatalities end as survivors,
  case when aboard > 0 and fatalities >= 0 then round(fatalities * 100.0e0 / aboard, 2)
    end as fatality_rate_percent,
  case when summary <> '' then trim(summary) end as crash_summary,
  {families('type', V.MANUFACTURER_WORDS, text('OTHER'))} as aircraft_manufacturer,
  {families('operator', V.OPERATOR_WORDS,
            "case when operator <> 'UNKNOWN' then 'COMMERCIAL' else 'UNKNOWN' end")} as operator_type,
  case {' '.join(f"when fatalities between {a} and {b} then {text(x)}"
                 for a, b, x in V.CASUALTY_RANGES)}
    when fatalities > {V.CASUALTY_ABOVE[0]} then {text(V.CASUALTY_ABOVE[1])} else 'UNKNOWN'
    end as casualty_severity,
  {bands('year(crash_date)', V.ERA_BANDS, V.ERA_ABOVE, 'UNKNOWN', '<')} as aviation_era,
  crash_date is not null as has_valid_date, coalesce(aboard > 0, false) as has_casualty_data,
  coalesce(location <> '', false) as has_location_data
from (select *, cast({_CRASH_DAY} as date) as crash_date from raw_crashes)"""

STEPS["thin_crashes"] = """
select md5(coalesce(cast(crash_date as varchar), '') || '-' || crash_location) as location_day_key,
  crash_date as event_date, crash_time_raw as time_col, crash_location as location,
  airline_operator as operator, people_aboard as aboard, total_fatalities as fatalities,
  ground_fatalities as ground, crash_summary as summary, has_valid_date
from crashes"""

STEPS["thin_weather"] = """
select formatted_date as event_datetime,
  cast(date_trunc('day', formatted_date) as timestamp) as event_date,
  summary, precip_type, temperature_c, apparent_temperature_c, humidity, wind_speed_km,
  wind_bearing_degrees, visibility_km, pressure_millibars, daily_summary
from raw_weather where formatted_date is not null"""

STEPS["weather"] = f"""
select formatted_date as observation_datetime, cast(formatted_date as date) as observation_date,
  cast(year(formatted_date) as int) as observation_year,
  cast(month(formatted_date) as int) as observation_month,
  cast(day(formatted_date) as int) as observation_day,
  cast(hour(formatted_date) as int) as observation_hour,
  trim(upper(coalesce(summary, 'UNKNOWN'))) as weather_summary,
  trim(upper(coalesce(precip_type, 'NONE'))) as precipitation_type,
  trim(upper(coalesce(daily_summary, ''))) as daily_summary_clean,
  {limited('temperature_c', V.TEMPERATURE_LIMITS)} as temperature_celsius,
  {limited('apparent_temperature_c', V.TEMPERATURE_LIMITS)} as apparent_temperature_celsius,
  case when humidity between 0 and 1 then humidity * 100 when humidity between 0 and 100
    then humidity end as humidity_percent,
  {limited('wind_speed_km', V.WIND_LIMITS)} as wind_speed_kmh,
  {limited('wind_bearing_degrees', V.BEARING_LIMITS)} as wind_bearing,
  {limited('visibility_km', V.VISIBILITY_LIMITS)} as visibility_km_clean,
  {limited('loud_cover', V.COVER_LIMITS)} as cloud_cover_percent,
  {limited('pressure_millibars', V.PRESSURE_LIMITS)} as pressure_mb,
  {families('summary', V.WEATHER_WORDS, text('OTHER'))} as weather_category,
  {floors('visibility_km', V.VISIBILITY_FLOORS, V.VISIBILITY_BELOW, 'UNKNOWN')}
    as visibility_category,
  {bands('wind_speed_km', V.WIND_BANDS, V.WIND_ABOVE, 'UNKNOWN', '<')} as wind_category,
  true as has_valid_datetime, coalesce(visibility_km >= 0, false) as has_visibility_data,
  coalesce(wind_speed_km >= 0, false) as has_wind_data
from raw_weather where formatted_date is not null"""

_HOUR = "try_cast(split_part(departure_time, ':', 1) as int)"
STEPS["flights"] = f"""
select index as flight_record_id, trim(upper(airline)) as airline_name,
  trim(upper(coalesce(flight, ''))) as flight_number, departure_city, arrival_city,
  departure_city || ' -> ' || arrival_city as flight_route,
  departure_time as departure_time_raw, arrival_time as arrival_time_raw,
  strftime(try_strptime(departure_time, '%H:%M'), '%H:%M:%S') as departure_time_parsed,
  strftime(try_strptime(arrival_time, '%H:%M'), '%H:%M:%S') as arrival_time_parsed,
  case when departure_time like '%:%' then {_HOUR} end as departure_hour, number_of_stops,
  case when number_of_stops = 0 then 'NONSTOP' when number_of_stops = 1 then 'ONE_STOP'
    else 'MULTIPLE_STOPS' end as stop_category,
  case when duration > 0 and duration <= 24 then duration end as flight_duration_hours,
  {bands('duration', V.DURATION_BANDS, V.DURATION_ABOVE, 'UNKNOWN')} as flight_duration_category,
  trim(upper(coalesce(class, 'UNKNOWN'))) as travel_class,
  {families('class', V.CLASS_WORDS, text('UNKNOWN'))} as travel_class_category,
  case when days_left >= 0 then days_left end as booking_lead_days,
  {bands('days_left', V.LEAD_BANDS, V.LEAD_ABOVE, 'UNKNOWN')} as booking_timing_category,
  case when price > 0 then price end as ticket_price,
  {bands('price', V.PRICE_BANDS, V.PRICE_ABOVE, 'UNKNOWN')} as price_category,
  case {' '.join(f"when {_HOUR} between {a} and {b} then {text(x)}"
                 for a, b, x in V.DAYTIME_RANGES)} else 'UNKNOWN' end as departure_time_of_day,
  {families('airline', V.AIRLINE_WORDS, text('OTHER'))} as airline_region,
  coalesce(departure_time <> '', false) as has_departure_time,
  coalesce(arrival_time <> '', false) as has_arrival_time,
  coalesce(duration > 0, false) as has_valid_duration, coalesce(price > 0, false) as has_pricing_data,
  coalesce(source_city <> '' and destination_city <> '', false) as has_complete_route
from (
  select *, trim(upper(coalesce(source_city, 'UNKNOWN'))) as departure_city,
    trim(upper(coalesce(destination_city, 'UNKNOWN'))) as arrival_city,
    coalesce(cast(list_position({V.STOP_WORDS}, upper(trim(stops))) - 1 as int),
      case when try_cast(trim(stops) as int) >= 0 then try_cast(trim(stops) as int) end, 0)
      as number_of_stops
  from raw_flights where airline is not null)"""

_MEDIA = " ".join(f"when total_fatalities > {n} then {text(x)}" for n, x in V.MEDIA_LABELS)
STEPS["crash_listing"] = f"""
select crash_country as listed_as, * from crashes
  where crash_date is not null and crash_year >= {V.PROXIMITY_FIRST_YEAR}
""" + "".join(
    f"""union all select {text(name)}, * from crashes
  where crash_date is not null and crash_year >= {V.PROXIMITY_FIRST_YEAR}
    and crash_country like '%{word}%' and crash_country <> {text(name)} """
    for name, word in V.CRASH_COUNTRY_WORDS.items()
)

_SHAPES = " or ".join(
    f"(upper(shape_clean) in ({', '.join(map(text, shapes))}) "
    f"and duration_seconds_clean between {low} and {high})"
    for shapes, low, high in V.AIRCRAFT_SHAPES
)
STEPS["pairs"] = f"""
select u.sighting_id, u.sighting_datetime, u.sighting_date, u.city_clean as ufo_city,
  u.state_clean as ufo_state, u.country_standardized as ufo_country,
  u.latitude_clean as ufo_latitude, u.longitude_clean as ufo_longitude,
  u.shape_clean as ufo_shape, u.duration_seconds_clean as ufo_duration,
  u.comments_clean as ufo_comments, c.crash_date, c.crash_location, c.aircraft_type,
  c.total_fatalities, abs(datediff('day', c.crash_date, u.sighting_date)) as days,
  coalesce(c.crash_country = u.country_standardized, false) as same_country,
  coalesce({_SHAPES}, false) or coalesce({any_word('comments_clean', V.AIRCRAFT_WORDS)}, false)
    as alike,
  case {_MEDIA} else {text(V.MEDIA_NONE)} end as media
from enriched u left join crash_listing c on c.listed_as = u.country_standardized
  and abs(datediff('day', c.crash_date, u.sighting_date)) <= {{days}}"""

_SCORE = " ".join(f"when same_country and days <= {d} then {s}" for d, s in V.CORRELATION_SCORES)
_HEAD = (
    "sighting_id, sighting_datetime, sighting_date, ufo_city, ufo_state, ufo_country, ufo_latitude, "
    "ufo_longitude, ufo_shape, ufo_duration, ufo_comments"
)
CORRELATION = f"""
select *, case
    when crashes_within_week > 0 and has_aircraft_like_features then 'HIGH_SUSPICION'
    when crashes_within_month > 0 and crashes_same_country > 0 then 'MODERATE_SUSPICION'
    when closest_crash_days <= 90 then 'LOW_SUSPICION' else 'MINIMAL_SUSPICION'
    end as false_positive_likelihood
from (
  select sighting_id, {', '.join(f'any_value({c.strip()}) as {c.strip()}'
                                 for c in _HEAD.split(',')[1:])},
    count(*) as nearby_crashes_count, count(*) filter (days <= 7) as crashes_within_week,
    count(*) filter (days <= 30) as crashes_within_month,
    count(*) filter (same_country) as crashes_same_country,
    cast(min(days) as int) as closest_crash_days,
    min(near).crash_date as closest_crash_date, min(near).place as closest_crash_location,
    min(near).type as closest_aircraft_type,
    case when not min(near).uncounted then min(near).dead end as closest_crash_fatalities,
    max(case {_SCORE} else 1 end) as max_correlation_score,
    bool_or(alike) as has_aircraft_like_features, max(media) as max_media_attention
  from (select *, case when crash_date is not null then struct_pack(d := days,
      crash_date := crash_date, place := crash_location, type := aircraft_type,
      uncounted := total_fatalities is null, dead := coalesce(total_fatalities, 0)) end as near
    from pairs)
  group by sighting_id)"""
STEPS["pairs_365"] = STEPS["pairs"].format(days=365)
STEPS["pairs_7"] = STEPS.pop("pairs").format(days=7)
STEPS["correlation"] = CORRELATION.replace("from pairs)", "from pairs_365)")
STEPS["correlation_7"] = CORRELATION.replace("from pairs)", "from pairs_7)")

_POINTS = " + ".join(f"{p} * cast({f} as int)" for f, p in V.HAZARD_POINTS.items())
_FLAGS = ", ".join(V.HAZARD_POINTS)
STEPS["incidents"] = f"""
select * exclude (weather_date), case
    when weather_mentioned_in_summary then 'EXPLICIT_WEATHER_CAUSE'
    when weather_severity in ('EXTREME', 'SEVERE') then 'LIKELY_WEATHER_FACTOR'
    when weather_severity = 'MODERATE' and poor_visibility then 'POSSIBLE_WEATHER_FACTOR'
    when weather_severity in ('MILD', 'GOOD') then 'MINIMAL_WEATHER_FACTOR'
    else 'UNKNOWN_WEATHER_IMPACT' end as weather_attribution,
  case when weather_risk_score >= 6 and total_fatalities > 50 then 'HIGH_RISK_HIGH_CASUALTIES'
    when weather_risk_score >= 4 and total_fatalities > 20 then 'MODERATE_RISK_MODERATE_CASUALTIES'
    when weather_risk_score >= 2 and total_fatalities > 0 then 'LOW_RISK_SOME_CASUALTIES'
    when weather_risk_score < 2 and total_fatalities = 0 then 'GOOD_WEATHER_NO_CASUALTIES'
    else 'MIXED_CONDITIONS' end as weather_casualty_correlation,
  weather_date is not null as has_weather_data
from (select *, {floors('weather_risk_score', V.SEVERITY_FLOORS, V.SEVERITY_BELOW)} as weather_severity
  from (select *, {_POINTS} as weather_risk_score
    from (select c.crash_date, c.crash_year, c.crash_month, c.crash_location, c.crash_country,
        c.airline_operator, c.aircraft_type, c.aircraft_manufacturer, c.operator_type,
        c.people_aboard, c.total_fatalities, c.survivors, c.fatality_rate_percent,
        c.casualty_severity, c.aviation_era, c.crash_summary, w.observation_date as weather_date,
        w.weather_summary, w.weather_category, w.visibility_category, w.wind_category,
        coalesce({listed('w.weather_category', V.ADVERSE_WEATHER)}, false) as adverse_weather,
        coalesce({listed('w.visibility_category', V.POOR_VISIBILITY)}, false) as poor_visibility,
        coalesce({listed('w.wind_category', V.HIGH_WIND)}, false) as high_winds,
        coalesce(w.cloud_cover_percent > {V.HEAVY_COVER_ABOVE}, false) as heavy_cloud_cover,
        coalesce(w.precipitation_type <> 'NONE', false) as precipitation_present,
        coalesce({any_word('c.crash_summary', V.WEATHER_CAUSE_WORDS)}, false)
          as weather_mentioned_in_summary
      from crashes c left join weather w on c.crash_date = w.observation_date
      where c.crash_year >= {V.WEATHER_FIRST_YEAR})))"""

_CAUSED = "weather_attribution in ('EXPLICIT_WEATHER_CAUSE', 'LIKELY_WEATHER_FACTOR')"
STEPS["usual_weather"] = """
select crash_country, weather_category from (
  select crash_country, weather_category, count(*) as n from incidents
  where has_weather_data and weather_category is not null group by 1, 2)
qualify row_number() over (partition by crash_country order by n desc, weather_category) = 1"""
STEPS["safety"] = f"""
select 'weather_severity' as analysis_type, weather_severity as category,
  weather_category as subcategory, count(*) as crash_count,
  cast(sum(total_fatalities) as bigint) as fatality_count, avg(fatality_rate_percent) as fatality_rate,
  round(avg(fatality_rate_percent) * (count(*) filter ({_CAUSED}) * 100.0e0 / count(*)), 2) as risk_score,
  count(*) filter (weather_attribution = 'EXPLICIT_WEATHER_CAUSE') as weather_attributed,
  cast(null as int) as time_period, cast(null as varchar) as location
from incidents where has_weather_data group by weather_severity, weather_category
union all
select 'temporal_trends', aviation_era, cast(crash_year as varchar), count(*),
  cast(sum(total_fatalities) as bigint), {pct('count(*) filter (adverse_weather)', 'count(*)')},
  avg(weather_risk_score), count(*) filter (weather_mentioned_in_summary), crash_month, null
from incidents where has_weather_data group by crash_year, crash_month, aviation_era
union all
select 'aircraft_vulnerability', aircraft_manufacturer, aircraft_type, count(*), null,
  avg(fatality_rate_percent),
  round((count(*) filter ({_CAUSED}) * 100.0e0 / count(*)) * (avg(fatality_rate_percent) / 100.0e0), 2),
  count(*) filter ({_CAUSED}), null, null
from incidents where has_weather_data
group by aircraft_manufacturer, aircraft_type, operator_type having count(*) >= 5
union all
select 'geographic_risk', i.crash_country, any_value(u.weather_category), count(*),
  cast(sum(total_fatalities) as bigint), round(avg(fatality_rate_percent), 2),
  round(avg(weather_risk_score) * avg(fatality_rate_percent) / 100.0e0, 2),
  count(*) filter (adverse_weather), null, i.crash_country
from incidents i left join usual_weather u on i.crash_country = u.crash_country
where has_weather_data and i.crash_country is not null
group by i.crash_country having count(*) >= 10"""

STEPS["volumes"] = f"""
select departure_hour, departure_time_of_day, departure_city, arrival_city, flight_route,
  airline_name, airline_region, stop_category, flight_duration_category,
  count(*) as total_flights, count(distinct airline_name) as unique_airlines,
  count(distinct flight_route) as unique_routes, avg(flight_duration_hours) as avg_flight_duration,
  min(flight_duration_hours) as min_flight_duration, max(flight_duration_hours) as max_flight_duration,
  avg(ticket_price) as avg_ticket_price, min(ticket_price) as min_ticket_price,
  max(ticket_price) as max_ticket_price, avg(number_of_stops) as avg_stops,
  count(*) filter (number_of_stops = 0) as nonstop_flights,
  count(*) filter (number_of_stops >= 1) as connecting_flights,
  count(*) filter (has_valid_duration) as flights_with_duration,
  count(*) filter (has_pricing_data) as flights_with_pricing,
  count(*) filter (has_complete_route) as flights_with_complete_route,
  {pct('count(*) filter (number_of_stops = 0)', 'count(*)')} as nonstop_percentage,
  {pct('count(*) filter (has_valid_duration)', 'count(*)')} as data_completeness_percentage
from flights where has_complete_route group by all"""

_DAYTIMES = ["MORNING", "AFTERNOON", "EVENING", "NIGHT"]
_HAULS = ["SHORT_HAUL", "MEDIUM_HAUL", "LONG_HAUL", "ULTRA_LONG_HAUL"]


def _split(c: str, values, names, what: str = "total_flights") -> str:
    return ", ".join(
        f"cast(sum(case when {c} = {text(v)} then {what} else 0 end) as bigint) as {n}"
        for v, n in zip(values, names)
    )


STEPS["routes"] = f"""
select departure_city, arrival_city, flight_route,
  cast(sum(total_flights) as bigint) as total_route_flights,
  cast(sum(unique_airlines) as bigint) as airlines_serving_route,
  {_split('departure_time_of_day', _DAYTIMES, [f'{d.lower()}_flights' for d in _DAYTIMES])},
  cast(sum(nonstop_flights) as bigint) as total_nonstop_flights,
  cast(sum(connecting_flights) as bigint) as total_connecting_flights,
  sum(avg_flight_duration * total_flights) / cast(sum(total_flights) as double) as weighted_avg_duration,
  sum(avg_ticket_price * total_flights) / cast(sum(total_flights) as double) as weighted_avg_price,
  {_split('stop_category', ['NONSTOP', 'ONE_STOP', 'MULTIPLE_STOPS'],
          ['route_nonstop_volume', 'route_one_stop_volume', 'route_multi_stop_volume'])},
  {_split('flight_duration_category', _HAULS, [f'{h.lower()}_flights' for h in _HAULS])}
from volumes group by departure_city, arrival_city, flight_route"""

STEPS["route_report"] = f"""
select r.*, d.total as departure_city_total_flights, d.partners as departure_city_destinations,
  a.total as arrival_city_total_flights, a.partners as arrival_city_origins,
  {pct('total_route_flights', 'd.total')} as route_share_of_departure_city,
  {pct('total_route_flights', 'a.total')} as route_share_of_arrival_city,
  {floors('total_route_flights', V.ROUTE_FLOORS, V.ROUTE_BELOW)} as route_volume_category,
  {', '.join(f"{pct(f'{d.lower()}_flights', 'total_route_flights')} as {d.lower()}_flight_percentage"
             for d in _DAYTIMES)},
  case when route_nonstop_volume = total_route_flights then 'NONSTOP_ONLY'
    when route_nonstop_volume > total_route_flights * 0.8 then 'MOSTLY_NONSTOP'
    when route_multi_stop_volume > total_route_flights * 0.5 then 'COMPLEX_ROUTING'
    else 'MIXED_ROUTING' end as route_complexity_category
from routes r
left join (select departure_city, cast(sum(total_route_flights) as bigint) as total,
  count(distinct arrival_city) as partners from routes group by 1) d using (departure_city)
left join (select arrival_city, cast(sum(total_route_flights) as bigint) as total,
  count(distinct departure_city) as partners from routes group by 1) a using (arrival_city)"""

STEPS["complete_flights"] = "select * from flights where has_complete_route"
STEPS["hours"] = f"""
select departure_hour, departure_time_of_day, count(*) as flights_in_hour,
  count(distinct airline_name) as airlines_active_in_hour,
  count(distinct flight_route) as routes_active_in_hour,
  avg(flight_duration_hours) as avg_duration_in_hour,
  count(*) filter (number_of_stops = 0) as nonstop_flights_in_hour,
  {', '.join(f"count(*) filter (airline_region = '{r}') as {r.lower()}_flights_in_hour"
             for r in ('US_MAJOR', 'EUROPEAN', 'ASIAN'))},
  {', '.join(f"count(*) filter (flight_duration_category = '{h}') as {h.lower()}_in_hour"
             for h in _HAULS)}
from complete_flights where departure_hour is not null
group by departure_hour, departure_time_of_day"""
STEPS["airlines"] = f"""
select airline_name, airline_region, count(*) as total_airline_flights,
  count(distinct flight_route) as routes_served, count(distinct departure_city) as cities_served_from,
  count(distinct arrival_city) as cities_served_to,
  avg(flight_duration_hours) as avg_airline_duration, avg(number_of_stops) as avg_airline_stops,
  {', '.join(f"count(*) filter (departure_time_of_day = '{d}') as airline_{d.lower()}_flights"
             for d in _DAYTIMES)},
  {', '.join(f"count(*) filter (flight_duration_category = '{h}') as airline_{h.lower()}"
             for h in _HAULS)},
  {pct('count(*) filter (number_of_stops = 0)', 'count(*)')} as airline_nonstop_percentage,
  {floors('count(*)', V.AIRLINE_FLOORS, V.AIRLINE_BELOW)} as airline_size_category
from complete_flights group by airline_name, airline_region"""
STEPS["traffic"] = f"""
select count(*) as total_flights_in_dataset, count(distinct airline_name) as total_airlines,
  count(distinct flight_route) as total_routes,
  count(distinct departure_city) as total_departure_cities,
  count(distinct arrival_city) as total_arrival_cities,
  avg(flight_duration_hours) as overall_avg_duration, avg(number_of_stops) as overall_avg_stops,
  {', '.join(f"{pct(f'count(*) filter (departure_time_of_day = {text(d)})', 'count(*)')} as {d.lower()}_percentage"
             for d in _DAYTIMES)},
  {', '.join(f"{pct(f'count(*) filter (flight_duration_category = {text(h)})', 'count(*)')} as {h.lower()}_percentage"
             for h in _HAULS)}
from complete_flights"""
STEPS["traffic_report"] = f"""
select 'HOURLY_PATTERN' as analysis_type, cast(departure_hour as varchar) as category_name,
  departure_time_of_day as subcategory, flights_in_hour as flight_count,
  airlines_active_in_hour as airline_count, routes_active_in_hour as route_count,
  avg_duration_in_hour as avg_duration, nonstop_flights_in_hour as nonstop_count,
  cast(null as double) as complexity_indicator,
  {pct('flights_in_hour', '(select total_flights_in_dataset from traffic)')}
    as percentage_of_total_traffic
from hours
union all
select 'AIRLINE_PATTERN', airline_name, airline_region, total_airline_flights, null, routes_served,
  avg_airline_duration, null, airline_nonstop_percentage,
  {pct('total_airline_flights', '(select total_flights_in_dataset from traffic)')}
from airlines"""

STEPS["crash_days"] = """
select c.event_date, count(*) as crash_events,
  cast(sum(coalesce(c.fatalities, 0)) as bigint) as total_fatalities,
  avg(w.temperature_c) as avg_temp_c, min(w.daily_summary) as any_weather_summary
from thin_crashes c left join thin_weather w on c.event_date = w.event_date group by 1"""
STEPS["sighting_days"] = """
select u.event_date, count(*) as ufo_sightings, avg(u.duration_seconds) as avg_duration_seconds,
  avg(w.temperature_c) as avg_temp_c, avg(w.humidity) as avg_humidity,
  avg(w.wind_speed_km) as avg_wind_speed_km, min(w.daily_summary) as any_weather_summary
from sightings u left join thin_weather w on u.event_date = w.event_date group by 1"""

_NEAR, _SOON, _ALIKE = (
    "crashes_within_week > 0", "crashes_within_month > 0", "has_aircraft_like_features",
)


def _told(sentence) -> str:
    return f"{text(sentence[0])} || closest_crash_days || {text(sentence[1])}"


STEPS["cases"] = f"""
select *, case when {_NEAR} and {_ALIKE} then 'STRONG_EVIDENCE'
    when {_NEAR} or ({_SOON} and {_ALIKE}) then 'MODERATE_EVIDENCE'
    when {_SOON} then 'WEAK_EVIDENCE' else 'NO_EVIDENCE' end as debunking_evidence_strength,
  case when {_NEAR} and {_ALIKE} then {_told(V.CASE_STRONG)} when {_NEAR} then {_told(V.CASE_WEEK)}
    when {_SOON} and {_ALIKE} then {_told(V.CASE_MONTH)} else {text(V.CASE_ELSE)}
    end as potential_explanation
from correlation where false_positive_likelihood in ('HIGH_SUSPICION', 'MODERATE_SUSPICION')"""
STEPS["debunking"] = f"""
select 'case_details' as analysis_type, sighting_id as record_id, sighting_date as event_date,
  ufo_country as location, ufo_state as sub_location, false_positive_likelihood as suspicion_level,
  cast(null as varchar) as evidence_strength, potential_explanation as explanation,
  cast(closest_crash_days as double) as days_to_incident, cast(null as varchar) as related_aircraft,
  max_correlation_score as correlation_score, cast(null as double) as summary_metric
from cases
union all
select 'regional_summary', ufo_country || '|' || ufo_state, y, ufo_country, ufo_state, null, null,
  'Region shows ' || rate || '% potential false positive rate', days, null, null, rate
from (select ufo_country, ufo_state, cast(date_trunc('year', sighting_date) as timestamp) as y,
    date_trunc('month', sighting_date) as m, avg(closest_crash_days) as days,
    {pct("count(*) filter (false_positive_likelihood in ('HIGH_SUSPICION', 'MODERATE_SUSPICION'))",
         'count(*)')} as rate
  from correlation group by 1, 2, 3, 4)
union all
select 'aircraft_correlation', closest_aircraft_type, null, null, null, null, null,
  count(*) || ' UFO sightings correlated with ' || closest_aircraft_type || ' incidents',
  avg(closest_crash_days), null, null,
  count(*) filter (false_positive_likelihood = 'HIGH_SUSPICION')
from correlation where closest_aircraft_type is not null
group by closest_aircraft_type having count(*) >= 3"""
STEPS["debunking_short"] = f"""
select sighting_id, sighting_date, ufo_country, ufo_state, ufo_city, ufo_shape,
  false_positive_likelihood, nearby_crashes_count, crashes_within_week, crashes_within_month,
  closest_crash_days, max_correlation_score, has_aircraft_like_features,
  case when {_NEAR} and {_ALIKE} then {text(V.ASSESS_STRONG)} when {_NEAR} then {text(V.ASSESS_WEEK)}
    when {_SOON} and {_ALIKE} then {text(V.ASSESS_MONTH)} else {text(V.ASSESS_ELSE)}
    end as debunking_assessment
from correlation where false_positive_likelihood <> 'MINIMAL_SUSPICION'"""
STEPS["aircraft_types"] = """
select c.closest_aircraft_type, count(*) as correlated_ufo_sightings,
  count(*) filter (false_positive_likelihood = 'HIGH_SUSPICION') as high_suspicion_sightings,
  avg(closest_crash_days) as avg_days_between, avg(closest_crash_fatalities) as avg_crash_fatalities,
  any_value(s.ufo_shape) as most_common_ufo_shape, avg(ufo_duration) as avg_ufo_duration
from correlation c join (
  select closest_aircraft_type, ufo_shape from (
    select closest_aircraft_type, ufo_shape, count(*) as n from correlation group by 1, 2)
  qualify row_number() over (partition by closest_aircraft_type order by n desc, ufo_shape) = 1) s
  on c.closest_aircraft_type = s.closest_aircraft_type
group by 1 having count(*) >= 3"""

_YEAR = AS_OF[:4]
_RECENT = (
    f"case when sighting_year >= {_YEAR} - 1 then 'last_year' when sighting_year >= {_YEAR} - 5 then "
    f"'last_5_years' when sighting_year >= {_YEAR} - 10 then 'last_10_years' else 'older' end"
)


def _usual(keys: list[str]) -> str:
    by = ", ".join(keys) if keys else "1"
    names = ", ".join(keys) if keys else "1 as one"
    return (
        f"(select * from (select {names}, shape_clean, count(*) as n from dated group by "
        f"{', '.join(keys + ['shape_clean'])}) qualify row_number() over "
        f"(partition by {by} order by n desc, shape_clean) = 1)"
    )


STEPS["dated"] = f"select *, {_RECENT} as recency from enriched where has_valid_datetime"
_DASH = """count(*) as total_sightings, {distinct},
  min(sighting_date) as earliest_sighting, max(sighting_date) as latest_sighting,
  {years} as years_of_data, count(distinct d.shape_clean) as unique_shapes,
  any_value(s.shape_clean) as most_common_shape,
  round(avg(duration_seconds_clean), 2) as avg_duration_seconds,
  round(median(duration_seconds_clean), 2) as median_duration_seconds,
  max(duration_seconds_clean) as max_duration_seconds,
  count(*) filter (has_valid_coordinates) as sightings_with_coordinates,
  """ + pct("count(*) filter (has_valid_coordinates)", "count(*)") + """ as pct_with_coordinates,
  count(comments_clean) as sightings_with_comments,
  """ + pct("count(comments_clean)", "count(*)") + """ as pct_with_comments"""
_DASH_SINCE = ", ".join(
    f"count(*) filter (sighting_year >= {_YEAR} - {n}) as sightings_last_{name}"
    for n, name in ((1, "year"), (5, "5_years"), (10, "10_years"))
)
_WIDE = (
    "count(distinct country_standardized) as unique_countries, "
    "count(distinct country_standardized || '|' || state_clean) as unique_states, "
    "count(distinct country_standardized || '|' || state_clean || '|' || city_clean) as unique_cities"
)
_NARROW = (
    "1 as unique_countries, count(distinct state_clean) as unique_states, "
    "count(distinct city_clean) as unique_cities"
)
_SPAN = "cast(year(max(sighting_date)) - year(min(sighting_date)) as int)"
STEPS["dashboard"] = f"""
select *, case when years_of_data > 0 then round(total_sightings / cast(years_of_data as double), 1)
  end as avg_sightings_per_year
from (
  select 'overall' as metric_type, 'all_time' as time_period, cast(null as varchar) as country,
    cast(null as varchar) as region, {_DASH.format(distinct=_WIDE, years=_SPAN)}, {_DASH_SINCE}
  from dated d, {_usual([])} s
  union all
  select 'by_country', 'all_time', d.country_standardized, d.region,
    {_DASH.format(distinct=_NARROW, years=_SPAN)}, {_DASH_SINCE}
  from dated d join {_usual(['country_standardized', 'region'])} s
    on d.country_standardized = s.country_standardized and d.region = s.region
  group by d.country_standardized, d.region
  union all
  select 'recent_trends', d.recency, null, null, {_DASH.format(distinct=_WIDE, years='null')},
    null, null, null
  from dated d join {_usual(['recency'])} s on d.recency = s.recency group by d.recency)"""

_MONTH_SHAPES = ", ".join(
    f"count(*) filter (shape_clean = {text(s)}) as {n}" for n, s in V.MONTH_SHAPES.items()
)
_MONTH_BANDS = ", ".join(
    f"count(*) filter (duration_category = {text(label)}) as {n}"
    for n, label in zip(
        [*V.MONTH_DURATIONS, V.MONTH_DURATION_ABOVE],
        [*[b for _, b in V.SIGHTING_BANDS], V.SIGHTING_ABOVE],
    )
)
_COUNTED = [*V.MONTH_SHAPES, *V.MONTH_DURATIONS, V.MONTH_DURATION_ABOVE]
STEPS["months"] = f"""
select country_standardized as country, region, sighting_year as year, sighting_month as month,
  cast(date_trunc('month', sighting_date) as timestamp) as period_date, count(*) as total_sightings,
  count(distinct city_clean) as unique_cities, count(distinct state_clean) as unique_states,
  count(*) filter (has_valid_coordinates) as sightings_with_coordinates,
  avg(duration_seconds_clean) as avg_duration_seconds,
  median(duration_seconds_clean) as median_duration_seconds,
  max(duration_seconds_clean) as max_duration_seconds, {_MONTH_SHAPES}, {_MONTH_BANDS},
  {pct('count(*) filter (has_valid_coordinates)', 'count(*)')} as pct_with_coordinates,
  {pct('count(comments_clean)', 'count(*)')} as pct_with_comments,
  avg(latitude_clean) as avg_latitude, avg(longitude_clean) as avg_longitude
from dated group by 1, 2, 3, 4, 5"""
STEPS["country_time"] = f"""
select 'monthly' as time_grain, * from months
union all by name
select 'yearly' as time_grain, country, region, year, cast(null as int) as month,
  cast(make_date(year, 1, 1) as timestamp) as period_date,
  {', '.join(f'cast(sum({c}) as bigint) as {c}' for c in
             ['total_sightings', 'unique_cities', 'unique_states', 'sightings_with_coordinates',
              *_COUNTED])},
  avg(avg_duration_seconds) as avg_duration_seconds,
  avg(median_duration_seconds) as median_duration_seconds,
  max(max_duration_seconds) as max_duration_seconds,
  {pct('sum(m.sightings_with_coordinates)', 'sum(m.total_sightings)')} as pct_with_coordinates,
  {pct('sum(case when m.pct_with_comments > 0 then m.total_sightings * m.pct_with_comments / 100.0e0 else 0 end)',
       'sum(m.total_sightings)')} as pct_with_comments,
  avg(avg_latitude) as avg_latitude, avg(avg_longitude) as avg_longitude
from months m group by country, region, year"""

_PLACES = {
    "country": ["country_standardized", "region"],
    "state": ["country_standardized", "region", "state_clean"],
    "city": ["country_standardized", "region", "state_clean", "city_clean"],
}
_RANK = "order by total_sightings desc, country, region, state nulls last, city nulls last"
for _level, _keys in _PLACES.items():
    _on = " and ".join(f"d.{k} = s.{k}" for k in _keys)
    STEPS[f"place_{_level}"] = f"""
select {', '.join(f'd.{k} as {n}' for k, n in zip(_keys, ['country', 'region', 'state', 'city']))},
  {'cast(null as varchar) as state, ' if _level == 'country' else ''}
  {'cast(null as varchar) as city, ' if _level != 'city' else ''}
  count(*) as total_sightings, count(distinct d.state_clean) as states,
  count(distinct d.city_clean) as cities, min(sighting_date) as first_sighting_date,
  max(sighting_date) as last_sighting_date, avg(duration_seconds_clean) as avg_duration_seconds,
  median(duration_seconds_clean) as median_duration_seconds,
  any_value(s.shape_clean) as most_common_shape, avg(latitude_clean) as center_latitude,
  avg(longitude_clean) as center_longitude,
  count(*) filter (has_valid_coordinates) as sightings_with_coordinates,
  {pct('count(*) filter (has_valid_coordinates)', 'count(*)')} as pct_with_coordinates,
  count(*) filter (sighting_year >= {_YEAR} - 5) as recent_sightings
from dated d join {_usual(_keys)} s on {_on} group by {', '.join(f'd.{k}' for k in _keys)}"""


def _ranked(level: str, sub: str, cities: str, days: str, activity: str, ranks: list[str]) -> str:
    names = ["global_rank", "country_rank", "state_rank"]
    return f"""
select '{level}' as location_type, country, region, state, city, total_sightings,
  {sub} as sub_locations, {cities} as unique_cities, first_sighting_date, last_sighting_date,
  {days} as days_of_activity, avg_duration_seconds, median_duration_seconds, most_common_shape,
  center_latitude, center_longitude, sightings_with_coordinates, pct_with_coordinates,
  recent_sightings, {activity} as activity_level,
  {', '.join(f'{r} as {n}' for r, n in zip(ranks, names))}
from place_{level}"""


_BY_ALL = f"row_number() over ({_RANK})"
_BY_COUNTRY = f"cast(row_number() over (partition by country {_RANK}) as int)"
_BY_STATE = f"cast(row_number() over (partition by country, state {_RANK}) as int)"
STEPS["locations"] = "\nunion all".join(
    [
        _ranked(
            "country",
            "states",
            "cities",
            "cast(datediff('day', first_sighting_date, last_sighting_date) as int)",
            floors("total_sightings", V.COUNTRY_FLOORS, V.COUNTRY_BELOW),
            [_BY_ALL, "null", "null"],
        ),
        "\nselect * from (" + _ranked(
            "state", "null", "cities", "null", "null", [_BY_ALL, _BY_COUNTRY, "null"]
        ) + ") where global_rank <= 50",
        "\nselect * from (" + _ranked(
            "city", "null", "null", "null", "null", [_BY_ALL, _BY_COUNTRY, _BY_STATE]
        ) + ") where global_rank <= 100",
    ]
)

_LIKELY = "suspicion_level in ('HIGH_SUSPICION', 'MODERATE_SUSPICION')"


def _row(labels, value: str, part: str, source: str) -> str:
    return (
        f"select 'summary_metrics' as data_type, {text(labels[0])} as category, "
        f"{text(labels[1])} as subject, cast({value} as double) as metric_value, "
        f"cast({part} as double) as metric_percentage, cast(null as double) as metric_aux, "
        f"{text(labels[2])} as narrative, cast(null as timestamp) as date_context, "
        f"cast(null as varchar) as location_context from {source}"
    )


STEPS["summary_rows"] = "\nunion all ".join(
    [
        _row(V.SUMMARY_TOTAL, "count(*)", "null", "enriched"),
        _row(
            V.SUMMARY_EXPLAINED,
            "count(*)",
            f"coalesce({pct('count(*)', '(select count(*) from enriched)')}, 0)",
            f"debunking where analysis_type = 'case_details' and {_LIKELY}",
        ),
        _row(
            V.SUMMARY_HIGH,
            "count(*)",
            "coalesce(" + pct(
                "count(*)",
                "(select count(*) from debunking where analysis_type = 'case_details')",
            ) + ", 0)",
            "debunking where suspicion_level = 'HIGH_SUSPICION'",
        ),
        _row(
            V.SUMMARY_CRASHES,
            "sum(crash_count)",
            "null",
            "safety where analysis_type = 'weather_severity'",
        ),
        _row(
            V.SUMMARY_ATTRIBUTED,
            "sum(weather_attributed)",
            pct("sum(weather_attributed)", "sum(crash_count)"),
            "safety where analysis_type = 'weather_severity'",
        ),
    ]
)
STEPS["insight_rows"] = """
select * from (select 'key_insights' as data_type, 'ufo_debunking' as category,
    'most_suspicious_location' as subject, cast(correlation_score as double) as metric_value,
    cast(null as double) as metric_percentage, cast(null as double) as metric_aux,
    explanation as narrative, event_date as date_context, location as location_context
  from debunking where suspicion_level = 'HIGH_SUSPICION'
  order by correlation_score desc nulls last, record_id limit 5)
union all
select * from (select 'key_insights', 'aviation_weather', 'highest_weather_risk', risk_score, null,
    null, 'Weather danger index: ' || risk_score || ' with ' || crash_count || ' crashes',
    cast(null as timestamp), category
  from safety where analysis_type = 'weather_severity'
  order by risk_score desc nulls last, category, subcategory limit 5)
union all
select * from (select 'key_insights', 'aviation_geographic', 'most_dangerous_region', risk_score,
    null, null, crash_count || ' crashes with ' || fatality_rate || '% average fatality rate',
    cast(null as timestamp), location
  from safety where analysis_type = 'geographic_risk'
  order by risk_score desc nulls last, location limit 5)"""
STEPS["regional"] = """
select region, suspicious, high, crashes, risk, case
    when high > 5 and crashes > 20 then 'HIGH_ACTIVITY_REGION'
    when suspicious > 10 and crashes > 10 then 'MODERATE_ACTIVITY_REGION'
    else 'LOW_ACTIVITY_REGION' end as level
from (
  select coalesce(u.location, w.location) as region,
    count(*) filter (u.analysis_type = 'case_details') as suspicious,
    count(*) filter (u.suspicion_level = 'HIGH_SUSPICION') as high,
    cast(sum(case when w.analysis_type = 'geographic_risk' then w.crash_count end) as bigint) as crashes,
    avg(case when w.analysis_type = 'geographic_risk' then w.risk_score end) as risk
  from debunking u full outer join safety w on u.location = w.location
  where coalesce(u.location, w.location) is not null group by 1)"""
STEPS["comprehensive"] = """
select * from summary_rows union all select * from insight_rows union all
select 'regional_analysis', level, region, suspicious, crashes, risk,
  'Region with ' || suspicious || ' suspicious UFO cases and ' || crashes || ' crashes',
  null, region from regional"""


def _kpi(labels, value: str, source: str) -> str:
    return (
        f"select {text(labels[0])} as analysis_area, {text(labels[1])} as metric_name, "
        f"{value} as metric_value, {text(labels[2])} as description, "
        f"timestamp '{AS_OF}' as last_updated from {source}"
    )


STEPS["comprehensive_short"] = "\nunion all ".join(
    [
        _kpi(V.KPI_SIGHTINGS, "count(*)", "enriched"),
        _kpi(V.KPI_COUNTRIES, "count(distinct country_standardized)", "enriched"),
        _kpi(
            V.KPI_ACTIVE,
            "count(*)",
            "enriched where city_activity_level in ('VERY HIGH ACTIVITY', 'HIGH ACTIVITY')",
        ),
        _kpi(
            V.KPI_SUSPICIOUS,
            "count(*)",
            "correlation where false_positive_likelihood in ('HIGH_SUSPICION', 'MODERATE_SUSPICION')",
        ),
        _kpi(
            V.KPI_HIGH,
            "count(*)",
            "correlation where false_positive_likelihood = 'HIGH_SUSPICION'",
        ),
        _kpi(V.KPI_FEATURES, "count(*)", "correlation where has_aircraft_like_features"),
        *[
            _kpi(labels, "count(*)", f"safety where analysis_type = '{kind}'")
            for labels, kind in (
                (V.KPI_RISKS, "weather_severity"),
                (V.KPI_AREAS, "geographic_risk"),
                (V.KPI_TYPES, "aircraft_vulnerability"),
            )
        ],
    ]
)


def statement(final: str, rounded: tuple | list = ()) -> str:
    """`final` over the steps it names; `rounded` columns are cut to six decimals."""
    needed: list[str] = []
    for name in STEPS:
        if re.search(rf"\b(from|join)\s+{name}\b|,\s*{name}\b", final) and name not in needed:
            _resolve(name, needed)
    steps = ", ".join(f"{n} as ({STEPS[n]})" for n in needed)
    if rounded:
        cuts = ", ".join(f"round({c}, 6) as {c}" for c in rounded)
        final = f"select * replace ({cuts}) from ({final})"
    return f"with {steps} {final}" if steps else final


def _resolve(name: str, needed: list[str]) -> None:
    for other in STEPS:
        if other != name and re.search(rf"\b(from|join)\s+{other}\b", STEPS[name]):
            if other not in needed:
                _resolve(other, needed)
    if name not in needed:
        needed.append(name)
