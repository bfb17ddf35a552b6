"""Raw-table stand-ins derived from the driver's tables.

The statements are plain SQL that Spark and DuckDB both read, so that both sides of a
comparison start from the same raw rows, dirty values included. Every row of the driver's
tables takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sightline.session import tune
from sightline.sources.schemas import SCHEMAS



def _us_day(t: str) -> str:
    return f"concat(month({t}), '/', day({t}), '/', year({t}))"


def _two(n: str) -> str:
    return f"lpad(concat('', {n}), 2, '0')"


def _iso_day(t: str) -> str:
    return f"concat(year({t}), '-', {_two(f'month({t})')}, '-', {_two(f'day({t})')})"


def _quarters(n: str) -> str:
    """Whole number of quarters as decimal text. Quarters add up exactly in any order."""
    return f"concat(cast(floor({n} / 4) as bigint), '.', {_two(f'{n} % 4 * 25')})"


def _steps(n: str, width: int) -> str:
    return f"cast(floor({n} / {width}) as bigint)"


SIGHTINGS = f"""
select
  case
    when k % 10 < 6 then concat({_us_day('t')}, ' ', k % 24, ':', {_two('k % 60')})
    when k % 10 = 6 then {_iso_day('t')}
    when k % 10 = 7 then concat('', 788918400000 + (k % 20000) * 10000000)
    when k % 10 = 8 then 'unknown'
    else concat({_us_day('t')}, ' 24:10') end as datetime,
  case
    when k % 17 = 0 then ''
    when k % 11 = 0 then concat(' ', segment, ' ', customer % 7, ' ')
    else concat(segment, ' ', customer % 7) end as city,
  case
    when land % 10 <> 0 then concat('s', land)
    when customer % 8 = 0 then 'CA' when customer % 8 = 1 then 'TX'
    when customer % 8 = 2 then 'fl' when customer % 8 = 3 then 'NY'
    when customer % 8 = 4 then 'IL' when customer % 8 = 5 then 'CO'
    when customer % 8 = 6 then 'PR' else '' end as state,
  case
    when land % 10 = 0 then 'us' when land % 10 = 1 then 'ca'
    when land = 2 then 'uk' when land = 3 then ' Australia ' when land = 4 then 'de'
    when land = 5 then 'france' when land = 6 then '' else nation end as country,
  case
    when k % 9 = 0 then 'light' when k % 9 = 1 then 'Triangle' when k % 9 = 2 then 'circle'
    when k % 9 = 3 then ' disk' when k % 9 = 4 then 'sphere' when k % 9 = 5 then 'other'
    when k % 9 = 6 then 'fireball' when k % 9 = 7 then '' end as shape,
  case
    when k % 13 = 0 then '1e3' when k % 29 = 0 then ''
    when k % 5 = 0 then concat(cast(floor(price / 100) as bigint), '.5')
    else concat('', cast(floor(price / 100) as bigint)) end as duration_seconds,
  concat(k % 90, ' minutes') as duration_hours_min,
  case
    when k % 7 = 0 then '' when k % 7 = 1 then ' bright light near a plane '
    when k % 7 = 2 then 'aircraft debris' when k % 7 = 3 then cast(null as {{text}})
    else concat('seen by ', name) end as comments,
  case
    when k % 100 = 8 then cast(null as {{text}})
    when k % 20 = 9 then {_iso_day('t')} else {_us_day('t')} end as date_posted,
  case when k % 19 = 0 then '' when k % 23 = 0 then 'n/a'
    else {_quarters(_steps('h', 50))} end as latitude,
  case when k % 19 = 0 then '' else concat('-', {_quarters(_steps('h', 25))}) end as longitude,
  k as sight_key
from (
  select o_orderkey as k, o_orderdate as t, o_totalprice as price, c_custkey as customer,
    c_mktsegment as segment, c_name as name, n_nationkey as land, n_name as nation,
    cast(floor(abs(c_acctbal)) as bigint) as h
  from {{orders}} join {{customer}} on o_custkey = c_custkey
    join {{nation}} on c_nationkey = n_nationkey) s
"""

COORDINATES = """
select
  case when s_suppkey % 3 = 0 then 'USA' else concat('C', s_nationkey) end as country_code,
  floor(h / 50) / 4.0e0 as latitude, -floor(h / 25) / 4.0e0 as longitude,
  concat('Land ', s_nationkey) as country,
  case when s_suppkey % 3 = 0 then 'TX' end as usa_state_code,
  floor(h / 50) / 4.0e0 as usa_state_latitude, -floor(h / 25) / 4.0e0 as usa_state_longitude,
  case when s_suppkey % 3 = 0 then concat('State ', s_suppkey % 7)
    when s_suppkey % 5 = 1 then ' ' end as usa_state
from (select s_suppkey, s_nationkey, cast(floor(abs(s_acctbal)) as bigint) as h from {supplier}) s
"""

CRASHES = f"""
select
  case
    when (l_orderkey + l_linenumber) % 97 = 0 then 'c: '
    when (l_orderkey + l_linenumber) % 89 = 0 then cast(null as {{text}})
    when (l_orderkey + l_linenumber) % 83 = 0 then
      concat(day(l_shipdate), '-', case when l_linenumber % 2 = 0 then 'DEC' else 'Jun' end, '-',
        year(l_shipdate))
    when l_linenumber = 7 then {_iso_day('l_shipdate')}
    else {_us_day('l_shipdate')} end as date,
  case when l_linenumber = 1 then 'c: ' when l_linenumber = 2 then '' else ' 17:18' end as time,
  case
    when l_partkey % 37 = 0 then cast(null as {{text}})
    when l_partkey % 31 = 0 then p_brand
    when n_nationkey % 10 = 0 then
      concat(p_brand, ', ', case when l_linenumber % 2 = 0 then 'UNITED STATES' else 'Reno USA' end)
    when n_nationkey % 10 = 1 then
      concat(p_brand, ', ', case when l_linenumber % 2 = 0 then 'CANADA' else 'West CANADA' end)
    when n_nationkey = 2 then concat(p_brand, ', UNITED KINGDOM')
    when n_nationkey = 3 then concat(p_brand, ', AUSTRALIA')
    when n_nationkey = 4 then concat(p_brand, ', Bonn, GERMANY')
    when n_nationkey = 5 then concat(p_brand, ', France')
    when n_nationkey = 6 then concat(p_brand, ', UNKNOWN')
    else concat(p_brand, ', ', n_name) end as location,
  case
    when s_suppkey % 6 = 0 then concat('Air Force ', s_suppkey)
    when s_suppkey % 6 = 1 then 'Private owner' when s_suppkey % 6 = 2 then 'freight line'
    when s_suppkey % 6 = 3 then 'Charter ' when s_suppkey % 6 = 4 then s_name end as operator,
  concat('', l_orderkey) as flight_number,
  case when l_linenumber = 3 then cast(null as {{text}}) else concat(' R', l_suppkey) end as route,
  concat(case
    when p_size % 8 = 0 then 'Boeing' when p_size % 8 = 1 then 'Airbus'
    when p_size % 8 = 2 then 'DC-3' when p_size % 8 = 3 then 'Cessna'
    when p_size % 8 = 4 then 'Piper' when p_size % 8 = 5 then 'Lockheed'
    when p_size % 8 = 6 then 'Fighter' else 'Tupolev' end, ' ', p_type) as type,
  lower(p_brand) as registration,
  concat('', l_partkey) as cn_ln,
  case when l_partkey % 41 = 0 then 0 when l_partkey % 43 = 0 then null else 50 end as aboard,
  case
    when l_partkey % 47 = 0 then -1 when l_partkey % 53 = 0 then null
    when l_partkey % 59 = 0 then 0 when l_partkey % 7 = 0 then cast(l_quantity as int) * 5
    else cast(l_quantity as int) end as fatalities,
  case when l_linenumber = 5 then -1 else l_linenumber - 1 end as ground,
  case
    when l_linenumber = 1 then ' Crashed in bad weather' when l_linenumber = 2 then 'Hit ice'
    when l_linenumber = 3 then 'Engine failure' when l_linenumber = 4 then ''
    when l_linenumber = 5 then cast(null as {{text}}) else 'Lost control' end as summary
from {{lineitem}} join {{supplier}} on l_suppkey = s_suppkey
  join {{nation}} on s_nationkey = n_nationkey join {{part}} on l_partkey = p_partkey
"""

WEATHER = """
select
  case when event_id % 101 <> 0
    then ts - interval 9861 days + (event_id % 60) * interval 30 days end as formatted_date,
  case
    when event_id % 50 = 0 then 'Windy' when event_id % 51 = 0 then cast(null as {text})
    when event_id % 52 = 0 then 'Light Snow' when event_type = 'click' then 'Clear'
    when event_type = 'error' then ' Storm front' when event_type = 'purchase' then 'Light Rain'
    when event_type = 'signup' then 'Overcast' else 'Foggy' end as summary,
  case when event_id % 4 = 0 then 'rain' when event_id % 4 = 1 then 'null'
    when event_id % 4 = 2 then '' end as precip_type,
  floor(value) - 30.0e0 as temperature_c,
  floor(value) - 110.0e0 as apparent_temperature_c,
  case when event_id % 3 = 0 then cast(event_id % 5 as double) / 4
    when event_id % 3 = 1 then cast(event_id % 120 as double) end as humidity,
  case when event_id % 73 <> 0 then cast(event_id % 70 as double) end as wind_speed_km,
  cast(event_id % 400 as double) as wind_bearing_degrees,
  case when event_id % 79 <> 0 then cast(event_id % 32 as double) / 2 end as visibility_km,
  cast(event_id % 130 as double) as loud_cover,
  cast(780 + event_id % 450 as double) as pressure_millibars,
  concat('Day of ', event_type) as daily_summary
from {events}
"""

FLIGHTS = """
select
  l_orderkey * 10 + l_linenumber as index,
  case
    when l_partkey % 67 = 0 then cast(null as {text})
    when s_suppkey % 9 = 0 then 'American ' when s_suppkey % 9 = 1 then 'Lufthansa'
    when s_suppkey % 9 = 2 then 'Emirates' when s_suppkey % 9 = 3 then 'Air Canada'
    when s_suppkey % 9 = 4 then 'Delta' else s_name end as airline,
  concat('f', l_orderkey) as flight,
  case when l_partkey % 71 = 0 then '' else lower(a.n_name) end as source_city,
  case
    when l_orderkey % 12 = 0 then 'Morning' when l_orderkey % 12 = 1 then cast(null as {text})
    when l_orderkey % 12 = 2 then '25:00' when l_orderkey % 12 = 3 then '7'
    else concat(l_orderkey % 24, ':', lpad(concat('', l_linenumber * 7), 2, '0'))
    end as departure_time,
  case
    when l_linenumber = 1 then 'zero' when l_linenumber = 2 then 'One'
    when l_linenumber = 3 then 'two_or_more' when l_linenumber = 4 then '3'
    when l_linenumber = 5 then '-1' when l_linenumber = 6 then ' Two ' end as stops,
  concat((l_orderkey + 5) % 24, ':30') as arrival_time,
  case when l_partkey % 73 = 0 then cast(null as {text}) else b.n_name end as destination_city,
  case
    when p_type = 'PROMO' then 'Premium Economy' when p_type = 'STANDARD' then 'Business'
    when p_type = 'LARGE' then 'First' when p_type = 'MEDIUM' then 'premium'
    else p_type end as class,
  case when l_partkey % 79 = 0 then -1.0e0 else l_quantity / 2 end as duration,
  cast(l_orderkey % 45 - 2 as int) as days_left,
  case when l_partkey % 61 = 0 then 0.0e0 else floor(l_extendedprice / 50) * 1.0e0 end as price
from {lineitem} join {orders} on l_orderkey = o_orderkey
  join {customer} on o_custkey = c_custkey join {nation} b on c_nationkey = b.n_nationkey
  join {supplier} on l_suppkey = s_suppkey join {nation} a on s_nationkey = a.n_nationkey
  join {part} on l_partkey = p_partkey
"""

STATEMENTS = {
    "sightings": (SIGHTINGS, ["orders", "customer", "nation"]),
    "coordinates": (COORDINATES, ["supplier"]),
    "crashes": (CRASHES, ["lineitem", "supplier", "nation", "part"]),
    "weather": (WEATHER, ["events"]),
    "flights": (FLIGHTS, ["lineitem", "orders", "customer", "supplier", "nation", "part"]),
}
DEALT = {
    "sightings": ("orders", "o_orderkey"),
    "crashes": ("lineitem", "l_orderkey"),
    "weather": ("events", "event_id"),
    "flights": ("lineitem", "l_orderkey"),
}
EXTRA = {"sightings": ", sight_key bigint"}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    statement, tables = STATEMENTS[name]
    tune(spark)
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    if name in DEALT:
        # The test files hold one row group each, and one task would clean them all. Rows are dealt out before
        # the joins, as they are in the file: a raw row is several times wider.
        table, key = DEALT[name]
        frames[table] = frames[table].repartition(key)
    df = spark.sql(statement.replace("{text}", "string"), **frames)
    return df.to(StructType.fromDDL(SCHEMAS[name] + EXTRA.get(name, "")))


def raw_sql(name: str) -> str:
    statement, tables = STATEMENTS[name]
    return statement.format(text="varchar", **{t: t for t in tables})
