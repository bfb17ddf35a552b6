"""Sighting summaries. They are roll-ups of one pre-aggregate, `sighting_cube`.

Each summary first rolls the cube up to the finest of its own grains, and takes all coarser grains from
that level: sums and extremes by rows of a shape, medians from counted durations, distinct
counts from bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline.functions import aggregates as A
from sightline.functions import columns as X
from sightline.functions import fixed_values as V
from sightline.operators.distinct import member_bitmaps, member_counts
from sightline.operators.profiles import at_grains, grouped_median, null_safe_join, union_tagged

CUBE_KEYS = {
    "country": "country_standardized",
    "region": "region",
    "state": "state_clean",
    "city": "city_clean",
    "shape": "shape_clean",
    "year": "sighting_year",
    "month": "sighting_month",
}
PERIOD_COUNTS = ["total_sightings", "unique_cities", "unique_states", "sightings_with_coordinates"]
RANK_PARTS = 64
DURATION_COUNTS = [*V.MONTH_DURATIONS, V.MONTH_DURATION_ABOVE]


#: Measures that add up; the rest are extremes.
SUMS = [
    "n", "duration_sum", "duration_n", "with_coordinates", "with_comments", "lat_sum", "lat_n",
    "lon_sum", "lon_n", *DURATION_COUNTS,
]


def sighting_cube(enriched: DataFrame) -> DataFrame:
    """Dated sightings counted by place, shape, month and duration, with the measures of the rest.

    It is the finest level of all sighting summaries, which read nothing else. A deployment
    stores it once.
    """
    lat, lon, seconds = F.col("latitude_clean"), F.col("longitude_clean"), F.col("duration_seconds_clean")
    label = X.upto(seconds, V.SIGHTING_BANDS, V.SIGHTING_ABOVE, "UNKNOWN")
    bands = zip(DURATION_COUNTS, [*[b for _, b in V.SIGHTING_BANDS], V.SIGHTING_ABOVE])
    return (
        enriched.filter("has_valid_datetime")
        .groupBy(*[F.col(c).alias(name) for name, c in CUBE_KEYS.items()], seconds.alias("duration"))
        .agg(
            F.count("*").alias("n"),
            F.sum(seconds).alias("duration_sum"),
            F.count(seconds).alias("duration_n"),
            *[A.count_where(label == band).alias(name) for name, band in bands],
            A.count_where(F.col("has_valid_coordinates")).alias("with_coordinates"),
            F.count("comments_clean").alias("with_comments"),
            F.sum(lat).alias("lat_sum"),
            F.count(lat).alias("lat_n"),
            F.sum(lon).alias("lon_sum"),
            F.count(lon).alias("lon_n"),
            F.min("sighting_date").alias("first_date"),
            F.max("sighting_date").alias("last_date"),
        )
        .withColumn("duration_max", F.col("duration"))
    )


def roll_up(level: DataFrame, keys: list, *more: Column) -> DataFrame:
    """A coarser level of the cube from a finer one, with all its measures."""
    return level.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.max("duration_max").alias("duration_max"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        *more,
    )


def durations(level: DataFrame, keys: list[str]) -> DataFrame:
    """How often each duration occurs by the given keys of the cube."""
    timed = level.filter(F.col("duration").isNotNull())
    return timed.groupBy(*keys, "duration").agg(F.sum("n").alias("n"))


def members(cube: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of the countries, states and cities of each group. A state is one of a country; a
    city is one of a country (`city_name`) or of a state. A country is left out where it is null."""
    country, state, city = (F.col(c) for c in ("country", "state", "city"))
    # States and cities of no country are counted within it, and not among all.
    own = F.coalesce(country, F.lit(""))
    return member_bitmaps(
        cube,
        keys,
        {
            "country": [country],
            "state": [country, state],
            "city": [country, state, city],
            "state_name": [own, state],
            "city_name": [own, city],
        },
    )


def _core() -> dict[str, Column]:
    """Measures every level of the cube can give."""
    total = F.sum("n")
    return {
        "total_sightings": total,
        "first_date": F.min("first_date"),
        "last_date": F.max("last_date"),
        "avg_duration_seconds": A.ratio(F.sum("duration_sum"), F.sum("duration_n")),
        "max_duration_seconds": F.max("duration_max"),
        "avg_latitude": A.ratio(F.sum("lat_sum"), F.sum("lat_n")),
        "avg_longitude": A.ratio(F.sum("lon_sum"), F.sum("lon_n")),
        "sightings_with_coordinates": F.sum("with_coordinates"),
        "pct_with_coordinates": A.pct(F.sum("with_coordinates"), total),
        "sightings_with_comments": F.sum("with_comments"),
        "pct_with_comments": A.pct(F.sum("with_comments"), total),
        # Of rows by shape: the most frequent one, the lowest among equals, and their number.
        "most_common_shape": F.min_by(
            "shape", F.when(F.col("shape").isNotNull(), F.struct(-F.col("n"), F.col("shape")))
        ),
        "unique_shapes": F.count("shape"),
    }


def _pick(names: list[str]) -> list[Column]:
    core = _core()
    return [core[n].alias(n) for n in names]


def _since(as_of: str, years: int) -> Column:
    return F.col("year") >= F.year(F.lit(as_of).cast("date")) - years


def _seen_since(as_of: str, years: int, name: str) -> Column:
    return F.sum(F.when(_since(as_of, years), F.col("n")).otherwise(0)).alias(name)


def recency(as_of: str) -> Column:
    return X.ladder(
        [
            (_since(as_of, 1), "last_year"),
            (_since(as_of, 5), "last_5_years"),
            (_since(as_of, 10), "last_10_years"),
        ],
        "older",
    )


def dashboard_summary(cube: DataFrame, as_of: str) -> DataFrame:
    """Indicators overall, by country and by recency, rolled up from the cube's years."""
    grains = {
        "overall": {},
        "by_country": {"country": F.col("country"), "region": F.col("region")},
        "recent_trends": {"time_period": recency(as_of)},
    }
    keys = ["country", "region", "year"]
    since = {
        "sightings_last_year": 1,
        "sightings_last_5_years": 5,
        "sightings_last_10_years": 10,
    }
    years = roll_up(cube, [*keys, "shape"])
    rows = at_grains(years, "metric_type", grains)
    by_shape = rows.groupBy("g", "shape").agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.max("duration_max").alias("duration_max"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        *[_seen_since(as_of, y, name) for name, y in since.items()],
    )
    # The overall row is there even if no sighting is.
    kind = by_shape.schema["g"].dataType
    none = F.struct(
        *[
            F.lit("overall" if f.name == "metric_type" else None).cast(f.dataType).alias(f.name)
            for f in kind.fields
        ]
    )
    everything = cube.sparkSession.range(1).select(
        none.alias("g"), *[F.lit(0).cast("long").alias(c) for c in ("n", *since)]
    )
    core = (
        by_shape.unionByName(everything, allowMissingColumns=True)
        .groupBy("g")
        .agg(
            *_pick(
                [
                    "total_sightings", "first_date", "last_date", "avg_duration_seconds",
                    "max_duration_seconds", "sightings_with_coordinates", "pct_with_coordinates",
                    "sightings_with_comments", "pct_with_comments", "most_common_shape",
                    "unique_shapes",
                ]
            ),
            *[F.sum(c).alias(c) for c in since],
        )
    )
    narrow = F.col("g.metric_type") == "by_country"
    named = lambda wide, own: ((F.col("kind") == own) & narrow) | ((F.col("kind") == wide) & ~narrow)
    seen = member_counts(
        at_grains(members(cube, keys), "metric_type", grains),
        ["g"],
        {
            "unique_countries": F.col("kind") == "country",
            "unique_states": named("state", "state_name"),
            "unique_cities": named("city", "city_name"),
        },
    )
    timed = at_grains(durations(cube, keys), "metric_type", grains)
    medians = grouped_median(timed, ["g"], "duration", F.col("n"), "median_duration_seconds")
    full = core.join(seen, "g", "left").join(medians, "g", "left")
    counts = [c for c in full.columns if c.startswith(("unique_", "total_", "sightings_"))]
    full = full.fillna(0, counts).select("g.*", "*")
    trends = F.col("metric_type") == "recent_trends"
    years = F.when(~trends, A.years_between(F.col("first_date"), F.col("last_date")))
    total = F.col("total_sightings")
    return full.withColumn("years_of_data", years).select(
        "metric_type",
        F.coalesce("time_period", F.lit("all_time")).alias("time_period"),
        "country",
        "region",
        "total_sightings",
        "unique_countries",
        "unique_states",
        "unique_cities",
        F.col("first_date").alias("earliest_sighting"),
        F.col("last_date").alias("latest_sighting"),
        "years_of_data",
        "unique_shapes",
        "most_common_shape",
        F.round("avg_duration_seconds", 2).alias("avg_duration_seconds"),
        F.round("median_duration_seconds", 2).alias("median_duration_seconds"),
        "max_duration_seconds",
        "sightings_with_coordinates",
        "pct_with_coordinates",
        "sightings_with_comments",
        "pct_with_comments",
        *[
            F.when(~trends, F.col(c)).alias(c)
            for c in ("sightings_last_year", "sightings_last_5_years", "sightings_last_10_years")
        ],
        F.when(F.col("years_of_data") > 0, F.round(total / F.col("years_of_data"), 1)).alias(
            "avg_sightings_per_year"
        ),
    )


def monthly_counts(cube: DataFrame) -> DataFrame:
    keys = ["country", "region", "year", "month"]
    n = F.col("n")
    core = roll_up(cube, [*keys, "shape"]).groupBy(*keys).agg(
        *_pick(
            [
                "total_sightings", "sightings_with_coordinates", "avg_duration_seconds",
                "max_duration_seconds", "pct_with_coordinates", "pct_with_comments",
                "avg_latitude", "avg_longitude",
            ]
        ),
        *[A.sum_where(F.col("shape") == s, n).alias(name) for name, s in V.MONTH_SHAPES.items()],
        *[F.sum(c).alias(c) for c in DURATION_COUNTS],
    )
    named = member_counts(
        members(cube, keys),
        keys,
        {
            "unique_cities": F.col("kind") == "city_name",
            "unique_states": F.col("kind") == "state_name",
        },
    )
    medians = grouped_median(durations(cube, keys), keys, "duration", n, "median_duration_seconds")
    out = null_safe_join(core, named, keys, "left").fillna(0, ["unique_cities", "unique_states"])
    return null_safe_join(out, medians, keys, "left").withColumn(
        "period_date", F.make_date("year", "month", F.lit(1)).cast("timestamp_ntz")
    )


def yearly_counts(monthly: DataFrame) -> DataFrame:
    """Roll-up of the months: counts add up (distinct counts too), averages are averaged.

    A year's at most twelve averages are added in the order of the months, so that repeated runs
    agree to the last bit.
    """
    total, noted = F.col("total_sightings"), F.col("pct_with_comments")
    with_comments = F.when(noted > 0, total * noted / F.lit(100.0)).otherwise(F.lit(0.0))
    counts = [*PERIOD_COUNTS, *V.MONTH_SHAPES, *DURATION_COUNTS]
    by_month = lambda c: F.array_sort(
        F.collect_list(F.when(F.col(c).isNotNull(), F.struct("month", F.col(c).alias("x"))))
    )
    in_order = lambda c: F.aggregate(
        by_month(c),
        F.lit(0.0),
        lambda total, m: total + m["x"],
        lambda total: total / F.nullif(F.count(c), F.lit(0)),
    )
    means = ["avg_duration_seconds", "median_duration_seconds", "avg_latitude", "avg_longitude"]
    return (
        monthly.groupBy("country", "region", "year")
        .agg(
            *[F.sum(c).alias(c) for c in counts],
            *[in_order(c).alias(c) for c in means],
            F.max("max_duration_seconds").alias("max_duration_seconds"),
            F.sum(with_comments).alias("__comments"),
        )
        .withColumn("pct_with_coordinates", A.pct(F.col("sightings_with_coordinates"), total))
        .withColumn("pct_with_comments", A.pct(F.col("__comments"), total))
        .withColumn("period_date", F.make_date("year", F.lit(1), F.lit(1)).cast("timestamp_ntz"))
    )


def by_country_time(cube: DataFrame) -> DataFrame:
    """Monthly and yearly counts by country and region."""
    monthly = monthly_counts(cube)
    kinds = {
        "country": "string",
        "region": "string",
        "year": "int",
        "month": "int",
        "period_date": "timestamp_ntz",
        **{c: "long" for c in PERIOD_COUNTS},
        **{f"{k}_duration_seconds": "double" for k in ("avg", "median", "max")},
        **{c: "long" for c in [*V.MONTH_SHAPES, *DURATION_COUNTS]},
        **{c: "double" for c in ("pct_with_coordinates", "pct_with_comments")},
        **{c: "double" for c in ("avg_latitude", "avg_longitude")},
    }
    return union_tagged(
        {"monthly": monthly, "yearly": yearly_counts(monthly)}, "time_grain", kinds
    )


def location_profiles(cube: DataFrame, as_of: str) -> DataFrame:
    """Country, state and city profiles, for the three rankings, rolled up from the cities."""
    c = {k: F.col(k) for k in ("country", "region", "state", "city")}
    grains = {
        "country": {k: c[k] for k in ("country", "region")},
        "state": {k: c[k] for k in ("country", "region", "state")},
        "city": c,
    }
    cities = roll_up(cube, [*c, "shape"], _seen_since(as_of, 5, "recent_sightings"))
    by_shape = roll_up(
        at_grains(cities, "location_type", grains),
        ["g", "shape"],
        F.sum("recent_sightings").alias("recent_sightings"),
    )
    core = by_shape.groupBy("g").agg(
        *_pick(
            [
                "total_sightings", "first_date", "last_date", "avg_duration_seconds",
                "avg_latitude", "avg_longitude", "sightings_with_coordinates",
                "pct_with_coordinates", "most_common_shape",
            ]
        ),
        F.sum("recent_sightings").alias("recent_sightings"),
    )
    # Cities have no members of their own; they are counted for countries and states.
    within = members(cube, ["country", "region", "state"]).withColumn("city", F.lit(None).cast("string"))
    named = member_counts(
        at_grains(within, "location_type", grains, where={"city": F.lit(False)}),
        ["g"],
        {
            "unique_states": F.col("kind") == "state_name",
            "unique_cities": F.col("kind") == "city_name",
        },
    )
    timed = at_grains(durations(cube, list(c)), "location_type", grains)
    medians = grouped_median(timed, ["g"], "duration", F.col("n"), "median_duration_seconds")
    joined = core.join(named, "g", "left").join(medians, "g", "left")
    joined = joined.fillna(0, ["unique_states", "unique_cities"])
    return joined.select("g.*", *[x for x in joined.columns if x != "g"]).withColumnsRenamed(
        {
            "first_date": "first_sighting_date",
            "last_date": "last_sighting_date",
            "avg_latitude": "center_latitude",
            "avg_longitude": "center_longitude",
        }
    )


def top_locations(cube: DataFrame, as_of: str, states: int = 50, cities: int = 100) -> DataFrame:
    """All countries, the top states and the top cities with their ranks.

    Equal counts rank by name. With one order for all ranks, every place ahead of a top-k
    place in its own country is itself in the top k, so the ranks within country and state
    are taken among the k rows only. Profiles of all levels are ranked together: first within
    `RANK_PARTS` parts of a level, of which only k rows go on.
    """
    profiles = location_profiles(cube, as_of)
    level = F.col("location_type")
    country, state, city = (level == name for name in ("country", "state", "city"))
    names = [F.col(c) for c in ("country", "region", "state", "city")]
    order = [F.desc("total_sightings"), *[c.asc_nulls_last() for c in names]]
    place = lambda *by: F.row_number().over(W.partitionBy(level, *by).orderBy(*order))
    wanted = F.when(state, states).when(city, cities)
    part = F.pmod(F.xxhash64(*names), F.lit(RANK_PARTS))
    ranked = (
        profiles.withColumn("__place", place(part))
        .filter(country | (F.col("__place") <= wanted))
        .withColumn("global_rank", place())
        .filter(country | (F.col("global_rank") <= wanted))
    )
    total = F.col("total_sightings")
    days = A.days_between(F.col("first_sighting_date"), F.col("last_sighting_date"))
    active = X.atleast(total, V.COUNTRY_FLOORS, V.COUNTRY_BELOW)
    return ranked.select(
        "location_type",
        "country",
        "region",
        "state",
        "city",
        "total_sightings",
        F.when(country, F.col("unique_states")).alias("sub_locations"),
        F.when(~city, F.col("unique_cities")).alias("unique_cities"),
        "first_sighting_date",
        "last_sighting_date",
        F.when(country, days).alias("days_of_activity"),
        "avg_duration_seconds",
        "median_duration_seconds",
        "most_common_shape",
        "center_latitude",
        "center_longitude",
        "sightings_with_coordinates",
        "pct_with_coordinates",
        "recent_sightings",
        F.when(country, active).alias("activity_level"),
        F.col("global_rank").cast("long").alias("global_rank"),
        F.when(~country, place(names[0])).alias("country_rank"),
        F.when(city, place(names[0], names[2])).alias("state_rank"),
    )
