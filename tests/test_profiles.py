import pytest
from pyspark.sql import functions as F

from sightline.operators import profiles as P


@pytest.fixture
def values(spark):
    return spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 0, None)
        .otherwise(F.concat(F.lit("g"), F.col("id") % 13)).alias("k"),
        F.when(F.col("id") % 17 > 0, F.pmod(F.hash("id"), F.lit(997)) / 4.0).alias("v"),
        (F.col("id") % 4 + 1).alias("w"),
    )


def spelled_out(df):
    return df.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))


def test_median_is_exact(values, same):
    got = P.grouped_median(values, ["k"], "v", F.col("w"), "m")
    want = spelled_out(values).groupBy("k").agg(F.median("v").alias("m"))
    same(got, want)


def test_median_of_struct_key(values, same):
    keyed = values.select(F.struct("k").alias("g"), "v", "w")
    got = P.grouped_median(keyed, ["g"], "v", F.lit(1), "m")
    same(got, keyed.groupBy("g").agg(F.median("v").alias("m")))


def test_mode_takes_lowest_of_equals(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 1), ("a", None, 9), ("b", "z", 2), ("b", "y", 1)],
        "k string, v string, w int",
    )
    assert dict(P.grouped_mode(df, ["k"], "v", F.col("w"), "m").collect()) == {"a": "x", "b": "z"}


def test_multi_grain_equals_separate_groupings(values, same):
    df = values.withColumn("j", F.col("w") % 2)
    aggs = [F.count("*").alias("n"), F.sum("v").alias("s")]
    grains = {"all": {}, "k": {"k": F.col("k")}, "kj": {"k": F.col("k"), "j": F.col("j")}}
    got = P.multi_grain(df, "grain", grains, aggs, where={"k": F.col("w") > 1})
    null = lambda t: F.lit(None).cast(t)
    parts = {
        "all": df.groupBy().agg(*aggs).withColumns({"k": null("string"), "j": null("long")}),
        "k": df.filter("w > 1").groupBy("k").agg(*aggs).withColumn("j", null("long")),
        "kj": df.groupBy("k", "j").agg(*aggs),
    }
    kinds = {"k": "string", "j": "long", "n": "long", "s": "double"}
    same(got, P.union_tagged(parts, "grain", kinds))


def test_kpi_rows_in_one_pass(values):
    kpis = [(("area", "rows"), F.count("*")), (("area", "keys"), F.count_distinct("k"))]
    out = P.kpi_rows(values, kpis, ["a", "b", "n"])
    assert out.collect() == [("area", "rows", 4000), ("area", "keys", 14)]


def test_value_ranges_rise_with_the_values(spark):
    from random import Random

    random = Random(2)
    numbers = [s * m * 2.0**e for e in range(-60, 60, 3) for s in (1, -1) for m in (1, 1.5, random.uniform(1, 2))]
    near = [x for n in (1.0, 2.0, 4096.0, 1e300, 5e-324) for x in (n, -n, n * (1 - 2**-52), n * (1 + 2**-52))]
    df = spark.createDataFrame([(x,) for x in [*numbers, *near, 0.0]], "v double")
    rows = df.select("v", P.value_range(F.col("v")).alias("r")).orderBy("v").collect()
    places = [r.r for r in rows]
    assert places == sorted(places)


def test_activity_span(spark):
    df = spark.createDataFrame(
        [("a", "2000-12-31", 1), ("a", "2001-01-01", 2)], "k string, d string, n int"
    ).withColumn("d", F.to_date("d"))
    row = P.activity_span(df, ["k"], "d").first()
    assert (row.days_of_activity, row.years_of_data) == (1, 1)
