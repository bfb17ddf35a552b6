from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline.operators import ranking as R


def test_global_row_number_equals_window(spark, same):
    df = spark.range(5000).select(
        (F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 > 0, F.hash("id") % 50).alias("b"),
        F.col("id").alias("c"),
    )
    order = [F.desc("a"), F.col("b").asc_nulls_last()]
    got = R.global_row_number(df, order, "n", unique=True)
    ties = [F.col(c).asc_nulls_last() for c in df.columns]
    want = df.withColumn("n", F.row_number().over(W.orderBy(*order, *ties)).cast("long"))
    same(got, want)


def test_copies_are_numbered_and_spread(spark, same, monkeypatch):
    hot = spark.range(900).select(F.lit("hot").alias("k"), F.lit(None).cast("int").alias("v"))
    cold = spark.range(300).select((F.col("id") % 50).cast("string").alias("k"), F.lit(1).alias("v"))
    df = hot.unionByName(cold)
    spelled = R.spell_out_copies(df, "copy", per_task=100)
    assert spelled.count() == 1200
    same(spelled.drop("copy"), df)
    monkeypatch.setattr(R.spell_out_copies, "__defaults__", (100,))
    got = R.global_row_number(df, [F.asc("k")], "n")
    assert [r.n for r in got.select("n").orderBy("n").collect()] == list(range(1, 1201))
    same(got.drop("n"), df)
    first_hot = got.filter("k = 'hot'").agg(F.min("n"), F.max("n")).first()
    assert tuple(first_hot) == (301, 1200)


def test_empty_input(spark):
    empty = spark.range(0).withColumn("k", F.lit(1))
    assert R.global_row_number(empty, [F.asc("id")], "n").count() == 0


def test_first_and_top(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), ("b", None, "w")], "k string, v int, t string"
    )
    order = [F.col("v").asc_nulls_last()]
    assert sorted(r.t for r in R.first_per_group(df, ["k"], order).collect()) == ["y", "z"]
    assert [r.t for r in R.top_k(df, order, 2).collect()] == ["y", "x"]
    assert sorted(r.t for r in R.top_k(df, order, 1, ["k"]).collect()) == ["y", "z"]
    assert {r.t: r.n for r in R.add_rank(df, "n", order, ["k"]).collect()} == {
        "y": 1, "x": 2, "z": 1, "w": 2,
    }
    plan = R.first_per_group(df, ["k"], order)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_repeated_rows_are_not_shuffled(spark, same):
    df = spark.range(40).withColumn("n", F.col("id") % 4 * 3 + 1)
    got = R.repeat_rows(df, "n", per_task=4)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    same(got, df.select("id", F.explode(F.sequence(F.lit(1), "n"))).select("id"))


def test_stored_rows_are_shuffled_for_the_sort_alone(spark, same):
    hot = spark.range(900).select(F.lit("hot").alias("k"), F.lit(None).cast("int").alias("v"))
    cold = spark.range(300).select((F.col("id") % 50).cast("string").alias("k"), F.lit(1).alias("v"))
    df = hot.unionByName(cold)
    plain = R._hot_copies_apart(df, "copy")
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    same(plain.drop("copy"), df)
    apart = R._hot_copies_apart(df, "copy", per_task=100)
    same(apart.drop("copy"), df)
    assert apart.filter("k = 'hot'").select("copy").distinct().count() == 900
    got = R.global_row_number(df, [F.asc("k")], "n", stored=True)
    assert [r.n for r in got.select("n").orderBy("n").collect()] == list(range(1, 1201))


def test_copies_are_looked_for_in_few_columns_first(spark, same, monkeypatch):
    df = spark.range(300).select((F.col("id") % 3).alias("a"), F.col("id").alias("b"))
    asked = []
    monkeypatch.setattr(R, "durable", lambda t: asked.append(t) or t)
    cold = R._hot_copies_apart(df, "copy", per_task=100, alike=["a"])
    assert not asked
    same(cold, df.withColumn("copy", F.lit(0).cast("long")))
    # Many rows that agree there may still be no copies, or some of them may be.
    hot = df.unionByName(spark.range(250).select(F.lit(1).cast("long").alias("a"), F.lit(7).cast("long").alias("b")))
    apart = R._hot_copies_apart(hot, "copy", per_task=100, alike=["a"])
    assert asked
    same(apart, R._hot_copies_apart(hot, "copy", per_task=100))
    assert apart.filter("b = 7").select("copy").distinct().count() == 251
