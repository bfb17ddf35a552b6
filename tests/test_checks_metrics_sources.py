from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sightline.operators import metrics as M
from sightline.operators import quality as Q
from sightline.plans.checks import CHECKS, quality_report
from sightline.plans.orders import ORDERS, declared_order, first_rows, store_ordered
from sightline.sources import tables as T


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [("a", 1), ("a", 5), ("b", None), (None, 99)], "k string, n int"
    )


def test_checks_report_failing_rows(rows):
    assert Q.not_null(rows, "k").collect() == [(None, 99)]
    assert Q.unique(rows, "k").collect() == [("a", 2)]
    assert Q.accepted_values(rows, "k", ["a"]).collect() == [("b", None)]
    assert Q.accepted_range(rows, "n", 0, 50).collect() == [(None, 99)]
    assert Q.accepted_range(rows, "n", 0, 50, "k is not null").collect() == []
    assert Q.expression_is_true(rows, "n", "> 1").collect() == [("a", 1)]


def test_report_counts_in_one_pass(rows):
    checks = [
        ("not_null", "k"), ("accepted_values", "k", ["a"]), ("accepted_range", "n", 0, 50),
        ("expression_is_true", "n", "> 1"), ("unique", "k"), ("unique", "n"),
    ]
    report = Q.check_report(rows, "m", checks)
    got = {(r.check, r.column): r.failures for r in report.collect()}
    assert got == {
        ("not_null", "k"): 1, ("accepted_values", "k"): 1, ("accepted_range", "n"): 1,
        ("expression_is_true", "n"): 1, ("unique", "k"): 1, ("unique", "n"): 0,
    }


def test_checks_are_counted_by_the_write(spark, rows):
    checks = [
        ("unique", "k"), ("not_null", "k"), ("accepted_values", "k", ["a"]), ("accepted_range", "n", 0, 50),
        ("expression_is_true", "n", "> 1"), ("unique", "n"),
    ]
    for df in (rows, rows.limit(0)):
        done = Q.write_checked(df, "m", checks, T.durable)
        want = Q.check_report(df, "m", checks)
        assert sorted(done.report().collect()) == sorted(want.collect())
        assert done.report().dtypes == want.dtypes
        assert sorted(done.table.collect(), key=str) == sorted(df.collect(), key=str)
    only = Q.write_checked(rows, "m", [("unique", "k")], T.durable)
    assert only.report().collect() == [("unique", "m", "k", 1)]


def test_a_checked_write_reads_its_input_once(spark, rows):
    asked = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            asked.add(batch.num_rows)
            yield batch

    checks = [("not_null", "k"), ("accepted_range", "n", 0, 50)]
    done = Q.write_checked(rows.mapInArrow(counted, rows.schema), "m", checks, T.durable)
    assert done.failures == [1, 1] and done.report().count() == 2
    assert asked.value == 4


def test_declared_checks_are_complete(rows):
    kinds = [c[0] for checks in CHECKS.values() for c in checks]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 43, "unique": 3, "accepted_values": 22, "accepted_range": 5,
        "expression_is_true": 12,
    }
    only = quality_report({"crashes_by_day": rows.withColumnRenamed("k", "event_date")})
    assert only.collect() == [("not_null", "crashes_by_day", "event_date", 1)]


def test_all_measures_are_registered():
    assert sum(len(m.measures) for m in M.MODELS.values()) == len(M.METRICS) == 44


@pytest.fixture
def days(spark):
    return spark.createDataFrame(
        [("2000-01-01", 2, 5, 1.0, "x"), ("2000-01-03", 4, 1, None, "y"), ("2000-02-01", 1, 0, 4.0, "x")],
        "event_date string, crash_events long, total_fatalities long, avg_temp_c double, "
        "any_weather_summary string",
    ).withColumn("event_date", F.to_date("event_date"))


def test_metric_grains_and_dimensions(days):
    month = M.metric(days, "crash_events_sum", grain="month")
    assert sorted(tuple(r) for r in month.collect()) == [
        (date(2000, 1, 1), 6), (date(2000, 2, 1), 1),
    ]
    by = M.metric(days, "avg_temperature_celsius", ["weather_summary"])
    assert dict(by.collect()) == {"x": 2.5, "y": None}
    assert M.metric(days, "events_count").collect() == [(3,)]
    kept = M.metric(days, "events_count", where=F.col("crash_events") > 1)
    assert kept.collect() == [(2,)]


def test_metric_spine_fills_gaps(spark, days):
    spine = T.date_spine(spark, "2000-01-01", "2000-01-04")
    out = M.metric(days, "crash_events_sum", grain="day", spine=spine)
    assert [r[1] for r in out.orderBy("metric_time").collect()] == [2, 0, 4, 0]
    with pytest.raises(ValueError):
        M.metric(days, "crash_events_sum", ["weather_summary"], spine=spine)
    by_weather = M.metric(days, "crash_events_sum", ["weather_summary"], "day", spine=spine)
    groups = days.select("any_weather_summary").distinct().count()
    assert by_weather.count() == 4 * groups
    total = by_weather.groupBy("metric_time").sum("crash_events_sum").orderBy("metric_time").collect()
    assert [r[1] for r in total] == [2, 0, 4, 0]
    assert [str(r[0]) for r in T.spine_over(days, "event_date").orderBy("date_day").collect()][:1] == ["2000-01-01"]


def test_every_registered_metric_runs(spark):
    kinds = {
        "crashes_by_day": "event_date date, crash_events long, total_fatalities long, "
        "avg_temp_c double, any_weather_summary string",
        "comprehensive_simple": "analysis_area string, metric_name string, metric_value long, "
        "description string, last_updated timestamp_ntz",
        "comprehensive_summary": "data_type string, category string, metric_value double, "
        "metric_percentage double, metric_aux double, date_context timestamp_ntz, "
        "location_context string",
        "debunking_analysis": "analysis_type string, record_id string, event_date timestamp_ntz, "
        "days_to_incident double, correlation_score int, summary_metric double, "
        "related_aircraft string",
    }
    for model, schema in kinds.items():
        table = spark.createDataFrame([], schema)
        for name in M.MODELS[model].measures:
            assert M.metric(table, name).count() == 1


def test_median_metric(spark):
    df = spark.createDataFrame(
        [("x", 1.0), ("x", 4.0), ("y", None)], "metric_type string, median_duration_seconds double"
    )
    name = "median_duration_seconds"
    assert dict(M.metric(df, name, ["metric_type"]).collect()) == {"x": 2.5, "y": None}
    assert M.metric(df, name).collect() == [(2.5,)]


def test_metrics_by_entity(spark, days):
    dash = spark.createDataFrame(
        [("a", 1, 3), ("a", 2, None), ("b", 5, 9), (None, 7, 7)],
        "country string, total_sightings long, years_of_data int",
    )
    out = M.metrics_by_entity("country", {"total_sightings": dash, "years_of_data": dash})
    assert sorted(tuple(r) for r in out.collect()) == [("a", 3, 3), ("b", 5, 9)]


def test_sources_and_sinks(spark, tmp_path, same):
    root = str(tmp_path)
    folder = tmp_path / "coordinates"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "country_code,latitude,longitude,country,usa_state_code,usa_state_latitude,"
        "usa_state_longitude,usa_state\nAD,42.5,1.6,Andorra,AK,63.5,-152.4,Alaska\nXX,1.0,2.0,null,,,,\n"
    )
    df = T.read_source(spark, "coordinates", root, "csv", null_tokens=["null"])
    assert [r.country for r in df.orderBy("country_code").collect()] == ["Andorra", None]
    assert dict(df.dtypes)["latitude"] == "double"
    stored = T.write_table(df, root, "core", "places", partition_by=["country_code"])
    same(df, stored)
    newer = df.filter("country_code = 'AD'").withColumn("latitude", F.lit(9.0))
    T.refresh_partitions(newer, root, "core", "places", ["country_code"])
    got = dict(T.read_table(spark, root, "core", "places").select("country_code", "latitude").collect())
    assert got == {"AD": 9.0, "XX": 1.0}
    T.register_view(df, "places_view")
    assert spark.sql("select count(*) from places_view").first()[0] == 2
    same(T.durable(df), df)
    counts = T.row_counts({"a": df, "b": df.filter("latitude > 2")})
    assert dict(counts.collect()) == {"a": 2, "b": 1}
    assert T.sample_table(df, 1, [F.desc("latitude")]).first().country_code == "AD"


def test_csv_columns_are_found_by_name(spark, tmp_path):
    folder = tmp_path / "coordinates"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "country,latitude,longitude,country_code,usa_state_code,usa_state_latitude,"
        "usa_state_longitude,usa_state\nAndorra,42.5,1.6,AD,AK,63.5,-152.4,Alaska\n"
    )
    row = T.read_source(spark, "coordinates", str(tmp_path), "csv").first()
    assert (row.country_code, row.country, row.latitude) == ("AD", "Andorra", 42.5)


def test_a_table_is_not_written_over_itself(spark, tmp_path):
    root = str(tmp_path)
    stored = T.write_table(spark.range(5), root, "core", "t")
    for write in (
        lambda: T.write_table(stored.filter("id > 1"), root, "core", "t"),
        lambda: T.refresh_partitions(stored.withColumn("p", F.lit(1)), root, "core", "t", ["p"]),
    ):
        with pytest.raises(ValueError):
            write()
    assert T.read_table(spark, root, "core", "t").count() == 5


def test_stored_tables_need_a_folder():
    unset = SimpleNamespace(
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None),
        conf=SimpleNamespace(get=lambda key, default: default),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        T.shared_folder(unset)


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    df = spark.range(100).withColumns({"day": F.col("id") % 3, "v": F.col("id") * 2})
    stored = T.write_table(df, str(tmp_path), "core", "t", partition_by=["day"])
    plan = stored.filter("day = 1 and v > 10").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThan(v,10)" in plan


def test_a_committed_table_can_be_rewritten_from_itself(spark, rows, tmp_path):
    root = str(tmp_path)
    first = T.commit_table(rows, root, "core", "t")
    second = T.commit_table(first.filter("n = 5"), root, "core", "t")
    assert second.collect() == [("a", 5)] and first.count() == 4
    assert T.current_table(spark, root, "core", "t").collect() == [("a", 5)]
    assert T.current_table(spark, root, "core", "t", version=1).count() == 4
    parts = T.commit_table(rows, root, "core", "t", partition_by=["k"])
    assert sorted(parts.select("k", "n").collect(), key=str) == sorted(rows.collect(), key=str)


def test_a_write_that_fails_leaves_the_old_version(spark, rows, tmp_path):
    root = str(tmp_path)
    T.commit_table(rows, root, "core", "t")
    broken = rows.select("k", F.raise_error(F.lit("no")).cast("int").alias("n"))
    with pytest.raises(Exception, match="no"):
        T.commit_table(broken, root, "core", "t")
    assert T.current_table(spark, root, "core", "t").count() == 4
    assert T.commit_table(rows.limit(1), root, "core", "t").count() == 1
    with pytest.raises(ValueError, match="no version"):
        T.current_table(spark, root, "core", "other")


def test_tables_in_their_declared_order(spark, tmp_path):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 4)).alias("analysis_type"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("flight_count"),
        F.col("id").alias("other"),
    )
    stored = store_ordered("traffic_patterns", df, str(tmp_path), "marts")
    rows = stored.orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 2001))
    large = 1 << 60
    key = lambda r: (
        r.analysis_type is None, r.analysis_type or "",
        -(large if r.flight_count is None else r.flight_count), r.other,
    )
    assert rows == sorted(rows, key=key)
    first = first_rows(stored, 5)
    assert first.collect() == rows[:5]
    assert "LessThanOrEqual(position,5)" in first._jdf.queryExecution().executedPlan().toString()


def test_every_ordered_model_has_its_order():
    assert len(ORDERS) == 10 and all(declared_order(m) for m in ORDERS)


def test_date_spine_counts_sightings_beyond_the_declared_days(spark, tmp_path):
    from datetime import date, datetime

    from parity.queries import QUERIES

    tables = {
        "orders": ([(1, 1, datetime(1850, 3, 1), 9.0), (2, 1, datetime(2050, 3, 1), 9.0)],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice double"),
        "customer": ([(1, "c", 1, 10.0, "S")],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(1, "N")], "n_nationkey int, n_name string"),
        "supplier": ([(1, "s", 1, 10.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = QUERIES["date_spine"](spark, str(tmp_path))
    seen = {r[0]: r[1] for r in got.filter("sightings > 0").collect()}
    assert seen == {date(1850, 3, 1): 1, date(2050, 3, 1): 1}
    assert got.count() == (date(2050, 3, 1) - date(1850, 3, 1)).days + 1
