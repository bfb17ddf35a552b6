from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sightline.functions import aggregates as A
from sightline.functions import columns as X
from sightline.operators.cleaning import coerce_report


@pytest.mark.parametrize(
    "raw, posted, expected, rule",
    [
        ("10/10/1949 20:30", None, datetime(1949, 10, 10, 20, 30), "us_minutes"),
        ("1/5/2001 9:05", None, datetime(2001, 1, 5, 9, 5), "us_minutes"),
        ("1/5/2001 24:05", "1/6/2001", datetime(2001, 1, 6), "fallback"),
        ("1/5/2001 24:05", None, None, "none"),
        ("2004-04-27", "1/6/2001", datetime(2004, 4, 27), "generic"),
        ("2004-04-27 03:04:05", None, datetime(2004, 4, 27, 3, 4, 5), "generic"),
        ("1234567890123", None, datetime(2009, 2, 13, 23, 31, 30), "epoch_millis"),
        ("1234567890", None, datetime(1970, 1, 15, 6, 56, 7), "digits"),
        ("1e300", "2001-1-6", datetime(2001, 1, 6), "epoch_out_of_range"),
        ("junk", None, None, "none"),
        (None, "2/3/1999", datetime(1999, 2, 3), "fallback"),
        ("2001", None, None, "none"),
    ],
)
def test_coerce_timestamp(spark, raw, posted, expected, rule):
    df = spark.createDataFrame([(raw, posted)], "t string, p string")
    got = df.select(X.coerce_timestamp(F.col("t"), F.col("p"))).first()[0]
    assert got == expected
    assert coerce_report(df, "t", "p").collect() == [(rule, 1)]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("20", 20.0), ("-3.5", -3.5), ("+1", 1.0), (".5", None), ("5.", None), ("1e3", None),
        ("2q", None), ("", None), (None, None),
    ],
)
def test_parse_number(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(X.parse_number(F.col("t"))).first()[0] == expected


def test_dates_and_keys(spark):
    row = spark.createDataFrame(
        [("09/17/1908", "17-DEC-1980", "c: ", "1999-1-2", 7, 1234567, None)],
        "a string, b string, c string, d string, n int, m int, k string",
    ).select(
        *[X.parse_date(F.col(c)).cast("string") for c in "abcd"],
        X.sequence_suffix(F.col("n")),
        X.sequence_suffix(F.col("m")),
        X.surrogate_key(F.col("k"), F.lit("x")),
        F.md5(F.lit("-x")),
    )
    a, b, c, d, n, m, key, expected = row.first()
    assert (a, b, c, d) == ("1908-09-17", "1980-12-17", None, "1999-01-02")
    assert (n, m) == ("000007", "1234567")
    assert key == expected


def test_aggregates(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2, True), ("a", 3.0, 2, False), ("b", None, 1, False), ("b", 5.0, None, None)],
        "k string, x double, w int, p boolean",
    )
    row = df.agg(
        A.count_where(F.col("p")),
        A.sum_where(F.col("p"), F.col("x")),
        A.sum_where(F.col("k") == "z", F.col("x"), default=None),
        A.weighted_avg(F.col("x"), F.col("w")),
        A.pct(A.count_where(F.col("p")), F.count("*")),
        A.pct(F.sum("w"), F.lit(0)),
        A.pct(F.sum("w"), F.lit(0), zero=0),
    ).first()
    assert tuple(row) == (1, 1.0, None, 8.0 / 5, 25.0, None, 0.0)


def test_guarded_casts_read_what_try_cast_reads(spark):
    texts = [
        "3", " 3 ", "+3", "-1", "3.0", "1e3", "", "zero", "One", "3abc", "a3", "2147483648", "+", "12:3", None,
        "1e11", "12345678901", " 788918400000 ", "1e11d", "unknown", "1/2/2000 24:10",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    rows = df.select(
        t.try_cast("int"), X.try_whole(t), t.try_cast("double"),
        F.when(t.rlike(X.MAYBE_NUMBER), t.try_cast("double")),
    ).collect()
    assert [r[0] for r in rows] == [r[1] for r in rows]
    assert [r[2] for r in rows] == [r[3] for r in rows]
    # Words, of which raw tables are full, are not cast at all.
    assert not df.filter(t.isin("zero", "One", "")).filter(t.rlike(X.MAYBE_WHOLE)).count()
    assert not df.filter(t.isin("unknown", "1/2/2000 24:10")).filter(t.rlike(X.MAYBE_NUMBER)).count()
