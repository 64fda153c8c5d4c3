import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from areascore import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, plain, padded",
    [
        ("10001", "10001", "10001"),
        ("10001.0", "10001", "10001"),
        ("NY 11201-1234", "11201", "11201"),
        ("7030", "", "07030"),
        ("none", "", ""),
        ("", "", ""),
        (None, None, None),
    ],
)
def test_extract_zip(spark, text, plain, padded):
    column = F.lit(text).cast("string")
    assert one(spark, fn.extract_zip(column)) == plain
    assert one(spark, fn.extract_zip(column, pad=True)) == padded


def test_normalize_keeps_inner_space_and_tabs(spark):
    assert one(spark, fn.normalize_text(F.lit("  a\tb c "))) == "A\tB C"
    assert one(spark, fn.normalize_text(F.lit("\tx "))) == "\tX"


def test_prefix_lookup(spark):
    table = {"MN": "Manhattan"}
    assert one(spark, fn.prefix_lookup(F.lit("MN0601"), table)) == "Manhattan"
    assert one(spark, fn.prefix_lookup(F.lit("ZZ"), table)) == "Other"
    assert one(spark, fn.prefix_lookup(F.lit(None).cast("string"), table)) == "Other"
    assert one(spark, fn.prefix_lookup(F.lit("MN"), {})) == "Other"


def test_bad_numbers_become_null(spark):
    assert one(spark, fn.to_double(F.lit("N/A"))) is None
    assert one(spark, fn.to_integer(F.lit("12.0"))) == 12
    assert one(spark, fn.to_integer(F.lit("x"))) is None
    assert one(spark, fn.to_integer(F.lit("99999999999"))) is None


def test_flag_is_zero_for_null(spark):
    df = spark.createDataFrame([(28,), (27,), (None,)], "s int")
    assert rows(df.select("s", fn.binary_flag(F.col("s") >= 28))) == [(27, 0), (28, 1), (None, 0)]


def test_ratio_and_rate(spark):
    df = spark.createDataFrame(
        [(1, 3, 0.0), (2, 1, 0.0), (3, 0, 500.0), (4, 5, None)], "k int, n int, p double"
    )
    assert rows(df.select("k", fn.guarded_ratio(F.col("k"), F.col("n")))) == [
        (1, 1 / 3),
        (2, 2.0),
        (3, 0.0),
        (4, 0.8),
    ]
    assert rows(df.select("k", fn.rate_per(F.col("n"), F.col("p")))) == [
        (1, None),
        (2, None),
        (3, 0.0),
        (4, None),
    ]


@pytest.mark.parametrize(
    "value, lo, hi, invert, expected",
    [
        (5.0, 0.0, 10.0, False, 50.0),
        (5.0, 0.0, 10.0, True, 50.0),
        (12.0, 0.0, 10.0, False, 100.0),
        (-1.0, 0.0, 10.0, True, 100.0),
        (None, 0.0, 10.0, True, 0.0),
        (3.0, 3.0, 3.0, True, 0.0),
        (float("nan"), 0.0, 10.0, False, 0.0),
    ],
)
def test_percent_of_range(spark, value, lo, hi, invert, expected):
    column = F.lit(value).cast("double")
    assert one(spark, fn.percent_of_range(column, F.lit(lo), F.lit(hi), invert)) == expected


def test_score_tier(spark):
    df = spark.createDataFrame([(66.0,), (65.9,), (33.0,), (32.9,), (None,)], "s double")
    tiers = dict(rows(df.select("s", fn.score_tier(F.col("s")))))
    assert tiers == {66.0: "good", 65.9: "warn", 33.0: "warn", 32.9: "bad", None: "n/a"}


def test_pair_correlation(spark):
    data = [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 9.0, 5.0), (None, 1.0, 5.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    both = df.filter("a IS NOT NULL AND b IS NOT NULL")
    expected = both.agg(F.corr("a", "b")).first()[0]
    got, flat = df.agg(
        fn.pair_correlation(F.col("a"), F.col("b")), fn.pair_correlation(F.col("a"), F.col("c"))
    ).first()
    assert math.isclose(got, expected)
    assert flat is None
    assert df.limit(1).agg(fn.pair_correlation(F.col("a"), F.col("b"))).first()[0] is None
