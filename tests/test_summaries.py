import math

from conftest import rows
from pyspark.sql import functions as F

from areascore.operators import choropleth, profiling, reshape, summaries

METRICS = [
    summaries.Metric("s", "score", "Score", "/ 100", True),
    summaries.Metric("c", "crime", "Crime", "per 1k", False),
    summaries.Metric("e", "empty", "Empty", "", False),
    summaries.Metric("f", "flat", "Flat", "", False),
]


def areas(spark):
    return spark.createDataFrame(
        [("a", "g1", 0.0, 4.0, None, 2.0), ("b", "g1", 24.0, None, None, 2.0), ("c", "g2", 12.0, 1.0, None, 2.0)],
        "code string, grp string, score double, crime double, empty double, flat double",
    )


def long(spark):
    return reshape.long_metrics(areas(spark), ["code", "grp"], summaries.metric_map(METRICS))


def test_long_metrics_drop_nulls(spark):
    assert rows(long(spark).groupBy("metric").count()) == [("c", 2), ("f", 3), ("s", 3)]


def test_summary_keeps_empty_metrics(spark):
    table = summaries.metric_summary(long(spark), summaries.metric_table(spark, METRICS))
    got = {row["metric"]: row for row in table.collect()}
    assert (got["s"]["mean"], got["s"]["median"], got["s"]["n_areas"]) == (12.0, 12.0, 3)
    assert math.isclose(got["s"]["std"], math.sqrt(96))
    assert (got["e"]["mean"], got["e"]["n_areas"], got["e"]["label"]) == (None, 0, "Empty")
    assert rows(choropleth.summary_strip(table).filter("metric = 'f'")) == [("f", "Flat", "", 3, 2.0, 2.0, 2.0)]


def test_histogram_sparse_dense_and_flat(spark):
    sparse = rows(summaries.histogram(long(spark), 24).filter("metric = 's'"))
    assert sparse == [
        ("s", 0.5, 0.0, 1.0, 1),
        ("s", 12.5, 12.0, 13.0, 1),
        ("s", 23.5, 23.0, 24.0, 1),
    ]
    assert rows(summaries.histogram(long(spark)).filter("metric = 'f'")) == [("f", 2.0, 2.0, 2.0, 3)]
    dense = summaries.histogram(long(spark), 24, dense=True)
    assert rows(dense.groupBy("metric").agg(F.count("*"), F.sum("count"))) == [
        ("c", 24, 2),
        ("f", 1, 3),
        ("s", 24, 3),
    ]


def test_boxes_stay_within_the_data(spark):
    data = [("m", "g", float(v)) for v in [1, 2, 3, 4, 100]]
    boxes = summaries.box_stats(spark.createDataFrame(data, "metric string, grp string, value double"), "grp")
    assert rows(boxes) == [("m", "g", 2.0, 3.0, 4.0, 1.0, 7.0)]


def test_correlation_equals_pairwise(spark):
    df = spark.range(200).select(
        F.rand(1).alias("a"),
        F.when(F.col("id") % 3 != 0, F.rand(2) + F.rand(1)).alias("b"),
        F.when(F.col("id") % 4 != 0, F.rand(3)).alias("c"),
        F.lit(1.0).alias("flat"),
    )
    names = ["a", "b", "c", "flat"]
    got = {(row["feature_row"], row["feature_col"]): row["r"] for row in summaries.correlation_matrix(df, names).collect()}
    assert len(got) == 16
    for x in names[:3]:
        for y in names[:3]:
            expected = 1.0 if x == y else df.agg(F.corr(x, y)).first()[0]
            assert math.isclose(got[x, y], expected, rel_tol=1e-9)
    assert math.isnan(got["a", "flat"]) and got["flat", "flat"] == 1.0
    assert got["a", "b"] == got["b", "a"]
    wide = choropleth.pivot_matrix(summaries.correlation_matrix(df, names), "feature_row", "feature_col", "r", names[:3])
    assert wide.columns == ["position", "feature_row", "a", "b", "c"]
    assert [row["feature_row"] for row in wide.orderBy("position").collect()] == names[:3]


def test_fit_and_line(spark):
    exact = [("e", float(x), 3.0 * x + 2) for x in range(5)]
    flat = [("x", 4.0, 1.0), ("x", 4.0, 3.0)]
    single = [("n", 1.0, 7.0)]
    df = spark.createDataFrame(exact + flat + single, "feature string, x double, y double")
    fits = {row["feature"]: row for row in summaries.ols_fit(df).collect()}
    assert math.isclose(fits["e"]["slope"], 3.0) and math.isclose(fits["e"]["intercept"], 2.0)
    assert math.isclose(fits["e"]["r2"], 1.0) and math.isclose(fits["e"]["y_example_predicted"], 8.0)
    assert fits["x"]["slope"] == 0.0 and fits["x"]["intercept"] == 2.0 and math.isnan(fits["x"]["pearson_r"])
    assert fits["n"]["slope"] == 0.0 and fits["n"]["y_example_predicted"] == 7.0
    line = choropleth.ols_line(summaries.ols_fit(df)).filter("feature = 'e'")
    assert rows(line.select("x", F.round("y", 9))) == [(0.0, 2.0), (4.0, 14.0)]


def test_few_rows_give_few_deciles(spark):
    df = spark.createDataFrame(
        [("f", f"k{i}", 1.0, float(i)) for i in range(4)], "feature string, code string, x double, y double"
    )
    bins = summaries.decile_bins(df, "code")
    assert rows(bins.select("bin_index", "x_mid", "rent_median", "n_areas")) == [
        (i + 1, 1.0, float(i), 1) for i in range(4)
    ]


def test_xy_points_need_both_values(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", None, 2.0), ("c", 1.0, None)], "k string, p double, y double")
    assert rows(summaries.xy_points(df, ["p"], "y", ["k"])) == [("p", "a", 1.0, 2.0)]


def test_breaks_and_classes(spark):
    values = [float(v) for v in range(20)] + [float("nan"), float("inf")]
    df = spark.createDataFrame([("m", f"k{i:02d}", v) for i, v in enumerate(values)], "metric string, k string, value double")
    breaks = choropleth.quantile_breaks(df, "k", 7)
    expected = [float(math.floor(i / 7 * 20)) for i in range(1, 7)]
    assert [row["break_value"] for row in breaks.orderBy("break_index").collect()] == expected
    classes = {row["k"]: row["class_index"] for row in choropleth.choropleth_class(df, breaks).collect()}
    assert classes["k20"] is None and classes["k21"] is None
    assert all(classes[f"k{i:02d}"] == sum(b < i for b in expected) for i in range(20))
    tiny = spark.createDataFrame([("m", "a", 1.0), ("m", "b", 2.0)], "metric string, k string, value double")
    got = choropleth.quantile_breaks(tiny, "k", 7).orderBy("break_index").collect()
    assert [row["break_value"] for row in got] == [1.0, 1.0, 1.0, 2.0, 2.0, 2.0]


def test_ranges_and_bars(spark):
    assert rows(choropleth.metric_ranges(areas(spark), ["score", "empty"])) == [("empty", 0.0, 1.0), ("score", 0.0, 24.0)]
    bars = choropleth.add_percent_of_range(areas(spark), {"score": True, "crime": False, "flat": True})
    assert rows(bars.select("code", "score_pct", "crime_pct", "flat_pct")) == [
        ("a", 100.0, 100.0, 0.0),
        ("b", 0.0, 0.0, 0.0),
        ("c", 50.0, 0.0, 0.0),
    ]


def test_group_order_puts_null_last(spark):
    boxes = spark.createDataFrame(
        [("s", "x", 1.0), ("s", "y", None), ("s", "z", 3.0), ("c", "x", 1.0), ("c", "z", 3.0)],
        "metric string, grp string, median double",
    )
    directions = summaries.metric_table(spark, METRICS).select("metric", "higher_is_better")
    order = choropleth.group_order(boxes, directions, "grp").orderBy("metric", "position").collect()
    assert [(row["metric"], row["grp"]) for row in order] == [("c", "x"), ("c", "z"), ("s", "z"), ("s", "x"), ("s", "y")]


def test_profile(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (7.0,), (7.0,), (-1.0,), (None,)], "v double")
    row = profiling.profile_numeric(df, ["v"], F.col("v") >= 0).first()
    assert (row["count"], row["mean"], row["median"], row["mode"]) == (5, 3.8, 2.0, 2.0)
    assert math.isclose(row["std"], math.sqrt(8.7)) and (row["min"], row["max"]) == (1.0, 7.0)
    survey = profiling.schema_survey({"d": df})
    assert rows(survey) == [("d", 0, "v", "double", 1, 7)]
