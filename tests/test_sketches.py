import random

from conftest import rows
from pyspark.sql import functions as F

from areascore.operators import sketches


def values(spark, n=60_000):
    """A group with most of the rows, small ones, null keys, and values that are not numbers."""
    random_ = random.Random(5)
    out = [("hot" if i % 3 else random_.choice(["a", "b", None]), i % 17, random_.lognormvariate(0, 2)) for i in range(n)]
    out += [("a", 3, None), ("b", 3, float("nan")), ("b", 4, float("inf")), ("empty", 1, None), ("one", 1, 2.5)]
    return spark.createDataFrame(out, "grp string, day int, value double").repartition(6)


def test_merged_sketches_keep_the_rank_error(spark):
    df = values(spark)
    k, asked = 256, [0, 0.01, 0.25, 0.5, 0.9, 0.99, 1]
    daily = sketches.sketch_values(df, ["grp", "day"], "value", k)
    merged = sketches.sketch_quantiles(sketches.merge_sketches(daily, ["grp"], k), ["grp"], asked)
    once = sketches.sketch_quantiles(sketches.sketch_values(df, ["grp"], "value", k), ["grp"], asked)
    exact = {}
    for row in df.filter("value < double('inf')").collect():
        exact.setdefault(row.grp, []).append(row.value)
    for frame in (merged, once):
        got = frame.collect()
        assert {r.grp for r in got} == set(exact) == {"hot", "a", "b", "one", None}
        for r in got:
            all_values = sorted(exact[r.grp])
            assert r.n == len(all_values)
            if r.probability in (0, 1):
                assert r.value == all_values[-int(r.probability)]
            slack = sketches.rank_error(k) * r.n + 1
            assert sum(v < r.value for v in all_values) <= r.probability * r.n + slack
            assert sum(v <= r.value for v in all_values) >= r.probability * r.n - slack


def test_merging_in_steps_counts_every_row(spark):
    daily = sketches.sketch_values(values(spark), ["grp", "day"], "value")
    weekly = sketches.merge_sketches(daily.withColumn("week", F.expr("day DIV 7")), ["grp", "week"])
    total = sketches.merge_sketches(weekly, [])
    assert total.select("n").first()[0] == 60_001
    assert rows(sketches.merge_sketches(weekly, ["grp"]).select("grp", "n")) == rows(
        sketches.merge_sketches(daily, ["grp"]).select("grp", "n")
    )


def test_sketches_are_small_and_folded_before_the_shuffle(spark):
    daily = sketches.sketch_values(values(spark), ["grp"], "value", 64)
    assert daily.select(F.max(F.length("sketch"))).first()[0] < 4_000
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ObjectHashAggregate") == 2 and "Python" not in plan


def test_no_rows(spark):
    none = values(spark, 0).limit(0)
    daily = sketches.sketch_values(none, ["grp"], "value")
    assert sketches.sketch_quantiles(sketches.merge_sketches(daily, ["grp"]), ["grp"], [0.5]).count() == 0
