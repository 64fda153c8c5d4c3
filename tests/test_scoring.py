import math
import statistics

import pytest
from conftest import rows

from areascore.operators import scoring

SPEC = scoring.ScoreSpec(
    directions={"a": -1, "b": 1},
    subscores={"first": ["a", "b"], "second": ["b"]},
    weights={"first": 0.75, "second": 0.25},
    gate_measure="b",
    gate_count="n",
    gate_min=20,
)


def frame(spark, data):
    return spark.createDataFrame(data, "k string, a double, b double, n long")


def test_zscores_impute_the_mean(spark):
    df = frame(spark, [("x", 1.0, 5.0, 1), ("y", 3.0, None, 1), ("z", 8.0, 5.0, 1)])
    got = {row["k"]: (row["z_a"], row["z_b"]) for row in scoring.add_zscores(df, SPEC.directions).collect()}
    mean, spread = statistics.mean([1, 3, 8]), statistics.pstdev([1, 3, 8])
    for key, value in (("x", 1), ("y", 3), ("z", 8)):
        assert math.isclose(got[key][0], -(value - mean) / spread)
        assert got[key][1] == 0.0 and math.copysign(1, got[key][1]) == 1


@pytest.mark.parametrize("data", [[("x", None, None, 1)], [("x", 2.0, None, 1), ("y", 2.0, None, 1)]])
def test_no_spread_scores_zero(spark, data):
    df = scoring.add_zscores(frame(spark, data), SPEC.directions)
    assert {(row["z_a"], row["z_b"]) for row in df.collect()} == {(0.0, 0.0)}


def test_gate_comes_before_rescale(spark):
    df = frame(
        spark,
        [("x", 1.0, 5.0, 100), ("y", 3.0, 4.0, 100), ("z", -50.0, None, 19), ("w", 2.0, None, 20), ("v", 2.0, None, None)],
    )
    scored = {row["k"]: row for row in scoring.score_areas(df, SPEC).collect()}
    assert {k: row["score_available"] for k, row in scored.items()} == {
        "x": True, "y": True, "z": False, "w": True, "v": False,
    }
    assert scored["z"]["score"] is None and scored["z"]["score_100"] is None
    kept = [row["score_100"] for row in scored.values() if row["score_available"]]
    assert min(kept) == 0.0 and math.isclose(max(kept), 100.0)
    row = scored["w"]
    assert math.isclose(row["first"], (row["z_a"] + row["z_b"]) / 2)
    assert math.isclose(row["score"], 0.75 * row["first"] + 0.25 * row["z_b"])


def test_flat_scores(spark):
    df = spark.createDataFrame([("x", 3.0), ("y", 3.0), ("z", None)], "k string, score double")
    assert rows(scoring.minmax_rescale(df, "score", "s")) == [
        ("x", 3.0, 50.0),
        ("y", 3.0, 50.0),
        ("z", None, None),
    ]
    gated = df.filter("score IS NULL")
    assert rows(scoring.minmax_rescale(gated, "score", "s")) == [("z", None, None)]


def test_statistics_are_planned_once(spark):
    df = scoring.score_areas(frame(spark, [("x", 1.0, 5.0, 100)]), SPEC)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("inline(array(scalar-subquery") == 3


def test_top_scores_break_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0), ("d", None)], "k string, s double")
    assert [r["k"] for r in scoring.top_scores(df, "s", "k", 2).collect()] == ["c", "a"]
    assert [r["k"] for r in scoring.top_scores(df, "s", "k", 3, best=False).collect()] == ["a", "b", "c"]
