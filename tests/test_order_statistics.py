"""Values at positions, against sorted lists."""

import math
import random

import pytest
from pyspark.sql import functions as F

from areascore.operators import order_statistics
from areascore.operators.order_statistics import exact_quantiles, values_at

SHARES = [0.0, 0.001, 0.1, 0.5, 0.9, 0.999, 1.0]


def lists():
    draw = random.Random(9)
    return {
        "normal": [draw.gauss(0, 1) for _ in range(2000)],
        "wide": [draw.choice([-1, 1]) * 10.0 ** draw.uniform(-300, 300) for _ in range(1500)],
        "ties": [float(draw.randint(-3, 3)) for _ in range(2000)],
        "one": [2.5] * 700,
        "single": [-7.0],
        "close": [1.0 + i * 2.0**-52 for i in range(900)],
        "zeros": [0.0, -0.0, 5e-324, -5e-324] * 50,
        "ends": [-1.7e308, 1.7e308, 0.0, 1.0] * 20,
        "odd": [math.nan, math.inf, -math.inf, 3.0, 1.0, None],
        "none": [None, math.nan],
    }


@pytest.fixture(scope="module")
def long(spark):
    rows = [(name, v) for name, values in lists().items() for v in values]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "metric string, value double").repartition(5)


def test_quantiles(long):
    got = {(r.metric, r.share): r.value for r in exact_quantiles(long, SHARES).collect()}
    want = {}
    for name, values in lists().items():
        known = sorted(v for v in values if v is not None and math.isfinite(v))
        for p in SHARES if known else []:
            want[name, p] = known[max(math.ceil(p * len(known)) - 1, 0)]
    assert got == want


def test_two_bins_do(long):
    some = long.filter("metric in ('normal', 'close', 'wide')")
    at = lambda n: F.array(F.struct(F.lit(0).alias("label"), F.floor(n / 3).alias("at")))
    got = {r.metric: r.value for r in values_at(some, at, bins=2).collect()}
    assert got == {name: sorted(lists()[name])[len(lists()[name]) // 3] for name in ("normal", "close", "wide")}


def test_no_row_is_moved(spark, long, monkeypatch):
    """Every exchange of a pass stands above a partial count."""
    plans = []
    materialize = order_statistics.materialize

    def spy(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, label)

    monkeypatch.setattr(order_statistics, "materialize", spy)
    exact_quantiles(long.filter("metric = 'normal'"), [0.5]).collect()
    assert 2 <= len(plans) <= 8
    for plan in plans[1:]:
        lines = plan.splitlines()
        first = next(i for i, line in enumerate(lines) if "partial_count" in line)
        assert "BroadcastHashJoin" in "".join(lines[first:]) and "rangepartitioning" not in plan
        # The side of the values comes before the side of the ranges, which is sent to every task.
        ranges = next(i for i, line in enumerate(lines) if i > first and "BroadcastExchange" in line)
        assert not any("Exchange hashpartitioning" in line for line in lines[first + 1 : ranges])


def test_empty(spark):
    assert exact_quantiles(spark.createDataFrame([], "metric string, value double"), [0.5]).count() == 0
