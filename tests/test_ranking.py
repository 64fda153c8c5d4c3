import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from areascore.operators.ranking import global_rank, ntile_of, top_bottom


@pytest.mark.parametrize("pieces", [1, 7, 40])
def test_global_rank_with_a_hot_value(spark, pieces):
    rng = random.Random(pieces)
    data = [
        (g, 5.0 if rng.random() < 0.4 else rng.uniform(0, 10), f"k{i:05d}")
        for i in range(3000)
        for g in (["m1"] if i % 5 else ["m1", "m2"])
    ]
    df = spark.createDataFrame(data, "metric string, value double, k string")
    ranked = global_rank(df, "metric", [F.asc("value"), F.asc("k")], pieces=pieces)
    expected = []
    for group in ("m1", "m2"):
        members = sorted(((v, k) for g, v, k in data if g == group))
        expected += [(group, v, k, i + 1, len(members)) for i, (v, k) in enumerate(members)]
    assert rows(ranked) == sorted(expected, key=repr)


def test_hot_value_is_cut_into_pieces(spark):
    """One value in a third of all rows still spreads over several pieces."""
    df = spark.range(30_000).select(
        F.lit("m").alias("metric"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(3)).alias("value"),
        F.col("id"),
    )
    cut = df.repartitionByRange(16, "metric", "value", "id").withColumn("p", F.spark_partition_id())
    sizes = [row["count"] for row in cut.groupBy("p").count().collect()]
    assert max(sizes) < 30_000 / 8
    assert cut.filter("value = 0.5").select("p").distinct().count() >= 4


@pytest.mark.parametrize("n, k", [(1, 10), (7, 10), (10, 10), (23, 10), (100, 7), (13, 13), (14, 13)])
def test_ntile(spark, n, k):
    df = spark.range(1, n + 1).select(F.col("id").alias("rn"), F.lit(n).cast("long").alias("n"))
    got = [row[0] for row in df.orderBy("rn").select(ntile_of(F.col("rn"), F.col("n"), k)).collect()]
    df.createOrReplaceTempView("ranks")
    sql = f"SELECT ntile({k}) OVER (ORDER BY rn) AS t, rn FROM ranks ORDER BY rn"
    assert got == [row["t"] for row in spark.sql(sql).collect()]


def test_top_bottom_small_and_tied(spark):
    long = spark.createDataFrame(
        [("s", "a", 1.0), ("s", "b", 1.0), ("s", "c", 3.0), ("c", "a", 1.0), ("c", "b", 2.0)],
        "metric string, code string, value double",
    )
    directions = spark.createDataFrame([("s", True), ("c", False)], "metric string, higher_is_better boolean")
    got = rows(top_bottom(long, directions, ["code"], 2))
    assert got == sorted(
        [
            ("s", "top", 1, "c", 3.0),
            ("s", "top", 2, "a", 1.0),
            ("s", "bottom", 1, "a", 1.0),
            ("s", "bottom", 2, "b", 1.0),
            ("c", "top", 1, "a", 1.0),
            ("c", "top", 2, "b", 2.0),
            ("c", "bottom", 1, "b", 2.0),
            ("c", "bottom", 2, "a", 1.0),
        ],
        key=repr,
    )
