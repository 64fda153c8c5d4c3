"""Shapes of physical plans that must hold whatever the size of the tables."""

from pyspark.sql import functions as F

from areascore.testbed import QUERIES, areas
from areascore.testbed.registry import table

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_filter_and_prune_at_the_scan(spark):
    plan = plan_of(QUERIES["rent_features"](spark, SF_DIR))
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan
    plan = plan_of(QUERIES["complaint_features"](spark, SF_DIR))
    assert "In(event_type, [error,view])" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_cleaning_is_one_stage(spark):
    for name in ("clean_events", "binary_flag", "extract_zip", "drop_sentinels"):
        assert "Exchange" not in plan_of(QUERIES[name](spark, SF_DIR))


def test_inspections_are_summed_before_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(areas.inspections(spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan.index("SortMergeJoin")
    # The line item side of the join: already aggregated, both before and after its exchange.
    assert plan[join:].count("partial_sum(score") == 1


def test_merging_features_shuffles_each_source_once(spark):
    tables = [areas.incidents(spark, SF_DIR), areas.rents(spark, SF_DIR), areas.complaints(spark, SF_DIR)]
    merged = areas.ops.merge_features(tables, ["area_key"])
    assert plan_of(merged).count("Exchange hashpartitioning") <= len(tables) + 1


def test_top_bottom_limits_before_its_shuffle(spark):
    plan = plan_of(QUERIES["top_bottom"](spark, SF_DIR))
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert sum("Partial" in line for line in limits) == 2
    assert sum("Final" in line for line in limits) == 2


def test_top_scores_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_scores"](spark, SF_DIR))


def test_small_index_is_broadcast_and_points_stay(spark):
    from areascore.operators.spatial import build_cells, locate_points
    from areascore.testbed import places

    index = build_cells(places.polygons(spark, SF_DIR))
    points = places.points(spark, SF_DIR)
    plan = plan_of(locate_points(points, index, "x", "y"))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(locate_points(points, index, "x", "y", broadcast_bytes=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_levels_of_a_large_index_are_one_join(spark):
    """Squares of twelve sizes, none of which is sent whole: two joins, as for one size."""
    from areascore.operators.spatial import build_cells, locate_points

    squares = spark.range(120).select(
        F.col("id").alias("ord"),
        F.concat(F.lit("A"), F.col("id").cast("string")).alias("area_code"),
        F.lit("n").alias("area_name"),
        (F.col("id") * 3 % 100).cast("double").alias("x"),
        F.pow(F.lit(2.0), F.col("id") % 12 - 4).alias("d"),
    )
    corners = [("x", "x"), ("x + d", "x"), ("x + d", "x + d"), ("x", "x + d"), ("x", "x")]
    edges = ", ".join(
        f"named_struct('x1', {a}, 'y1', {b}, 'x2', {c}, 'y2', {d})" for (a, b), (c, d) in zip(corners, corners[1:])
    )
    polygons = squares.selectExpr(
        "ord", "area_code", "area_name", f"array({edges}) AS edges",
        "x AS min_x", "x + d AS max_x", "x AS min_y", "x + d AS max_y",
    )
    index = build_cells(polygons)
    assert len(index.levels) == 12
    points = spark.range(2000).select("id", (F.rand(1) * 110).alias("x"), (F.rand(2) * 110).alias("y"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = locate_points(points, index, "x", "y", broadcast_bytes=0)
        plan = plan_of(shuffled)
        assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") <= 6
        sent = locate_points(points, index, "x", "y")
        assert shuffled.exceptAll(sent).count() == 0 and shuffled.filter("area_code IS NOT NULL").count() > 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_customer_is_aggregated_before_the_shuffle(spark):
    """A third of all orders on one customer: each task still sends one row per customer."""
    orders = table(spark, SF_DIR, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey"))
    )
    facts = orders.select(F.col("o_custkey").alias("area"), (F.col("o_orderkey") % 2).alias("flag"))
    from areascore.operators.features import incident_features

    features = incident_features(facts, ["area"], "flag", "n", "flagged", "share")
    plan = plan_of(features)
    assert plan.index("Exchange") < plan.index("partial_count")
    row = features.filter("area = 1").first()
    assert row["n"] == facts.filter("area = 1").count()


def test_hot_place_of_a_large_index_is_split(spark):
    """A third of the points at one place, an index too large to broadcast: the place's rows spread."""
    from areascore.operators.spatial import build_cells, locate_points
    from areascore.testbed import places

    index = build_cells(places.polygons(spark, SF_DIR))
    points = spark.range(0, 60_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0.3).otherwise(F.rand(1) * 60).alias("x"),
        F.when(F.col("id") % 3 == 0, 0.4).otherwise(F.rand(2) * 60).alias("y"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        located = locate_points(points, index, "x", "y", broadcast_bytes=0)
        pieces = located.groupBy(F.spark_partition_id().alias("piece")).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("id") % 3 == 0).alias("hot")
        )
        sizes = pieces.collect()
        assert sum(row["rows"] for row in sizes) == 60_000
        assert sum(row["hot"] > 0 for row in sizes) >= 4 and max(row["hot"] for row in sizes) < 10_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
