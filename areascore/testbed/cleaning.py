"""Cleaning, scalar expressions and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from areascore.functions import (
    binary_flag,
    extract_zip,
    guarded_ratio,
    normalize_text,
    prefix_lookup,
    to_double,
)
from areascore.operators import cleaning as ops
from areascore.operators.features import count_features
from areascore.operators.reshape import latest_per_key, melt, union_all
from areascore.testbed.registry import query, r, round_columns, rounded, table

# Padded, mixed-case, blank, sentinel and missing text, by key. Both engines read this.
RAW_SEGMENT = """CASE WHEN c_custkey % 13 = 0 THEN NULL
     WHEN c_custkey % 17 = 1 THEN ' (null) '
     WHEN c_custkey % 19 = 2 THEN '   '
     WHEN c_custkey % 3 = 0 THEN '  ' || lower(c_mktsegment) || ' '
     ELSE c_mktsegment END"""
RAW_SCORE = """CASE WHEN l_orderkey % 11 = 0 THEN 'N/A' WHEN l_orderkey % 13 = 0 THEN NULL
     ELSE CAST(l_quantity AS STRING) END"""
RAW_ZIP = """CASE WHEN o_orderkey % 7 = 0 THEN 'NY ' || CAST(10000 + o_custkey % 997 AS STRING) || '-1234'
     WHEN o_orderkey % 7 = 1 THEN CAST(10000 + o_custkey % 997 AS STRING) || '.0'
     WHEN o_orderkey % 7 = 2 THEN 'none'
     WHEN o_orderkey % 7 = 3 THEN NULL
     ELSE CAST(10000 + o_custkey % 997 AS STRING) END"""
GROUPS = {"AU": "Auto", "BU": "Building", "FU": "Furniture", "HO": "Household"}


def raw_customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name AS `Area Name`", f"{RAW_SEGMENT} AS `Raw Segment`", "c_acctbal"
    )


RAW_CUSTOMERS_SQL = f"""WITH raw AS (
  SELECT c_custkey, c_name AS "Area Name", {RAW_SEGMENT} AS "Raw Segment", c_acctbal FROM customer)"""


@query(
    "project_rename",
    f"""{RAW_CUSTOMERS_SQL}
    SELECT "Raw Segment" AS segment, c_custkey AS area_key, "Area Name" AS area_name FROM raw""",
)
def project_rename(spark, sf_dir):
    names = {"Raw Segment": "segment", "c_custkey": "area_key", "Area Name": "area_name"}
    return ops.project_rename(raw_customers(spark, sf_dir), names)


@query(
    "dropna_subset",
    f"""{RAW_CUSTOMERS_SQL}
    SELECT c_custkey, "Raw Segment" AS segment FROM raw WHERE "Raw Segment" IS NOT NULL""",
)
def dropna_subset(spark, sf_dir):
    df = raw_customers(spark, sf_dir).select("c_custkey", F.col("`Raw Segment`").alias("segment"))
    return ops.drop_missing(df, ["segment"])


@query(
    "normalize_text",
    f"""{RAW_CUSTOMERS_SQL} SELECT c_custkey, upper(trim("Raw Segment")) AS segment FROM raw""",
)
def normalize(spark, sf_dir):
    return raw_customers(spark, sf_dir).select(
        "c_custkey", normalize_text(F.col("`Raw Segment`")).alias("segment")
    )


@query(
    "drop_sentinels",
    f"""{RAW_CUSTOMERS_SQL}
    SELECT c_custkey, upper(trim("Raw Segment")) AS segment FROM raw
    WHERE upper(trim("Raw Segment")) <> '(NULL)' AND upper(trim("Raw Segment")) <> ''""",
)
def drop_sentinels(spark, sf_dir):
    return ops.drop_sentinels(normalize(spark, sf_dir), {"segment": ["(NULL)", ""]})


@query(
    "clean_events",
    f"""{RAW_CUSTOMERS_SQL}
    SELECT c_custkey AS area_key, upper(trim("Raw Segment")) AS segment, c_acctbal AS balance,
           CAST(CASE WHEN upper(trim("Raw Segment")) = 'BUILDING' THEN 1 ELSE 0 END AS INTEGER)
             AS is_building
    FROM raw WHERE "Raw Segment" IS NOT NULL AND c_acctbal IS NOT NULL
      AND upper(trim("Raw Segment")) NOT IN ('(NULL)', '')""",
)
def clean_events(spark, sf_dir):
    spec = ops.CleanSpec(
        columns={"c_custkey": "area_key", "Raw Segment": "segment", "c_acctbal": "balance"},
        required=["segment", "balance"],
        upper=["segment"],
        sentinels={"segment": ["(NULL)", ""]},
        flags={"is_building": F.col("segment") == "BUILDING"},
    )
    return ops.clean_events(raw_customers(spark, sf_dir), spec)


@query(
    "binary_flag",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {RAW_SCORE} AS raw_score,
      CAST(CASE WHEN TRY_CAST({RAW_SCORE} AS DOUBLE) >= 28 THEN 1 ELSE 0 END AS INTEGER) AS is_critical
    FROM lineitem""",
)
def flag(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", f"{RAW_SCORE} AS raw_score"
    )
    return df.withColumn("is_critical", binary_flag(to_double(F.col("raw_score")) >= 28))


@query(
    "category_filter",
    "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'view')",
)
def category_filter(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "event_type")
    return ops.keep_categories(df, "event_type", ["error", "view"])


@query(
    "extract_zip",
    f"""SELECT o_orderkey, regexp_extract({RAW_ZIP}, '([0-9]{{5}})', 1) AS zip FROM orders""",
)
def zip_code(spark, sf_dir):
    raw = F.expr(RAW_ZIP)
    return table(spark, sf_dir, "orders").select("o_orderkey", extract_zip(raw).alias("zip"))


@query(
    "regex_filter",
    """SELECT p_partkey, p_name, p_brand FROM part
    WHERE p_brand = 'Brand#11' OR regexp_matches(p_type, '(?i)standard')""",
)
def regex_filter(spark, sf_dir):
    df = ops.keep_region(
        table(spark, sf_dir, "part"), "p_brand", "Brand#11", ["p_type", "absent"], "standard"
    )
    return df.select("p_partkey", "p_name", "p_brand")


@query(
    "prefix_lookup",
    """SELECT c_custkey, CASE left(c_mktsegment, 2) WHEN 'AU' THEN 'Auto' WHEN 'BU' THEN 'Building'
      WHEN 'FU' THEN 'Furniture' WHEN 'HO' THEN 'Household' ELSE 'Other' END AS area_group
    FROM customer""",
)
def prefix(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", prefix_lookup(F.col("c_mktsegment"), GROUPS).alias("area_group")
    )


@query(
    "guarded_ratio",
    f"""SELECT user_id, count(*) AS total,
      {r("CASE WHEN count(*) FILTER (event_type = 'view') > 0 THEN count(*) FILTER (event_type = 'error') / count(*) FILTER (event_type = 'view') ELSE 0.0 END", "errors_per_view")}
    FROM events GROUP BY user_id""",
)
def ratio(spark, sf_dir):
    counted = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("event_type") == "error").alias("errors"),
            F.count_if(F.col("event_type") == "view").alias("views"),
        )
    )
    return counted.select(
        "user_id",
        "total",
        rounded(guarded_ratio(F.col("errors"), F.col("views"))).alias("errors_per_view"),
    )


# One column of lineitem price sums per ship year, some of them emptied by rule.
YEARS = [f"{year}-12-31" for year in range(1995, 2002)]
WIDE_SQL = "WITH wide AS (SELECT s_nationkey AS region_name, " + ", ".join(
    f"""CASE WHEN s_nationkey % 7 = {i} THEN NULL
      ELSE sum(l_extendedprice) FILTER (year(l_shipdate) = {1995 + i}) END AS "{name}" """
    for i, name in enumerate(YEARS)
) + " FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY s_nationkey)"
MELT_SQL = "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT region_name, '{name}' AS month, "{name}" AS value FROM wide""" for name in YEARS
) + ") WHERE value IS NOT NULL"


def wide_series(spark, sf_dir):
    """Per-supplier sums first, so the join with suppliers moves one row per supplier and year."""
    per_supplier = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.year("l_shipdate").alias("year"))
        .agg(F.sum("l_extendedprice").alias("price"))
    )
    nations = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("region_name")
    )
    cells = [
        F.when(
            F.col("region_name") % 7 != i,
            F.sum(F.when(F.col("year") == 1995 + i, F.col("price"))),
        ).alias(name)
        for i, name in enumerate(YEARS)
    ]
    return per_supplier.join(nations, "l_suppkey").groupBy("region_name").agg(*cells)


def long_series(spark, sf_dir):
    wide = wide_series(spark, sf_dir)
    return melt(wide, ["region_name"], ops.measure_columns(wide), "month", "value")


@query(
    "melt_wide",
    f"{WIDE_SQL} SELECT region_name, month, {r('value', digits=2)} FROM ({MELT_SQL})",
)
def melt_wide(spark, sf_dir):
    return round_columns(long_series(spark, sf_dir), "value", digits=2)


@query(
    "latest_per_key",
    f"""{WIDE_SQL}, long AS ({MELT_SQL})
    SELECT region_name, month, {r('value', digits=2)} FROM long
    QUALIFY row_number() OVER (PARTITION BY region_name ORDER BY month DESC) = 1""",
)
def latest(spark, sf_dir):
    rows = latest_per_key(long_series(spark, sf_dir), ["region_name"], "month")
    return round_columns(rows, "value", digits=2)


@query(
    "union_by_name",
    """SELECT c_custkey AS key, c_name AS name, 'customer' AS kind FROM customer
    UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier
    UNION ALL SELECT p_partkey, p_name, 'part' FROM part""",
)
def union_by_name(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.lit("customer").alias("kind")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"), F.lit("part").alias("kind"), F.col("p_partkey").alias("key")
    )
    return union_all([customers, suppliers, parts])


@query(
    "complaint_features",
    """SELECT user_id AS area_key, count(*) AS n_complaints FROM events
    WHERE event_type IN ('error', 'view') GROUP BY user_id""",
)
def complaints(spark, sf_dir):
    df = ops.keep_categories(table(spark, sf_dir, "events"), "event_type", ["error", "view"])
    return count_features(
        df.select(F.col("user_id").alias("area_key")), ["area_key"], "n_complaints"
    )
