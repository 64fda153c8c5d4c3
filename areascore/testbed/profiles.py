"""A first look at the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from areascore.operators import profiling as ops
from areascore.operators import sketches
from areascore.operators.reshape import long_metrics
from areascore.scratch import materialize
from areascore.testbed.registry import query, r, round_columns, rounded, table

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]
# Columns whose median lies well inside the rows of one value: there the sketch and exact SQL agree
# without an accuracy that would make the sketch as large as the table.
PROFILED = ["l_linenumber", "l_discount", "l_tax"]
SURVEYED = ["customer", "events", "orders"]
# Column name -> type in the survey.
SURVEY_TYPES = {
    "customer": {
        "c_custkey": "bigint",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    "events": {
        "event_id": "bigint",
        "ts": "timestamp_ntz",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
        "props": "string",
    },
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
}


@query("distinct_values", "SELECT DISTINCT p_type FROM part")
def distinct_values(spark, sf_dir):
    return ops.distinct_values(table(spark, sf_dir, "part"), "p_type")


@query("counts_per_key", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1")
def counts_per_key(spark, sf_dir):
    return ops.counts_per_key(table(spark, sf_dir, "orders"), "o_orderpriority")


@query(
    "filtered_counts",
    "SELECT l_returnflag, count(*) AS count FROM lineitem WHERE l_quantity >= 28 GROUP BY 1",
)
def filtered_counts(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return ops.counts_per_key(df, "l_returnflag", F.col("l_quantity") >= 28)


@query(
    "flag_distribution",
    """SELECT CAST(CASE WHEN l_quantity >= 28 THEN 1 ELSE 0 END AS INTEGER) AS is_critical,
      count(*) AS count FROM lineitem GROUP BY 1""",
)
def flag_distribution(spark, sf_dir):
    flagged = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_quantity") >= 28, 1).otherwise(0).alias("is_critical")
    )
    return ops.flag_distribution(flagged, "is_critical")


@query(
    "record_counts",
    """SELECT 'orders' AS dataset, count(*) AS records FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'events', count(*) FROM events""",
)
def record_counts(spark, sf_dir):
    names = ["orders", "lineitem", "events"]
    return ops.record_counts({name: table(spark, sf_dir, name) for name in names})


@query(
    "approx_quantile",
    "SELECT probability, quantile_disc_value AS value FROM ("
    + " UNION ALL ".join(
        f"""SELECT CAST({p} AS DOUBLE) AS probability,
        quantile_disc(l_quantity, {p}) AS quantile_disc_value FROM lineitem"""
        for p in (0.25, 0.5, 0.75)
    )
    + ")",
)
def approx_quantile(spark, sf_dir):
    return ops.approx_quantiles(
        table(spark, sf_dir, "lineitem"), "l_quantity", [0.25, 0.5, 0.75], 1e-5
    )


def _modes(names):
    return "modes AS (" + " UNION ALL ".join(
        f"""(SELECT '{name}' AS metric, {name}::DOUBLE AS mode FROM lineitem GROUP BY {name}
        ORDER BY count(*) DESC, {name} LIMIT 1)"""
        for name in names
    ) + ")"


@query("numeric_mode", f"WITH {_modes(NUMBERS)} SELECT metric, mode FROM modes")
def numeric_mode(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return ops.numeric_mode(long_metrics(lines, [], {name: name for name in NUMBERS}))


@query(
    "profile_numeric",
    f"""WITH {_modes(PROFILED)}, stats AS ({" UNION ALL ".join(
        f'''SELECT '{name}' AS metric, count({name}) AS count, avg({name}) AS mean,
        quantile_disc({name}::DOUBLE, 0.5) AS median, stddev_samp({name}) AS std,
        min({name}::DOUBLE) AS min, max({name}::DOUBLE) AS max
        FROM lineitem WHERE l_quantity > 0''' for name in PROFILED)})
    SELECT metric, count, {r('mean', digits=4)}, median, {r('std', digits=4)}, min, max, mode
    FROM stats JOIN modes USING (metric)""",
)
def profile_numeric(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    profile = ops.profile_numeric(lines, PROFILED, F.col("l_quantity") > 0)
    return round_columns(profile, "mean", "std", digits=4)


@query(
    "schema_survey",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS dataset, CAST({i} AS INTEGER) AS position, '{column}' AS "column",
        '{kind}' AS type, count(*) - count({column}) AS nulls, count(*) AS records FROM {name}"""
        for name, columns in SURVEY_TYPES.items()
        for i, (column, kind) in enumerate(columns.items())
    ),
)
def schema_survey(spark, sf_dir):
    return ops.schema_survey({name: table(spark, sf_dir, name) for name in SURVEYED})


@query(
    "quantile_rollup",
    f"""WITH g AS (SELECT l_returnflag, count(*) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
      FROM lineitem GROUP BY ALL)
    SELECT l_returnflag, probability, n, TRUE AS within_bound,
      {r("CASE probability WHEN 0 THEN lo WHEN 1 THEN hi END", "extreme")}
    FROM g, (SELECT unnest([0, 0.1, 0.25, 0.5, 0.75, 0.9, 1])::DOUBLE AS probability)""",
)
def quantile_rollup(spark, sf_dir):
    """Prices sketched by flag and ship day, stored, and merged by flag; their ranks counted in the rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate", "l_extendedprice")
    daily = sketches.sketch_values(lines, ["l_returnflag", "l_shipdate"], "l_extendedprice")
    merged = sketches.merge_sketches(materialize(daily, "daily-sketches"), ["l_returnflag"])
    found = sketches.sketch_quantiles(merged, ["l_returnflag"], [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1])
    found = materialize(found, "quantiles")
    met = lines.join(found, "l_returnflag").groupBy("l_returnflag", "probability", "n", "value")
    ranks = met.agg(
        F.count_if(F.col("l_extendedprice") < F.col("value")).alias("below"),
        F.count_if(F.col("l_extendedprice") <= F.col("value")).alias("up_to"),
    )
    p, slack = F.col("probability"), F.lit(sketches.rank_error()) * F.col("n") + 1
    return ranks.select(
        "l_returnflag",
        "probability",
        "n",
        ((F.col("below") <= p * F.col("n") + slack) & (F.col("up_to") >= p * F.col("n") - slack)).alias("within_bound"),
        rounded(F.when(p.isin(0.0, 1.0), F.col("value"))).alias("extreme"),
    )
