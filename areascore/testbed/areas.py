"""Area features and scores: an area is a customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from areascore.functions import extract_zip, rate_per
from areascore.operators import features as ops
from areascore.operators import scoring
from areascore.operators.lookup import hit_rate, lookup_join, modal_lookup
from areascore.scratch import materialize
from areascore.testbed.cleaning import RAW_ZIP, complaints
from areascore.testbed.registry import query, r, round_columns, table

# What makes a customer area lively and dependable; unlike the civic scores, most features count in favour.
SPEC = scoring.ScoreSpec(
    directions={
        "n_inspections": 1,
        "rent_mean": 1,
        "avg_score": 1,
        "flagged_share": -1,
        "complaints_per_1k": -1,
        "population": 1,
    },
    subscores={
        "volume": ["n_inspections", "avg_score", "population"],
        "means": ["rent_mean"],
        "calm": ["flagged_share", "complaints_per_1k"],
    },
    weights={"volume": 0.45, "means": 0.2, "calm": 0.35},
    gate_measure="rent_mean",
    gate_count="n_inspections",
    gate_min=35,
)
FEATURES = list(SPEC.directions)
RATES = {"complaints_per_1k": "n_complaints", "incidents_per_1k": "total_incidents"}
FILLED = {"n_complaints": "0", "complaints_per_1k": "0.0", "n_inspections": "0", "flagged_share": "0.0"}

AREA_CODE = "concat(substring(c_mktsegment, 1, 2), lpad(CAST(c_custkey AS STRING), 12, '0'))"
POPULATION = "CAST((c_custkey % 7) * 1000 AS DOUBLE)"
OVERRIDE = "CAST(4000 + c_custkey % 1000 AS DOUBLE)"

# --- features ------------------------------------------------------------------------------


def area_names(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS area_key", f"{AREA_CODE} AS area_code", "c_name AS area_name"
    )


def population(spark, sf_dir):
    return (
        table(spark, sf_dir, "customer")
        .filter("c_custkey % 10 <> 0")
        .selectExpr("c_custkey AS area_key", f"{POPULATION} AS population")
    )


def overrides(spark, sf_dir):
    return (
        table(spark, sf_dir, "customer")
        .filter("c_custkey % 11 = 5")
        .selectExpr(f"{AREA_CODE} AS area_code", f"{OVERRIDE} AS rent_mean")
    )


INCIDENTS_SQL = """SELECT o_custkey AS area_key, count(*) AS total_incidents,
    CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS flagged_incidents,
    sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) / count(*) AS flagged_share
  FROM orders GROUP BY o_custkey"""
INSPECTIONS_SQL = """SELECT o_custkey AS area_key, count(*) AS n_inspections, avg(l_quantity) AS avg_score,
    avg(CASE WHEN l_quantity >= 28 THEN 1 ELSE 0 END) AS critical_rate
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey"""
COMPLAINTS_SQL = """SELECT user_id AS area_key, count(*) AS n_complaints FROM events
  WHERE event_type IN ('error', 'view') GROUP BY user_id"""
RENT_SQL = """SELECT c_custkey AS area_key, avg(c_acctbal) AS rent_mean FROM customer
  WHERE c_acctbal >= 0 GROUP BY c_custkey"""


@query(
    "incident_features",
    f"""SELECT area_key, total_incidents, flagged_incidents, {r('flagged_share')}
    FROM ({INCIDENTS_SQL})""",
)
def incident_features(spark, sf_dir):
    return round_columns(incidents(spark, sf_dir), "flagged_share")


def incidents(spark, sf_dir):
    facts = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("area_key"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("is_flagged"),
    )
    return ops.incident_features(
        facts, ["area_key"], "is_flagged", "total_incidents", "flagged_incidents", "flagged_share"
    )


def inspection_facts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        F.col("l_quantity").alias("score"),
        F.when(F.col("l_quantity") >= 28, 1).otherwise(0).alias("is_critical"),
    )


def inspections(spark, sf_dir):
    link = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("area_key")
    )
    return ops.linked_inspection_features(
        inspection_facts(spark, sf_dir), link, "l_orderkey", ["area_key"], "score", "is_critical"
    )


@query(
    "inspection_features",
    f"""SELECT area_key, n_inspections, {r('avg_score')}, {r('critical_rate')}
    FROM ({INSPECTIONS_SQL})""",
)
def inspection_features(spark, sf_dir):
    return round_columns(inspections(spark, sf_dir), "avg_score", "critical_rate")


@query(
    "inspection_features_by_supplier",
    f"""SELECT l_suppkey, count(*) AS n_inspections, {r('avg(l_quantity)', 'avg_score')},
      {r('avg(CASE WHEN l_quantity >= 28 THEN 1 ELSE 0 END)', 'critical_rate')}
    FROM lineitem GROUP BY l_suppkey""",
)
def inspection_features_by_supplier(spark, sf_dir):
    df = ops.inspection_features(
        inspection_facts(spark, sf_dir), ["l_suppkey"], "score", "is_critical"
    )
    return round_columns(df, "avg_score", "critical_rate")


def rents(spark, sf_dir):
    observed = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)
    return ops.mean_features(
        observed.withColumnRenamed("c_custkey", "area_key"), ["area_key"], "c_acctbal", "rent_mean"
    )


@query("rent_features", f"SELECT area_key, {r('rent_mean')} FROM ({RENT_SQL})")
def rent_features(spark, sf_dir):
    return round_columns(rents(spark, sf_dir), "rent_mean")


MERGED_SQL = f"""incidents AS ({INCIDENTS_SQL}), inspections AS ({INSPECTIONS_SQL}),
  complaints AS ({COMPLAINTS_SQL}), rents AS ({RENT_SQL}),
  names AS (SELECT c_custkey AS area_key, {AREA_CODE} AS area_code, c_name AS area_name FROM customer),
  merged AS (SELECT area_key, area_code, area_name, total_incidents, flagged_incidents, flagged_share,
      n_inspections, avg_score, critical_rate, n_complaints, rent_mean
    FROM incidents FULL JOIN inspections USING (area_key) FULL JOIN complaints USING (area_key)
      FULL JOIN rents USING (area_key) LEFT JOIN names USING (area_key))"""
PEOPLE_SQL = f"""people AS (SELECT c_custkey AS area_key, {POPULATION} AS population FROM customer
    WHERE c_custkey % 10 <> 0)"""
RATED_SQL = f"""{MERGED_SQL}, {PEOPLE_SQL},
  rated AS (SELECT merged.*, population,
      CASE WHEN population > 0 THEN total_incidents / (population / 1000.0) END AS incidents_per_1k,
      CASE WHEN population > 0 THEN n_complaints / (population / 1000.0) END AS complaints_per_1k
    FROM merged LEFT JOIN people USING (area_key))"""
FILLED_SQL = f"""{RATED_SQL},
  filled AS (SELECT * REPLACE (
      {", ".join(f"coalesce({c}, {zero}) AS {c}" for c, zero in FILLED.items())}) FROM rated)"""
FEATURES_SQL = f"""{FILLED_SQL},
  curated AS (SELECT {AREA_CODE} AS area_code, {OVERRIDE} AS curated FROM customer
    WHERE c_custkey % 11 = 5),
  features AS (SELECT filled.* REPLACE (coalesce(rent_mean, curated) AS rent_mean),
      rent_mean IS NULL AND curated IS NOT NULL AS rent_imputed
    FROM filled LEFT JOIN curated USING (area_code))"""

FEATURE_ROUNDED = ["flagged_share", "avg_score", "critical_rate", "rent_mean"]
RATE_ROUNDED = ["incidents_per_1k", "complaints_per_1k"]


def _select(names, rounded_names):
    return ", ".join(r(name) if name in rounded_names else name for name in names)


MERGED_COLUMNS = [
    "area_key",
    "area_code",
    "area_name",
    "total_incidents",
    "flagged_incidents",
    "flagged_share",
    "n_inspections",
    "avg_score",
    "critical_rate",
    "n_complaints",
    "rent_mean",
]
RATED_COLUMNS = [*MERGED_COLUMNS, "population", *RATE_ROUNDED]


def merged_features(spark, sf_dir):
    tables = [
        incidents(spark, sf_dir),
        inspections(spark, sf_dir),
        complaints(spark, sf_dir),
        rents(spark, sf_dir),
    ]
    merged = ops.merge_features(tables, ["area_key"])
    return lookup_join(merged, area_names(spark, sf_dir), "area_key").select(*MERGED_COLUMNS)


def rated_features(spark, sf_dir):
    merged = merged_features(spark, sf_dir)
    return ops.add_rates(merged, RATES, population(spark, sf_dir), "area_key").select(*RATED_COLUMNS)


def area_features(spark, sf_dir):
    """The feature table, written once: scores and result tables read it more than once."""
    filled = ops.fill_structural_nulls(rated_features(spark, sf_dir), list(FILLED))
    given = overrides(spark, sf_dir)
    features = ops.override_nulls(filled, given, "area_code", "rent_mean", "rent_imputed")
    return materialize(features, "area-features")


@query(
    "outer_join_features",
    f"WITH {MERGED_SQL} SELECT {_select(MERGED_COLUMNS, FEATURE_ROUNDED)} FROM merged",
)
def outer_join_features(spark, sf_dir):
    return round_columns(merged_features(spark, sf_dir), *FEATURE_ROUNDED)


@query(
    "per_capita_rate",
    f"""WITH {RATED_SQL} SELECT {_select(RATED_COLUMNS, FEATURE_ROUNDED + RATE_ROUNDED)}
    FROM rated""",
)
def per_capita_rate(spark, sf_dir):
    return round_columns(rated_features(spark, sf_dir), *FEATURE_ROUNDED, *RATE_ROUNDED)


@query(
    "per_capita_fallback",
    f"""SELECT area_key, total_incidents, CAST(total_incidents AS DOUBLE) AS incidents_per_1k
    FROM ({INCIDENTS_SQL})""",
)
def per_capita_fallback(spark, sf_dir):
    rated = ops.add_rates(
        incidents(spark, sf_dir), {"incidents_per_1k": "total_incidents"}, None, "area_key"
    )
    return rated.select("area_key", "total_incidents", "incidents_per_1k")


@query(
    "rate_expression",
    f"""WITH {PEOPLE_SQL}
    SELECT user_id, count(*) AS n_events,
      {r("CASE WHEN any_value(population) > 0 THEN count(*) / (any_value(population) / 1000.0) END", "events_per_1k")}
    FROM events LEFT JOIN people ON area_key = user_id GROUP BY user_id""",
)
def rate_expression(spark, sf_dir):
    people = population(spark, sf_dir).withColumnRenamed("area_key", "user_id")
    counted = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events")
    )
    rated = lookup_join(counted, people, "user_id").withColumn(
        "events_per_1k", rate_per(F.col("n_events"), F.col("population"))
    )
    return round_columns(rated.drop("population"), "events_per_1k")


@query(
    "fill_structural_nulls",
    f"""WITH {FILLED_SQL} SELECT {_select(RATED_COLUMNS, FEATURE_ROUNDED + RATE_ROUNDED)}
    FROM filled""",
)
def fill_structural_nulls(spark, sf_dir):
    filled = ops.fill_structural_nulls(rated_features(spark, sf_dir), list(FILLED))
    return round_columns(filled, *FEATURE_ROUNDED, *RATE_ROUNDED)


@query(
    "override_impute",
    f"WITH {FEATURES_SQL} SELECT area_code, {r('rent_mean')}, rent_imputed FROM features",
)
def override_impute(spark, sf_dir):
    """Of the merged areas: those with rows in any source, whether they have a name or not."""
    filled = area_features(spark, sf_dir).select("area_code", "rent_mean", "rent_imputed")
    return round_columns(filled, "rent_mean")


# --- scores --------------------------------------------------------------------------------

STATS_SQL = ", ".join(
    f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in FEATURES
)
ZSCORED_SQL = (
    f"{FEATURES_SQL}, stats AS (SELECT {STATS_SQL} FROM features), zscored AS (SELECT features.*, "
    + ", ".join(
        f"CASE WHEN coalesce(sd_{c}, 0.0) = 0 THEN 0.0 ELSE (coalesce({c}, mu_{c}) - mu_{c}) / sd_{c}"
        f" * ({d}.0) + 0.0 END AS z_{c}"
        for c, d in SPEC.directions.items()
    )
    + " FROM features, stats)"
)
SUBSCORED_SQL = (
    f"{ZSCORED_SQL}, subscored AS (SELECT *, "
    + ", ".join(
        "(" + " + ".join(f"z_{c}" for c in members) + f") / {len(members)} AS {name}"
        for name, members in SPEC.subscores.items()
    )
    + " FROM zscored)"
)
COMPOSITE_SQL = (
    f"{SUBSCORED_SQL}, composed AS (SELECT *, "
    + " + ".join(f"{weight} * {name}" for name, weight in SPEC.weights.items())
    + " AS score FROM subscored)"
)
UNSCORED = f"rent_mean IS NULL AND (n_inspections IS NULL OR n_inspections < {SPEC.gate_min})"
GATED_SQL = f"""{COMPOSITE_SQL},
  gated AS (SELECT * REPLACE (CASE WHEN {UNSCORED} THEN NULL ELSE score END AS score),
    NOT ({UNSCORED}) AS score_available FROM composed)"""
SCORED_SQL = f"""{GATED_SQL}, span AS (SELECT min(score) AS lo, max(score) AS hi FROM gated),
  scored AS (SELECT gated.*, CASE WHEN score IS NULL THEN NULL WHEN hi = lo THEN 50.0
      ELSE 100.0 * (score - lo) / (hi - lo) END AS score_100 FROM gated, span)"""
Z_COLUMNS = [f"z_{c}" for c in FEATURES]
SUB_COLUMNS = list(SPEC.subscores)


def area_scores(spark, sf_dir):
    return scoring.score_areas(area_features(spark, sf_dir), SPEC)


@query(
    "column_stats",
    f"""WITH {FEATURES_SQL}, stats AS (SELECT {STATS_SQL} FROM features)
    SELECT {", ".join(r(f"{p}_{c}") for c in FEATURES for p in ("mu", "sd"))} FROM stats""",
)
def column_stats(spark, sf_dir):
    stats = scoring.column_stats(area_features(spark, sf_dir), FEATURES)
    return round_columns(stats, *stats.columns)


@query(
    "zscore",
    f"WITH {ZSCORED_SQL} SELECT area_code, {', '.join(map(r, Z_COLUMNS))} FROM zscored",
)
def zscore(spark, sf_dir):
    df = scoring.add_zscores(area_features(spark, sf_dir), SPEC.directions)
    return round_columns(df.select("area_code", *Z_COLUMNS), *Z_COLUMNS)


@query(
    "subscores",
    f"WITH {SUBSCORED_SQL} SELECT area_code, {', '.join(map(r, SUB_COLUMNS))} FROM subscored",
)
def subscores(spark, sf_dir):
    df = scoring.add_zscores(area_features(spark, sf_dir), SPEC.directions)
    df = scoring.add_subscores(df, SPEC.subscores)
    return round_columns(df.select("area_code", *SUB_COLUMNS), *SUB_COLUMNS)


@query(
    "composite_score", f"WITH {COMPOSITE_SQL} SELECT area_code, {r('score')} FROM composed"
)
def composite_score(spark, sf_dir):
    df = scoring.add_zscores(area_features(spark, sf_dir), SPEC.directions)
    df = scoring.add_subscores(df, SPEC.subscores)
    df = scoring.add_composite(df, SPEC.weights, SPEC.composite)
    return round_columns(df.select("area_code", "score"), "score")


@query(
    "score_gate",
    f"WITH {GATED_SQL} SELECT area_code, {r('score')}, score_available FROM gated",
)
def score_gate(spark, sf_dir):
    df = scoring.add_zscores(area_features(spark, sf_dir), SPEC.directions)
    df = scoring.add_subscores(df, SPEC.subscores)
    df = scoring.gate_scores(scoring.add_composite(df, SPEC.weights, SPEC.composite), SPEC)
    return round_columns(df.select("area_code", "score", "score_available"), "score")


@query(
    "minmax_rescale",
    f"WITH {SCORED_SQL} SELECT area_code, score_available, {r('score_100')} FROM scored",
)
def minmax_rescale(spark, sf_dir):
    df = area_scores(spark, sf_dir).select("area_code", "score_available", "score_100")
    return round_columns(df, "score_100")


SCORE_COLUMNS = [
    *RATED_COLUMNS[1:],
    "rent_imputed",
    *Z_COLUMNS,
    *SUB_COLUMNS,
    "score",
    "score_available",
    "score_100",
]
SCORE_ROUNDED = [*FEATURE_ROUNDED, *RATE_ROUNDED, *Z_COLUMNS, *SUB_COLUMNS, "score", "score_100"]


@query("area_score", f"WITH {SCORED_SQL} SELECT {_select(SCORE_COLUMNS, SCORE_ROUNDED)} FROM scored")
def area_score(spark, sf_dir):
    return round_columns(area_scores(spark, sf_dir).select(*SCORE_COLUMNS), *SCORE_ROUNDED)


def _best(spark, sf_dir, best):
    df = scoring.top_scores(area_scores(spark, sf_dir), "score", "area_code", 10, best)
    return round_columns(df.select("area_code", "area_name", "score", "score_100"), "score", "score_100")


@query(
    "top_scores",
    f"""WITH {SCORED_SQL} SELECT area_code, area_name, {r('score')}, {r('score_100')} FROM scored
    WHERE score IS NOT NULL ORDER BY scored.score DESC, area_code LIMIT 10""",
)
def top_scores(spark, sf_dir):
    return _best(spark, sf_dir, True)


@query(
    "bottom_scores",
    f"""WITH {SCORED_SQL} SELECT area_code, area_name, {r('score')}, {r('score_100')} FROM scored
    WHERE score IS NOT NULL ORDER BY scored.score, area_code LIMIT 10""",
)
def bottom_scores(spark, sf_dir):
    return _best(spark, sf_dir, False)


@query(
    "score_diagnostics",
    f"""WITH {SCORED_SQL}, ranked AS (SELECT area_code, scored.score AS s,
        row_number() OVER (ORDER BY scored.score DESC, area_code) AS best,
        row_number() OVER (ORDER BY scored.score, area_code) AS worst FROM scored WHERE score IS NOT NULL)
    SELECT 'top' AS kind, CAST(best AS INTEGER) AS rank, area_code, {r('s', 'score')} FROM ranked WHERE best <= 10
    UNION ALL SELECT 'bottom', CAST(worst AS INTEGER), area_code, {r('s', 'score')} FROM ranked WHERE worst <= 10
    UNION ALL SELECT 'unscored', NULL, area_code, NULL FROM scored WHERE NOT score_available""",
)
def score_diagnostics(spark, sf_dir):
    found = scoring.score_diagnostics(area_scores(spark, sf_dir), "area_code", "score", "score_available")
    return round_columns(found, "score")


# --- lookups -------------------------------------------------------------------------------

MODAL_SQL = f"""counted AS (SELECT regexp_extract({RAW_ZIP}, '([0-9]{{5}})', 1) AS zip,
    o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
  modal AS (SELECT zip, o_orderpriority FROM counted WHERE zip <> ''
    QUALIFY row_number() OVER (PARTITION BY zip ORDER BY n DESC, o_orderpriority) = 1)"""


def zip_lookup(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        extract_zip(F.expr(RAW_ZIP)).alias("zip"), "o_orderpriority"
    )
    return modal_lookup(rows.filter(F.col("zip") != ""), "zip", ["o_orderpriority"])


@query("modal_lookup", f"WITH {MODAL_SQL} SELECT zip, o_orderpriority FROM modal")
def modal(spark, sf_dir):
    return zip_lookup(spark, sf_dir)


LOOKED_UP_SQL = f"""{MODAL_SQL}, homes AS (
    SELECT c_custkey, CAST(10000 + c_custkey % 1013 AS STRING) AS zip FROM customer),
  placed AS (SELECT c_custkey, zip, o_orderpriority FROM homes LEFT JOIN modal USING (zip))"""


def placed_customers(spark, sf_dir):
    homes = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "CAST(10000 + c_custkey % 1013 AS STRING) AS zip"
    )
    return lookup_join(homes, zip_lookup(spark, sf_dir), "zip")


@query("lookup_join", f"WITH {LOOKED_UP_SQL} SELECT c_custkey, zip, o_orderpriority FROM placed")
def lookup(spark, sf_dir):
    return placed_customers(spark, sf_dir).select("c_custkey", "zip", "o_orderpriority")


@query(
    "hit_rate",
    f"""WITH {LOOKED_UP_SQL} SELECT count(*) AS total, count(o_orderpriority) AS hits,
      {r('100.0 * count(o_orderpriority) / greatest(count(*), 1)', 'hit_pct')} FROM placed""",
)
def hits(spark, sf_dir):
    return round_columns(hit_rate(placed_customers(spark, sf_dir), "o_orderpriority"), "hit_pct")
