"""The five stages over a :class:`Layout`. Each reads tables and writes tables.

The functions named after a stage's work return DataFrames without running anything; the ``run_*``
functions write them. Every table is computed by its write and nothing else:
counts ride on the writes, and a table needed again is read back. The ZIP lookup, the score table and the
result tables, a few rows an area, become one file each, as a browser wants them; all others are directories.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areascore.functions import extract_zip
from areascore.operators import features as feature_ops
from areascore.operators import summaries
from areascore.operators.cleaning import (
    clean_events,
    keep_categories,
    keep_region,
    measure_columns,
)
from areascore.operators.lookup import lookup_join, zip_to_area
from areascore.operators.ranking import top_bottom
from areascore.operators.reshape import latest_per_key, long_metrics, melt
from areascore.operators.scoring import score_areas, score_diagnostics
from areascore.operators.spatial import build_cells, locate_points
from areascore.partitions import spread
from areascore.plans import civic
from areascore.sinks import count_rows, write_single_file, write_with_counts
from areascore.sources import (
    Layout,
    read_csv,
    read_dataset,
    read_lookup_csv,
    read_polygons,
    read_population,
)

# --- clean ---------------------------------------------------------------------------------


def read_raw(spark: SparkSession, layout: Layout, feed: str, multi_line: bool | None = None) -> DataFrame:
    """A raw feed, with line breaks inside quotes where the feed may have them, or as asked."""
    breaks = civic.MULTI_LINE[feed] if multi_line is None else multi_line
    return read_csv(spark, layout.raw(civic.RAW_FILES[feed]), civic.RAW_COLUMNS.get(feed), breaks)


def clean_feed(raw: DataFrame, feed: str, only_types: bool = False) -> DataFrame:
    """One cleaned point feed. ``only_types`` keeps the four food-related 311 complaint types."""
    if only_types and feed == "complaints311":
        raw = keep_categories(raw, "complaint_type", civic.COMPLAINT_TYPES)
    return clean_events(raw, civic.clean_specs()[feed])


def clean_rent(raw: DataFrame) -> DataFrame:
    """Latest known monthly rent per ZIP of the metropolitan area."""
    local = keep_region(
        raw, "City", civic.RENT_CITY, civic.RENT_PATTERN_COLUMNS, civic.RENT_PATTERN
    )
    ids = ["RegionName", "City", "State", "Metro"]
    long = melt(local, ids, measure_columns(raw), "month", "ZORI")
    latest = latest_per_key(long, ["RegionName"], "month")
    return latest.withColumnRenamed("RegionName", "ZIPCODE").select(
        "ZIPCODE", "City", "State", "Metro", "month", "ZORI"
    )


def run_clean(
    spark: SparkSession, layout: Layout, multi_line: bool | None = None, only_types: bool = False
) -> dict[str, dict[str, int]]:
    """Raw CSV to ``cleaned/*``; returns rows read, written and dropped per feed."""
    counts = {}
    for feed in [*civic.POINT_FEEDS, "rent"]:
        raw, seen = count_rows(read_raw(spark, layout, feed, multi_line))
        cleaned = clean_rent(raw) if feed == "rent" else clean_feed(raw, feed, only_types)
        written = write_with_counts(cleaned, layout.cleaned(feed))["rows"]
        rows_in = dict(seen.get)["rows"]
        counts[feed] = {"rows_in": rows_in, "rows": written, "dropped": rows_in - written}
    return counts


# --- enrich --------------------------------------------------------------------------------


def enrich_rent(rent: DataFrame, lookup: DataFrame) -> DataFrame:
    """Rent with the area of its ZIP; the key is cut to five digits first."""
    keyed = rent.withColumn("ZIPCODE", extract_zip(F.col("ZIPCODE"), pad=True))
    return lookup_join(keyed, lookup, "ZIPCODE")


def run_enrich(
    spark: SparkSession, layout: Layout, per_line: bool = False, order_field: str | None = None
) -> dict[str, dict[str, float]]:
    """``cleaned/*`` to ``enriched/*`` and the ZIP lookup; returns rows, hits and their percentage per feed."""
    polygons = read_polygons(
        spark, layout.geo(civic.POLYGON_FILE), per_line=per_line, order_field=order_field
    )
    index = build_cells(spread(polygons))
    hits = F.count("nta_code")
    counts = {}
    for feed in civic.POINT_FEEDS:
        placed = locate_points(
            spread(read_dataset(spark, layout.cleaned(feed))),
            index,
            code="nta_code",
            name="nta_name",
        )
        counts[feed] = _with_rate(write_with_counts(placed, layout.enriched(feed), hits=hits))

    restaurants = read_dataset(spark, layout.enriched("restaurants"))
    lookup = zip_to_area(restaurants, "ZIPCODE", "nta_code", "nta_name", pad=True)
    lookup_path = layout.geo(civic.ZIP_LOOKUP_FILE)
    write_single_file(lookup, lookup_path, "csv")
    rent = enrich_rent(
        read_dataset(spark, layout.cleaned("rent")), read_lookup_csv(spark, lookup_path)
    )
    counts["rent"] = _with_rate(write_with_counts(rent, layout.enriched("rent"), hits=hits))
    return counts


def _with_rate(counts: dict[str, int]) -> dict[str, float]:
    return counts | {"hit_pct": round(100 * counts["hits"] / max(counts["rows"], 1), 1)}


# --- features ------------------------------------------------------------------------------


def area_features(
    crime: DataFrame,
    restaurants: DataFrame,
    complaints: DataFrame,
    rent: DataFrame,
    population: DataFrame | None,
    overrides: Mapping[str, float] | DataFrame = civic.RENT_OVERRIDES,
    fill_rates: bool = True,
) -> DataFrame:
    """One row per area. ``fill_rates=False`` leaves the rates of areas without people null."""
    keys = civic.AREA_KEYS
    placed = F.col("nta_code").isNotNull()
    merged = feature_ops.merge_features(
        [
            feature_ops.incident_features(
                crime.filter(placed), keys, "IS_FELONY", "total_crimes", "felonies", "felony_share"
            ),
            feature_ops.inspection_features(
                restaurants.filter(placed), keys, "SCORE", "IS_CRITICAL"
            ),
            feature_ops.count_features(complaints.filter(placed), keys, "n_complaints"),
            feature_ops.mean_features(rent.filter(placed), keys, "ZORI", "median_rent_zori"),
        ],
        keys,
    )
    rated = feature_ops.add_rates(merged, civic.RATES, population, "nta_code")
    filled = [name for name in civic.FILLED if fill_rates or name not in civic.RATES]
    complete = feature_ops.fill_structural_nulls(rated, filled)
    return feature_ops.override_nulls(
        complete, overrides, "nta_code", "median_rent_zori", "median_rent_imputed"
    )


def run_features(spark: SparkSession, layout: Layout, fill_rates: bool = True) -> dict[str, int]:
    """``enriched/*`` to the feature table; returns areas and how many of them got a given rent.

    Which ones those are is in the table, as a flag.
    """
    inputs = [
        read_dataset(spark, layout.enriched(name))
        for name in ("crime", "restaurants", "complaints311", "rent")
    ]
    population = read_population(spark, layout.geo(civic.POPULATION_FILE))
    features = area_features(*inputs, population, fill_rates=fill_rates)
    imputed = F.count_if(civic.RENT_IMPUTED)
    return write_with_counts(features, layout.scores(civic.FEATURES_TABLE), imputed=imputed)


# --- score ---------------------------------------------------------------------------------


def run_score(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Feature table to score table, and the best, worst and unscored areas; returns areas and how many have none."""
    spec = civic.SCORE_SPEC
    features = read_dataset(spark, layout.scores(civic.FEATURES_TABLE))
    path = layout.scores(civic.SCORES_TABLE)
    write_single_file(score_areas(features, spec), path)
    scored = read_dataset(spark, path)
    diagnostics = score_diagnostics(scored, civic.AREA_CODE, spec.composite, spec.available)
    write_single_file(diagnostics, layout.scores(civic.DIAGNOSTICS_TABLE))
    counted = scored.agg(F.count(F.lit(1)), F.count_if(~F.col(spec.available))).first()
    return {"rows": counted[0], "unscored": counted[1]}


# --- analytics -----------------------------------------------------------------------------


def result_tables(scored: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """Result table name -> function that plans it. ``scored`` should be a stored table."""
    code, name, group = civic.AREA_CODE, civic.AREA_NAME, civic.AREA_GROUP
    ids = [code, name, group]
    grouped = feature_ops.add_group(scored, code, civic.BOROUGHS, group)
    metadata = summaries.metric_table(scored.sparkSession, civic.METRICS)
    directions = metadata.select("metric", "higher_is_better")
    long = long_metrics(grouped, ids, summaries.metric_map(civic.METRICS))
    inputs = list(civic.SCORE_SPEC.directions)
    points = summaries.xy_points(grouped, [c for c in inputs if c != civic.RENT], civic.RENT, ids)
    plans = {
        "summary": lambda: summaries.metric_summary(long, metadata, count=civic.AREA_COUNT),
        "histogram": lambda: summaries.histogram(long),
        "top_bottom": lambda: top_bottom(long.drop(group), directions, [code, name]),
        "boxes": lambda: summaries.box_stats(long, group),
        "box_points": lambda: long.select("metric", group, name, "value"),
        "correlation": lambda: summaries.correlation_matrix(grouped, inputs),
        "bins": lambda: summaries.decile_bins(points, code, count=civic.AREA_COUNT),
        "fits": lambda: summaries.ols_fit(points),
        "points": lambda: points.select("feature", name, group, "x", "y"),
    }
    return {civic.RESULT_TABLES[kind]: plan for kind, plan in plans.items()}


def run_analytics(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Score table to nine result tables; returns the rows of each."""
    scored = read_dataset(spark, layout.scores(civic.SCORES_TABLE))
    counts = {}
    for name, plan in result_tables(scored).items():
        table, seen = count_rows(plan())
        write_single_file(table, layout.analytics(f"{name}.parquet"))
        counts[name] = dict(seen.get)["rows"]
    return counts


def run_all(spark: SparkSession, layout: Layout) -> None:
    """All five stages."""
    run_clean(spark, layout)
    run_enrich(spark, layout)
    run_features(spark, layout)
    run_score(spark, layout)
    run_analytics(spark, layout)
