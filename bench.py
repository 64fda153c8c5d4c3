"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR sets the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores (default 8).
Every query computes all its rows and columns (noop sink) and pays for its own inputs: nothing is
cached between queries. The time is the best of two runs, after one run over the
smallest query has started the session.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from areascore.scratch import release
from areascore.testbed import QUERIES

HEADLINE = [
    "clean_events",
    "binary_flag",
    "melt_wide",
    "spatial_join",
    "modal_lookup",
    "incident_features",
    "inspection_features",
    "outer_join_features",
    "area_score",
    "metric_summary",
    "histogram",
    "top_bottom",
    "box_stats",
    "correlation_matrix",
    "decile_bins",
    "ols_fit",
    "choropleth_class",
    "profile_numeric",
    "csv_roundtrip",
]


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    release(spark)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "record_counts", sf_dir)
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    times = {name: round(min(run(spark, name, sf_dir) for _ in range(2)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
