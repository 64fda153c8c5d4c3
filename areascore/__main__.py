"""Run stages: python -m areascore ROOT [clean enrich features score analytics]."""

from __future__ import annotations

import argparse

from areascore.plans import stages
from areascore.scratch import release
from areascore.session import build_session
from areascore.sources import Layout

# Stage -> its function and the command line options it takes.
STAGES = {
    "clean": (stages.run_clean, ["multi_line", "only_types"]),
    "enrich": (stages.run_enrich, ["per_line", "order_field"]),
    "features": (stages.run_features, ["fill_rates"]),
    "score": (stages.run_score, []),
    "analytics": (stages.run_analytics, []),
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="areascore", description=__doc__)
    parser.add_argument("root", help="folder with raw/ and geo/; results go below it")
    parser.add_argument("stages", nargs="*", metavar="STAGE", help=", ".join(STAGES))
    parser.add_argument("--raw", help="folder of the raw feeds, when it is not ROOT/raw")
    parser.add_argument(
        "--multi-line",
        action=argparse.BooleanOptionalAction,
        help="whether fields of the raw feeds may hold line breaks; set per feed by default",
    )
    parser.add_argument("--only-types", action="store_true", help="keep food-related 311 complaints only")
    parser.add_argument("--per-line", action="store_true", help="the GeoJSON has one feature per line")
    parser.add_argument("--order-field", help="property that orders the GeoJSON features")
    parser.add_argument(
        "--fill-rates",
        action=argparse.BooleanOptionalAction,
        default=True,
        help="whether areas without people get rate 0",
    )
    options = parser.parse_args(arguments)
    spark = build_session()
    layout = Layout(options.root, options.raw)
    try:
        for name in options.stages or STAGES:
            run, taken = STAGES[name]
            print(name, run(spark, layout, **{key: getattr(options, key) for key in taken}))
    finally:
        release(spark)
    if arguments is None:
        spark.stop()


if __name__ == "__main__":
    main()
