"""Runs every query and its SQL twin side by side: python tests/compare.py [sf] [name…]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_value(row[i]) for i in order) for row in rows])


def difference(spark, con, build, sql, sf_dir):
    """``None`` when both give the same columns and rows, else what differs."""
    df = build(spark, sf_dir)
    spark_columns, spark_rows = canonical(df.columns, [tuple(row) for row in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    sql_columns, sql_rows = canonical(names, result.fetchall())
    if spark_columns != sql_columns:
        return f"columns {spark_columns} <> {sql_columns}"
    expected = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "boolean": "BOOLEAN",
    }
    for name, kind in df.dtypes:
        if expected.get(kind) != kinds[name]:
            return f"type of {name}: {kind} <> {kinds[name]}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows <> {len(sql_rows)}"
    wrong = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(sql_rows)} rows differ, e.g. {wrong[0]}"
    return None


def main():
    from __spark_entry__ import oracle_sql, queries
    from areascore.scratch import release
    from areascore.session import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    wanted = sys.argv[2:]
    spark = build_session(
        "compare",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = oracle_sql()
    bad = 0
    for name, build in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = difference(spark, con, build, sql[name], sf_dir)
            else:
                problem = None if build(spark, sf_dir).count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        release(spark)
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
