"""Parquet and CSV sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from areascore.scratch import remove_path, scratch_path

# Read back as written: quotes doubled, spaces kept.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_dataset(df: DataFrame, path: str, parts: int | None = None) -> None:
    """Overwrite a parquet directory.

    ``parts`` sets the number of files of a result table. It shuffles instead of
    coalescing, so the work before it keeps all its tasks.
    """
    out = df if parts is None else df.repartition(parts)
    out.write.mode("overwrite").parquet(path)


def write_single_file(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace ``path`` by one parquet file, or one CSV file with a header, whatever the size.

    For result tables that are read as a file. The rows are computed in parallel and stored first; one
    task then copies them, so large tables belong in :func:`write_dataset`.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unknown format {fmt}")
    spark = df.sparkSession
    staged_path = scratch_path(spark, "result")
    df.write.parquet(staged_path)
    staged = spark.read.schema(df.schema).parquet(staged_path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path + ".parts")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    writer = staged.repartition(1).write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.format(fmt).save(folder.toString())
    parts = [
        status.getPath()
        for status in fs.listStatus(folder)
        if status.getPath().getName().startswith("part-")
    ]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part in {folder.toString()}, found {len(parts)}")
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(parts[0], target):
        raise RuntimeError(f"could not move {parts[0].toString()} to {path}")
    fs.delete(folder, True)
    remove_path(spark, staged_path)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a directory of CSV files with headers."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def count_rows(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and an observation of its rows that is filled by whatever write reads ``df`` whole."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_with_counts(df: DataFrame, path: str, **counts: Column) -> dict[str, int]:
    """Overwrite a parquet directory and return aggregates of the rows written.

    The aggregates ride on the write itself, in its last stage, where each
    partition counts once even when a task is repeated.
    """
    observation = Observation()
    aggregates = {"rows": F.count(F.lit(1)), **counts}
    observed = df.observe(observation, *[agg.alias(name) for name, agg in aggregates.items()])
    observed.write.mode("overwrite").parquet(path)
    return dict(observation.get)
