"""CSV and parquet readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areascore.functions import to_double, to_integer
from areascore.sources.csv_records import parse_records, read_records
from areascore.sources.inference import fits, inferred_types
from areascore.sources.ranges import SPLIT_BYTES, file_sizes


def _typed(name: str, kind: str):
    column = F.col(f"`{name}`")
    if kind == "int":
        return to_integer(column).alias(name)
    if kind == "double":
        return to_double(column).alias(name)
    return column.try_cast(kind).alias(name)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Mapping[str, str] | None = None,
    multi_line: bool = True,
    split: bool | None = None,
) -> DataFrame:
    """CSV with a header; ``"`` inside quotes is doubled.

    ``columns`` maps the wanted column names to types; values that do not fit become
    null. Nothing is inferred (see :func:`read_inferred_csv`), and only the wanted
    columns are parsed. Without ``columns`` every column is a string.

    Files of a folder must have the same header; one with other columns, or another order, raises.

    ``multi_line`` accepts line breaks inside quotes. With ``split`` such files are read by as many
    tasks as they have byte ranges, at the price of a shuffle (``csv_records``); a quote inside a value
    without quotes then raises if it would change where records end. Without it a file is one
    task. Left open, files of more than ``SPLIT_BYTES`` are split.
    """
    df = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
    if split is None:
        split = multi_line and max(file_sizes(spark, path), default=0) > SPLIT_BYTES
    if split and multi_line and df.columns:
        df = parse_records(read_records(spark, path), df.columns)
    if columns is None:
        return df
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    return df.select(*[_typed(name, kind) for name, kind in columns.items()])


def read_inferred_csv(
    spark: SparkSession, path: str | list[str], tolerance: float = 0.0, split: bool | None = None
) -> DataFrame:
    """CSV with the narrowest type that holds all but a share ``tolerance`` of each column's values.

    The text is read twice: once for the types, of which one row a column reaches the driver.
    """
    text = read_csv(spark, path, split=split)
    kinds = {row["column"]: row["type"] for row in inferred_types(text, tolerance).collect()}
    blank = lambda name: F.nullif(F.trim(F.col(f"`{name}`")), F.lit(""))
    return text.select(
        *[
            F.col(f"`{name}`")
            if kinds.get(name, "string") == "string"
            else F.when(fits(blank(name), kinds[name]), blank(name)).try_cast(kinds[name]).alias(name)
            for name in text.columns
        ]
    )


def read_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """Lookup table with a header; every column a string, so codes keep leading zeros."""
    return read_csv(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system that owns it."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def read_population(
    spark: SparkSession,
    path: str,
    code: str = "nta_code",
    population: str = "population",
) -> DataFrame | None:
    """Code and population, or ``None`` when the file is absent or has no rows."""
    if not path_exists(spark, path):
        return None
    df = read_lookup_csv(spark, path)
    if df.isEmpty():
        return None
    return df.select(F.col(code), to_double(F.col(population)).alias(population))


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Parquet dataset."""
    return spark.read.parquet(path)
