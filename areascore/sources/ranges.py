"""Files cut into pieces by a separator, every byte range in its own task, with the order kept.

A text reader splits a file into byte ranges (``spark.sql.files.maxPartitionBytes`` each) and gives a
piece to the range in which it starts. What a piece means may depend on all that comes before it: whether it
starts inside quotes, or how deep in braces. Such a state is a sum, so each range adds up its own, a running
sum over the ranges of a file, one row each, gives the state every range starts with, and running
sums inside each range do the rest. Only what crosses the end of a range has to be put together afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

#: Size of a file from which on its byte ranges are read by different tasks.
SPLIT_BYTES = 64 << 20
#: A range: the file and its first byte.
RANGE = ["file", "start"]


def within() -> WindowSpec:
    """The pieces of a range up to this one."""
    return Window.partitionBy(*RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before() -> WindowSpec:
    """The pieces of a range before this one."""
    return Window.partitionBy(*RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)


def ranges_before() -> WindowSpec:
    """The ranges of a file before this one."""
    return Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)


def read_pieces(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    """``(file, start, at, piece)``: the pieces between separators, ``at`` rising inside a range."""
    return (
        spark.read.option("lineSep", separator)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("at"),
            F.col("value").alias("piece"),
        )
    )


def occurrences(text: Column, sign: str) -> Column:
    """How often a single character occurs."""
    return F.length(text) - F.length(F.translate(text, sign, ""))


def sum_before(value: Column, over: WindowSpec) -> Column:
    """The sum over rows before this one, 0 for the first."""
    return F.coalesce(F.sum(value).over(over), F.lit(0))


def joined_across(parts: DataFrame, text: str, separator: str) -> DataFrame:
    """Records that cross the ends of ranges, from ``parts`` (file, start, place, opens, ends, ``text``).

    ``opens`` says that a part begins a record, ``ends`` that it completes one. A range has at most two such parts,
    its first and its last, so a file has few rows here, whatever its size.
    """
    order = Window.partitionBy("file").orderBy("start", "place")
    owned = parts.withColumn("owner", F.sum(F.col("opens").cast("int")).over(order))
    return owned.groupBy("file", "owner").agg(
        F.min(F.struct("start", "place")).alias("first"),
        F.bool_or("ends").alias("ends"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("start", "place", text))), lambda part: part[text]), separator
        ).alias(text),
    )


def file_sizes(spark: SparkSession, path: str | list[str]) -> list[int]:
    """Bytes of each file of a path or a folder."""
    sizes = []
    for one in [path] if isinstance(path, str) else path:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(one)
        fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in fs.globStatus(hadoop_path) or []:
            folder = fs.listStatus(found.getPath()) if found.isDirectory() else [found]
            sizes += [status.getLen() for status in folder if status.isFile()]
    return sizes
