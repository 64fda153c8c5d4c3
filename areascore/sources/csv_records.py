"""CSV records from byte ranges: line breaks inside quotes do not keep a file in one task.

A record ends at a line break outside quotes. Quotes inside quotes are doubled, so a line starts
inside quotes when the number of quotes before it, in the whole file, is odd. Every byte range counts
its own quotes; a running sum over ranges, and one over the lines of a range, tell where records start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areascore.scratch import materialize
from areascore.sources.ranges import RANGE, before, joined_across, occurrences, ranges_before, read_pieces, sum_before, within

QUOTE = '"'


def _checked(record: Column, lines: Column) -> Column:
    """``record``; an error where its first line break cannot be inside quotes."""
    opening = F.replace(F.substring_index(record, "\n", 1), F.lit(QUOTE * 2), F.lit(""))
    quoted = opening.rlike(r'(^|,)"[^"]*$')
    wrong = F.raise_error(F.concat(F.lit("a quote inside a value without quotes; read the file whole: "), F.left(record, F.lit(200))))
    return F.when((lines > 1) & ~quoted, wrong.cast("string")).otherwise(record)


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, is_first, record)``: the records of CSV files, blank lines left out.

    The text passes one shuffle, by ranges, and is stored once. Raises where quotes do not close.
    """
    lines = read_pieces(spark, path, "\n").withColumn("quotes", occurrences(F.col("piece"), QUOTE))
    ranges = lines.groupBy(*RANGE).agg((F.sum("quotes") % 2).alias("odd"))
    ranges = ranges.select(*RANGE, (sum_before(F.col("odd"), ranges_before()) % 2).alias("inside"))
    # One row a range on this side, and both sides end up by range: the lines move once.
    placed = lines.join(ranges, RANGE)
    opens = (F.col("inside") + sum_before(F.col("quotes"), before())) % 2 == 0
    placed = placed.withColumn("opens", opens).withColumn("place", F.sum(F.col("opens").cast("int")).over(within()))
    records = placed.groupBy(*RANGE, "place").agg(
        F.min("inside").alias("inside"),
        F.sum("quotes").alias("quotes"),
        F.count(F.lit(1)).alias("lines"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda line: line["piece"]), "\n"
        ).alias("record"),
    )
    # Place 0 is the rest of a record that began in an earlier range.
    held = F.when(F.col("place") == 0, F.col("inside")).otherwise(0)
    records = records.select(
        *RANGE,
        "place",
        "lines",
        "record",
        (F.col("place") > 0).alias("opens"),
        ((held + F.col("quotes")) % 2 == 0).alias("ends"),
    )
    records = materialize(records, "csv-records")
    whole = records.filter("opens and ends").select("file", "start", "place", "lines", "record")
    across = joined_across(records.filter("not (opens and ends)"), "record", "\n")
    unclosed = F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col("file"))).cast("string")
    across = across.select(
        "file", "first.start", "first.place", F.lit(2).alias("lines"), F.when(F.col("ends"), F.col("record")).otherwise(unclosed).alias("record")
    )
    # Windows line ends leave a carriage return behind the record.
    clean = F.regexp_replace(_checked(F.col("record"), F.col("lines")), "\r$", "")
    every = whole.unionByName(across).withColumn("record", clean).filter(F.trim("record") != "")
    is_first = (F.col("start") == 0) & (F.col("place") == 1)
    return every.select("file", is_first.alias("is_first"), "record")


def parse_records(records: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns of text from records; the first one of a file must hold exactly ``names``."""
    schema = ", ".join(f"`c{i}` string" for i in range(len(names)))
    fields = F.from_csv("record", F.lit(schema), {"escape": QUOTE, "multiLine": "true", "maxCharsPerColumn": "-1"})
    parsed = records.withColumn("fields", fields)
    header = F.struct(*[F.lit(name).alias(f"c{i}") for i, name in enumerate(names)])
    wrong = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")
    is_row = F.when(~F.col("is_first"), True).when(F.col("fields") == header, False).otherwise(wrong)
    return parsed.filter(is_row).select(*[F.col(f"fields.c{i}").alias(name) for i, name in enumerate(names)])
