"""Features of a FeatureCollection from byte ranges: one document in many tasks.

The text is cut at closing braces. A brace counts when it is outside strings, and a string is open when the
number of quotes before is odd (those behind a backslash aside). Every byte range adds up its quotes and
its braces, the latter for both answers to whether it starts inside a string; running sums over the
ranges of a file, then over the pieces of a range, give each brace its depth. A feature is what closes at depth
two: an element of the root's list of features. Features before it are counted the same way, which is its
position in the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from areascore.scratch import materialize
from areascore.sources.ranges import RANGE, before, joined_across, occurrences, ranges_before, read_pieces, sum_before, within

#: What stands before the first brace outside strings.
AHEAD = r'^([^"{]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"{]*+)*+)\{'


def _opened(text: Column) -> Column:
    """Opening braces outside strings, of a text that starts outside strings."""
    return occurrences(F.regexp_replace(text, r'"[^"]*("|$)', ""), "{")


def _depths(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pieces with ``change``, by how much each changes the depth, and ``closes``, whether its closing brace counts."""
    bare = F.regexp_replace("piece", r"\\.", "")  # without escaped quotes
    pieces = read_pieces(spark, path, "}").withColumn("bare", bare)
    pieces = pieces.select(
        *RANGE,
        "at",
        "piece",
        (occurrences(F.col("bare"), '"') % 2).alias("odd"),
        _opened(F.col("bare")).alias("outside"),
        # The same text when it starts inside a string: what is before the first quote is left out.
        F.when(F.contains("bare", F.lit('"')), _opened(F.regexp_replace("bare", r'^[^"]*"', ""))).otherwise(0).alias("inside"),
    )
    quotes = pieces.groupBy(*RANGE).agg((F.sum("odd") % 2).alias("odd"))
    quotes = quotes.select(*RANGE, (sum_before(F.col("odd"), ranges_before()) % 2).alias("held"))
    starts_inside = (F.col("held") + sum_before(F.col("odd"), before())) % 2 == 1
    placed = pieces.join(quotes, RANGE).withColumn("in_string", starts_inside)
    opened = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    closes = F.col("in_string") == (F.col("odd") == 1)
    return placed.select(*RANGE, "at", "piece", closes.alias("closes"), (opened - closes.cast("int")).alias("change"))


def read_feature_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, ord, feature)``: the JSON text of each feature and its position in its document.

    The text passes two shuffles, by ranges, and is stored twice on the way; no value is longer than a feature.
    """
    pieces = materialize(_depths(spark, path), "json-pieces")
    depths = pieces.groupBy(*RANGE).agg(F.sum("change").alias("change"))
    depths = depths.select(*RANGE, sum_before(F.col("change"), ranges_before()).alias("base"))
    deep = pieces.join(depths, RANGE).withColumn("depth", F.col("base") + F.sum("change").over(within()))
    # A part ends where an object directly below the root closes.
    deep = deep.withColumn("ends", F.col("closes") & (F.col("depth") == 1))
    deep = deep.withColumn("place", sum_before(F.col("ends").cast("int"), before()))
    parts = deep.groupBy(*RANGE, "place").agg(
        F.bool_or("ends").alias("ends"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda p: p["piece"]), "}").alias("text"),
    )
    parts = materialize(parts, "json-parts")
    # The first part of a range begins an object unless the range before left one open.
    last = parts.groupBy(*RANGE).agg(F.max_by("ends", "place").alias("complete"))
    in_file = Window.partitionBy("file").orderBy("start")
    last = last.select(*RANGE, F.coalesce(F.lag("complete").over(in_file), F.lit(True)).alias("fresh"))
    parts = parts.join(last, RANGE).withColumn("opens", (F.col("place") > 0) | F.col("fresh")).drop("fresh")
    whole = parts.filter("opens and ends").select("file", "start", "place", "text")
    across = joined_across(parts.filter("not (opens and ends)"), "text", "}").filter("ends")
    objects = whole.unionByName(across.select("file", "first.start", "first.place", "text"))
    return _numbered(_listed_features(objects)).select("file", "ord", "feature")


def _listed_features(objects: DataFrame) -> DataFrame:
    """The objects of the root's list of features, as ``feature``, without what stands before them."""
    is_first = (F.col("start") == 0) & (F.col("place") == 0)
    text = F.when(is_first, F.regexp_replace("text", r"^[^{]*\{", "")).otherwise(F.col("text"))
    objects = objects.withColumn("text", text).withColumn("ahead", F.regexp_extract("text", AHEAD, 1))
    # An object behind a comma follows the one before it. Any other stands behind a key: there are few of those.
    keyed = objects.filter(~F.col("ahead").rlike(r"^\s*,\s*$"))
    order = Window.partitionBy("file").orderBy("at")
    keyed = keyed.select("file", F.struct("start", "place").alias("at"), F.col("ahead").rlike(r'"features"\s*:\s*\[\s*$').alias("features"))
    keyed = keyed.withColumn("until", F.lead("at").over(order)).filter("features").withColumnRenamed("at", "since")
    at = F.struct("start", "place")
    inside = (at >= F.col("since")) & (F.col("until").isNull() | (at < F.col("until")))
    feature = F.concat(F.substr("text", F.length("ahead") + 1), F.lit("}"))
    return objects.join(keyed, "file").filter(inside).select("file", "start", "place", feature.alias("feature"))


def _numbered(features: DataFrame) -> DataFrame:
    """``ord``: how many features of the file come before; places inside a range follow one another."""
    sizes = features.groupBy(*RANGE).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least"))
    sizes = sizes.select(*RANGE, "least", sum_before(F.col("n"), ranges_before()).alias("base"))
    return features.join(sizes, RANGE).withColumn("ord", F.col("base") + F.col("place") - F.col("least"))
