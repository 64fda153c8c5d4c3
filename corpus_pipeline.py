"""A corpus pipeline: quality, repeated lines, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``, whatever those are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areascore.llm import line_windows, minhash, packing, quality, relative_lz
from areascore.llm.batches import Kept, documents, labels, unused


#: Similarity of word shingles from which the near-duplicate stage drops a document; op4 has its own.
NEAR_PERCENT = 80


def _only(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is among ``chosen``."""
    key = unused(docs, "chosen_doc_id")
    ids = chosen.select(F.col("doc_id").alias(key)).distinct()
    return docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(ids[key]), "left_semi")


def _recounted(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """``changed`` texts with the columns of ``docs``, of which n_chars follows the text."""
    if "n_chars" not in docs.columns:
        return changed.select(*docs.columns)
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return changed.withColumn("n_chars", F.when(F.col("text").isNotNull(), n_chars).otherwise(F.col("n_chars"))).select(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; learned from the labels of those still there."""
    scored = quality.quality_scores(docs, labels(spark, sf_dir))
    return _only(docs, scored.filter("predicted = 1"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of repeated three-line windows.

    A document of which no line is left goes; one that was empty before stays.
    """
    key, at = unused(docs, "line_doc_id"), unused(docs, "line_starts")
    starts = line_windows.repeated_lines(docs).withColumnsRenamed({"doc_id": key, "starts": at})
    joined = docs.join(starts, docs["doc_id"].cast("long") == starts[key], "left")
    whole = unused(joined, "line_whole")
    joined = joined.withColumn(whole, F.col(at).isNull())
    cut = line_windows.cut_lines(joined.select(*docs.columns, at, whole), at)
    left = cut.filter(F.col(whole) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _recounted(docs, left)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id."""
    return _only(docs, minhash.near_dedup(docs, percent=NEAR_PERCENT).filter("kept"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier place holds as well; all documents stay."""
    return _recounted(docs, relative_lz.cut(docs, relative_lz.parse(docs)))


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every text in bins without two pieces of a source or of equal words."""
    return packing.best_fit_packing(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_copies),
    ("substring dedup", drop_repeated_passages),
    ("best-fit packing", pack_bins),
]

#: The quality classifier and the packing have no form in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, for the documents of ``sf_dir``."""
    keep = Kept(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
