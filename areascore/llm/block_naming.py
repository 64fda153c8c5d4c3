"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of fixed size. Distinct blocks are sorted and get integer
names, equal blocks the same name. Then adjacent names are paired and the distinct pairs named in
turn, level by level, until each document is down to one name. Names come from comparing contents,
never from hashes alone, so two documents share (level, name) exactly when their texts are equal.

Scale: texts are shuffled once, as blocks, each block at most once per Arrow batch it occurs in;
everything later moves integers. Names are ranks inside hash buckets of about a thousand rows, so
no sort is global. A level is a count with a partial step and two joins on integers.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areascore.llm.batches import Kept, map_batches, texts

BLOCK_BYTES = 4096
BUCKET_ROWS = 1000
RANKS = 1 << 31
WHITE_RUN = re.compile(rb"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+")


def normalised(text: bytes) -> bytes:
    """Each run of white space as one space; runs that are one space already are skipped over."""
    return WHITE_RUN.sub(b" ", text)


def _name(*key: str, n_rows: int) -> Column:
    """Rank of the key among the distinct keys of its bucket, below the number of the bucket."""
    buckets = max(1, n_rows // BUCKET_ROWS)
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets))
    rank = F.dense_rank().over(Window.partitionBy(bucket).orderBy(*key))
    return bucket * F.lit(RANKS) + rank


def _cut(docs: DataFrame, block_bytes: int) -> DataFrame:
    """A row per document: its blocks as numbers local to its batch, and the blocks new in it."""

    def work(batch: pa.RecordBatch):
        import uuid

        number = uuid.uuid4().int & ((1 << 63) - 1)
        known: dict[bytes, int] = {}
        shas, lists, fresh = [], [], []
        for value in batch.column("text"):
            text = normalised(value.as_buffer().to_pybytes()) if value.is_valid else b""
            shas.append(hashlib.sha256(text).hexdigest())
            numbers, new = [], []
            for at in range(0, max(len(text), 1), block_bytes):
                block = text[at : at + block_bytes]
                if block not in known:
                    known[block] = len(known)
                    new.append({"item": known[block], "block": block})
                numbers.append(known[block])
            lists.append(numbers)
            fresh.append(new)
        yield {
            "doc_id": batch.column("doc_id"),
            "row": np.arange(batch.num_rows, dtype=np.int64),
            "batch": np.full(batch.num_rows, number, dtype=np.int64),
            "text_sha256": shas,
            "items": pa.array(lists, pa.list_(pa.int32())),
            "fresh": pa.array(fresh, pa.list_(pa.struct([("item", pa.int32()), ("block", pa.binary())]))),
        }

    return map_batches(
        texts(docs),
        "doc_id long, row long, batch long, text_sha256 string, items array<int>, "
        "fresh array<struct<item:int,block:binary>>",
        work,
    )


def _raise(level: DataFrame, keep: Kept, n: int) -> DataFrame:
    """Names of the adjacent pairs of each document's names; an odd last name pairs with nothing."""
    at = F.col("pos")
    pairs = level.groupBy("batch", "row", F.floor(at / 2).alias("pos")).agg(
        F.max(F.when(at % 2 == 0, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(at % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
    )
    pairs = keep(pairs, "pairs")
    distinct = pairs.groupBy("a", "b").agg(F.count("*").alias("times"))
    names = distinct.select("a", "b", _name("a", "b", n_rows=n).alias("name"))
    return keep(pairs.join(names, ["a", "b"]).select("batch", "row", "pos", "name"), "level")


def name_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, text_sha256, level and name: equal (level, name) mean equal normalised texts.

    Null counts as the empty text, which has one empty block. Repeated rows keep a row each.
    """
    spark = docs.sparkSession
    keep = Kept(spark)
    rows = keep(_cut(docs, block_bytes), "blocks")
    n_items, longest = rows.agg(F.sum(F.size("items")), F.max(F.size("items"))).first()
    fresh = rows.select("batch", F.explode("fresh").alias("f")).select("batch", "f.item", "f.block")
    names = fresh.select("batch", "item", _name("block", n_rows=n_items or 1).alias("name"))
    items = rows.select("batch", "row", F.posexplode("items").alias("pos", "item"))
    named = keep(items.join(names, ["batch", "item"]).select("batch", "row", "pos", "name"), "level")
    found, level = [], 0
    single = F.size("items") == 1
    found.append(
        rows.filter(single)
        .select("batch", "row", "doc_id", "text_sha256")
        .join(named.filter("pos = 0"), ["batch", "row"])
        .select("doc_id", "text_sha256", F.lit(0).alias("level"), "name")
    )
    left = rows.filter(~single).select("batch", "row", "doc_id", "text_sha256", F.size("items").alias("n"))
    current = named.join(left.select("batch", "row"), ["batch", "row"], "left_semi")
    while (longest or 0) > 1 << level:
        level += 1
        current = _raise(current, keep, n_items)
        done = (F.col("n") > 1 << (level - 1)) & (F.col("n") <= 1 << level)
        found.append(
            left.filter(done)
            .join(current.filter("pos = 0"), ["batch", "row"])
            .select("doc_id", "text_sha256", F.lit(level).alias("level"), "name")
        )
        current = current.join(left.filter(F.col("n") > 1 << level).select("batch", "row"), ["batch", "row"], "left_semi")
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return keep(out, "named")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Texts are equal when identical after each run of white space became one space; null counts as
    empty. The smallest doc_id of equal texts stays; rows repeated under it stay with it and count in
    ``group_size``. Rows without a doc_id never make another row go and are kept if all equal rows
    lack one.
    """
    keep = Kept(docs.sparkSession)
    named = name_documents(docs, block_bytes)
    groups = keep(
        named.groupBy("level", "name").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "groups",
    )
    return named.join(groups, ["level", "name"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
