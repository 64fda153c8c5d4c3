"""Line dedup by overlapping windows of three lines.

Every three consecutive lines of a text form a window. A window whose lines occur as a window that
starts earlier (smaller doc_id, or same document and earlier line) marks its three lines; marked
positions are merged and those lines go. Windows are judged on the input.

Scale: windows travel as 128-bit digests, each at most once per Arrow batch, because later
occurrences in a batch are known there; a line that every document has therefore reaches the
shuffle as one row a batch. The texts are joined once, to the positions to remove.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from areascore.llm.batches import Kept, let_workers_import, map_batches, texts

WIDTH = 3


def _windows(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, the starts known to be repeated, and the windows that come first in their batch."""

    def work(batch: pa.RecordBatch):
        first: dict[bytes, tuple[int, int]] = {}
        each = []
        for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            keys = []
            if doc_id is not None and value.is_valid:
                lines = value.as_buffer().to_pybytes().split(b"\n")
                for at in range(len(lines) - width + 1):
                    block = b"\n".join(lines[at : at + width])
                    key = hashlib.blake2b(block, digest_size=16).digest() if block.strip() else None
                    keys.append(key)
                    if key is not None and first.get(key, (doc_id, at)) >= (doc_id, at):
                        first[key] = (doc_id, at)
            each.append((doc_id, keys))
        repeated, fresh = [], []
        for doc_id, keys in each:
            known = [(at, key) for at, key in enumerate(keys) if key is not None]
            repeated.append([at for at, key in known if first[key] < (doc_id, at)])
            fresh.append([{"key": key, "at": at} for at, key in known if first[key] == (doc_id, at)])
        yield {
            "doc_id": batch.column("doc_id"),
            "repeated": pa.array(repeated, pa.list_(pa.int32())),
            "fresh": pa.array(fresh, pa.list_(pa.struct([("key", pa.binary()), ("at", pa.int32())]))),
        }

    return map_batches(docs, "doc_id long, repeated array<int>, fresh array<struct<key:binary,at:int>>", work)


def _covered(n_lines: int, starts: list[int] | None, width: int) -> np.ndarray:
    """Which lines lie in a window at one of ``starts``."""
    gone = np.zeros(n_lines + 1, dtype=np.int64)
    at = np.unique(np.array(starts or [], dtype=np.int64))
    np.add.at(gone, at, 1)
    np.add.at(gone, at + width, -1)
    return np.cumsum(gone[:-1]) > 0


def _left(lines: list[str], covered: np.ndarray) -> str:
    return "\n".join(x for x, c in zip(lines, covered.tolist(), strict=True) if not c)


def _remove(joined: DataFrame, width: int) -> DataFrame:
    def work(batch: pa.RecordBatch):
        n_lines, n_removed, kept = [], [], []
        for value, starts in zip(batch.column("text"), batch.column("starts").to_pylist(), strict=True):
            lines = value.as_py().split("\n") if value.is_valid else []
            covered = _covered(len(lines), starts, width)
            n_lines.append(len(lines))
            n_removed.append(int(covered.sum()))
            kept.append(_left(lines, covered) if value.is_valid else None)
        yield {"doc_id": batch.column("doc_id"), "n_lines": n_lines, "n_removed": n_removed, "text": pa.array(kept, pa.string())}

    return map_batches(joined, "doc_id long, n_lines long, n_removed long, text string", work)


def cut_lines(df: DataFrame, starts: str, width: int = WIDTH) -> DataFrame:
    """``df`` without the column ``starts``, its texts without the lines of the windows that start there (from 0)."""
    schema = StructType([f for f in df.schema if f.name != starts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_of, kept = batch.column("text"), []
            for value, at in zip(texts_of, batch.column(starts).to_pylist(), strict=True):
                text = value.as_py()
                if at and text is not None:
                    lines = text.split("\n")
                    text = _left(lines, _covered(len(lines), at, width))
                kept.append(text)
            columns = [pa.array(kept, texts_of.type) if n == "text" else batch.column(n) for n in schema.names]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    let_workers_import(df.sparkSession)
    return df.mapInArrow(run, schema)


def repeated_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id and ``starts``, the lines at which repeated windows start; rows with any only."""
    keep = Kept(docs.sparkSession)
    found = keep(_windows(texts(docs), width), "line-windows")
    fresh = found.select("doc_id", F.explode("fresh").alias("w")).select("doc_id", "w.key", "w.at")
    place = F.struct("doc_id", "at")
    # One row a batch for each key, however often its lines occur.
    far = fresh.withColumn("earliest", F.min(place).over(Window.partitionBy("key"))).filter(place > F.col("earliest"))
    near = found.filter(F.size("repeated") > 0).select("doc_id", F.explode("repeated").alias("at"))
    return (
        far.select("doc_id", "at").unionAll(near).groupBy("doc_id").agg(F.collect_list("at").alias("starts"))
    )


def line_dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_lines, n_removed and the text left of every row.

    Lines end at line feeds and are compared whole. Windows of blank lines and texts of fewer than
    ``width`` lines are left alone; a null text stays null with no lines, an empty one has one
    empty line. Rows repeated under one doc_id count as one place and lose the same lines. Rows
    without a doc_id are left alone and make no other row lose lines.
    """
    source = texts(docs)
    joined = source.join(repeated_lines(docs, width), "doc_id", "left")
    return _remove(joined, width)
