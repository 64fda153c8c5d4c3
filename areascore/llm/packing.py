"""Best-fit packing under conflicts.

Texts are cut into pieces of at most ``capacity`` words and put into bins of that capacity. Two
pieces of one source, or of one cluster of duplicates, never share a bin. Bins are ordered by
what is left in them and carry a bitmap of the sources and one of the clusters they hold; from the
smallest sufficient rest on, the search goes to the next larger one until a bin's bitmaps allow the
piece, so it finds the tightest compatible bin, and a new one only when there is none.

Scale: full pieces fill a bin each and need no search. The others are dealt by a hash of the
document into groups of about ``group_rows`` pieces, packed longest first, apart from each other.
Groups are even whatever the sources and clusters are, since neither plays a part in the dealing;
only sizes and keys are shuffled, never texts.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.llm.batches import Kept, map_batches, slices, texts
from areascore.llm.words import LOWER, Words

CAPACITY = 2048
GROUP_ROWS = 4096


class Bins:
    """Open bins of one group, by what is left in them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rests: list[int] = []  # rests of which there is a bin, in order
        self.at: dict[int, list[int]] = {}  # rest -> its bins, oldest first
        self.common: dict[int, tuple[int, int]] = {}  # rest -> bits that all of its bins have
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.used: list[int] = []

    def _file(self, bin_: int, rest: int) -> None:
        if rest not in self.at:
            insort(self.rests, rest)
            self.at[rest] = [bin_]
            self.common[rest] = (self.sources[bin_], self.clusters[bin_])
        else:
            insort(self.at[rest], bin_)
            s, c = self.common[rest]
            self.common[rest] = (s & self.sources[bin_], c & self.clusters[bin_])

    def _take(self, bin_: int, rest: int) -> None:
        bins = self.at[rest]
        bins.pop(bisect_left(bins, bin_))
        if not bins:
            del self.at[rest], self.common[rest]
            self.rests.pop(bisect_left(self.rests, rest))

    def _tightest(self, size: int, source: int, cluster: int) -> tuple[int, int] | None:
        for i in range(bisect_left(self.rests, size), len(self.rests)):
            rest = self.rests[i]
            s, c = self.common[rest]
            if s & source or c & cluster:  # every bin with this rest conflicts
                continue
            for bin_ in self.at[rest]:
                if not (self.sources[bin_] & source or self.clusters[bin_] & cluster):
                    return bin_, rest
        return None

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin for a piece, and the words that lie before it there."""
        found = self._tightest(size, source, cluster)
        if found is None:
            bin_, rest = len(self.used), self.capacity
            self.used.append(0)
            self.sources.append(0)
            self.clusters.append(0)
        else:
            bin_, rest = found
            self._take(bin_, rest)
        before = self.used[bin_]
        self.used[bin_] += size
        self.sources[bin_] |= source
        self.clusters[bin_] |= cluster
        if rest > size:
            self._file(bin_, rest - size)
        return bin_, before


def _bits(column: pd.Series) -> list[int]:
    """One bit for each value that occurs more than once; null and single values conflict with nothing."""
    counts = column.value_counts()
    bit = {value: 1 << i for i, value in enumerate(counts.index[counts > 1])}
    return [bit.get(value, 0) for value in column]


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, source, cluster, part, first_word and n_words of all pieces of all texts.

    ``cluster`` is a digest of the text's words with A-Z lowered. Texts without words have no piece.
    """

    def work(batch: pa.RecordBatch):
        for part, data, offsets in slices(batch):
            words = Words(data, offsets)
            hashes = words.hashes(LOWER)
            counts = words.counts()
            n_pieces = -(-counts // capacity)
            row = np.repeat(np.arange(part.num_rows), n_pieces)
            number = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            clusters = [
                hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest()
                for a, b in zip(words.first[:-1], words.first[1:], strict=True)
            ]
            take = pa.array(row)
            yield {
                "doc_id": part.column("doc_id").take(take),
                "source": part.column("source").take(take),
                "cluster": pa.array(clusters, pa.binary()).take(take),
                "part": number,
                "first_word": number * capacity,
                "n_words": np.minimum(capacity, counts[row] - number * capacity),
            }

    schema = "doc_id long, source string, cluster binary, part long, first_word long, n_words long"
    return map_batches(texts(docs, F.col("source").cast("string").alias("source")), schema, work)


def _numbered(items: DataFrame, block: int = 1 << 14) -> DataFrame:
    """``items`` with copy, the number of a row among the rows equal to it.

    Equal rows meet as a count and are dealt out again in blocks, so no task holds more of them than others.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(block).cast("long")))
    counted = items.groupBy(*items.columns).agg(F.count("*").alias("copies"))
    blocks = counted.select("*", starts.alias("start"))
    blocks = blocks.repartition("doc_id", "part", "cluster", "start")
    last = F.least(F.col("copies"), F.col("start") + block) - 1
    return blocks.select(*items.columns, F.explode(F.sequence("start", last)).alias("copy"))


def pack(items: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``items`` as :func:`pieces` gives them, with bin_id and bin_offset, the words before in the bin."""
    spark = items.sparkSession
    keep = Kept(spark)
    items = keep(items, "pieces")
    groups = items.filter(F.col("n_words") < capacity).count() // group_rows + 1
    items = _numbered(items)
    small = items.filter(F.col("n_words") < capacity)

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_words", "doc_id", "part", "copy"], ascending=[False, True, True, True], kind="stable")
        bins = Bins(capacity)
        found = [
            bins.put(*x)
            for x in zip(rows["n_words"].tolist(), _bits(rows["source"]), _bits(rows["cluster"]), strict=True)
        ]
        rows["bin_id"] = [f"{g}-{b}" for g, (b, _) in zip(rows["group"], found, strict=True)]
        rows["bin_offset"] = [before for _, before in found]
        return rows.drop(columns=["group", "copy"])

    schema = (
        "doc_id long, source string, cluster binary, part long, first_word long, n_words long, "
        "bin_id string, bin_offset long"
    )
    group = F.pmod(F.xxhash64("doc_id", "part", "cluster", "copy"), F.lit(groups)).alias("group")
    searched = small.select("*", group).groupBy("group").applyInPandas(packed, schema)
    name = [F.col("doc_id").cast("string"), F.col("part").cast("string"), F.col("copy").cast("string")]
    name += [F.hex("cluster"), F.concat(F.lit("of "), F.col("source"))]
    full = items.filter(F.col("n_words") == capacity).select(
        *[c for c in items.columns if c != "copy"],
        F.concat_ws("-", F.lit("full"), *[F.coalesce(c, F.lit("")) for c in name]).alias("bin_id"),
        F.lit(0).cast("long").alias("bin_offset"),
    )
    return searched.unionAll(full)


def best_fit_packing(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """bin_id, bin_offset, doc_id, part, first_word, n_words and source of every piece of every text.

    Null and texts without words need no room and have no row. Ties between bins of the same rest go to
    the older bin, between pieces of a size to the smaller doc_id. Pieces without a source conflict
    with no source. Repeated rows are packed each, in different bins, being duplicates; they are dealt over all
    groups like other rows. Names of bins do not depend on how the input is partitioned.
    """
    return pack(pieces(docs, capacity), capacity, group_rows).select(
        "bin_id", "bin_offset", "doc_id", "part", "first_word", "n_words", "source"
    )
