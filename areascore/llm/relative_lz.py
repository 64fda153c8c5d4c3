"""Substring dedup by relative Lempel-Ziv parsing.

Every document is parsed into factors: stretches of words that an earlier place (smaller doc_id, or
earlier in the document) holds as well. The reference is cut into blocks around anchors, so that a
document is factored against every block that can hold a copy of its words and against no other:

1. In each window of 20 words the anchor is the eight-word run of smallest hash. Equal windows
   have equal anchors, so only windows whose anchor occurs twice can have a copy.
2. The windows at repeated anchors form the index, grouped by anchor. A window's earliest place in
   it becomes its reference; consecutive windows with consecutive references grow into one factor.
3. Factors have 20 words at least. A window across the end of a factor is looked up like any other,
   so what no single factor holds is found at their borders. The union of all factors is what goes.

A document whose word sequence a smaller doc_id has whole is a single factor and is not indexed.

Scale: the first pass leaves the anchors, one word in six. Occurrences are folded within each Arrow
batch, so an anchor or passage shared by every document reaches a shuffle once a batch. Texts are
moved once, compressed, and only those with repeated anchors go on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areascore.llm.batches import Kept, lists, map_batches, slices, texts, unused
from areascore.llm.words import Words, windows

WINDOW = 20
ANCHOR = 8
RUNS = "array<struct<start:int,n:int,ref_doc:long,ref_start:int>>"
_RUN = pa.struct([("start", pa.int32()), ("n", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())])


def _anchors(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window start, the first smallest anchor in it: its hash and its word."""
    grams = windows(hashes, anchor)
    width, n = window - anchor + 1, len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    least, span = grams, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    least = np.minimum(least[:n], least[rest : rest + n])
    at = np.zeros(n, dtype=np.int64)
    for step in range(width - 1, -1, -1):
        at[grams[step : step + n] == least] = step
    return least, at + np.arange(n)


def _whole(first: np.ndarray, window: int, n: int) -> np.ndarray:
    """Which of ``n`` window starts have all their words in one row."""
    starts = np.arange(n)
    row = np.searchsorted(first, starts, side="right") - 1
    return starts + window <= first[row + 1]


def _survey(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """A row a document: size, digests, the anchors that it stands for in its batch, whether the batch has
    each of those several times, and all of its anchors that the batch has several times."""

    def work(batch: pa.RecordBatch):
        ids = batch.column("doc_id")
        known = ids.fill_null(0).to_numpy(zero_copy_only=False)
        valid = ids.is_valid().to_numpy(zero_copy_only=False)
        sizes, digests, shas, rows, grams = [], [], [], [], []
        base = 0
        for part, data, offsets in slices(batch):
            words = Words(data, offsets)
            hashes = words.hashes()
            sizes.append(words.counts())
            joined, cuts = words.joined()
            shas += [hashlib.sha256(joined[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            digests += [
                hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest()
                for a, b in zip(words.first[:-1], words.first[1:], strict=True)
            ]
            least, at = _anchors(hashes, window, anchor)
            good = _whole(words.first, window, len(least))
            places, where = np.unique(at[good], return_index=True)
            grams.append(least[good][where])
            rows.append(np.searchsorted(words.first, places, side="right") - 1 + base)
            base += part.num_rows
        # Copies of a document of this batch have nothing to add.
        earliest: dict[bytes, int] = {}
        for row in np.lexsort((known,)).tolist():
            if valid[row]:
                earliest.setdefault(digests[row], known[row])
        indexed = np.array([v and earliest[d] == k for d, k, v in zip(digests, known, valid, strict=True)], dtype=bool)
        row, gram = np.concatenate(rows), np.concatenate(grams)
        use = indexed[row]
        row, gram = row[use], gram[use]
        _, where, inverse, counts = np.unique(gram, return_index=True, return_inverse=True, return_counts=True)
        chosen = np.zeros(len(gram), dtype=bool)
        chosen[where] = True  # one place of each anchor stands for the batch
        several = counts[inverse] > 1
        count = lambda which: np.bincount(row[which], minlength=batch.num_rows)
        yield {
            "doc_id": ids,
            "n_words": np.concatenate(sizes),
            "digest": pa.array(digests, pa.binary()),
            "whole_sha256": shas,
            "once": lists(gram[chosen].view(np.int64), count(chosen), pa.int64()),
            "more": lists(several[chosen], count(chosen), pa.bool_()),
            "again": lists(gram[several].view(np.int64), count(several), pa.int64()),
        }

    schema = (
        "doc_id long, n_words long, digest binary, whole_sha256 string, once array<long>, more array<boolean>, "
        "again array<long>"
    )
    return map_batches(docs, schema, work)


def _runs(doc: np.ndarray, start: np.ndarray, ref_doc: np.ndarray, ref_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of runs: same documents, starts and references that go up by one."""
    if not len(doc):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (
        (doc[1:] != doc[:-1])
        | (start[1:] != start[:-1] + 1)
        | (ref_doc[1:] != ref_doc[:-1])
        | (ref_start[1:] != ref_start[:-1] + 1)
    )
    at = np.flatnonzero(new)
    return at, np.diff(np.append(at, len(doc)))


def _earliest(keys: tuple[np.ndarray, ...], doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that brings equal keys together, earliest place first; in it, each row's first row, and
    whether the row's place is later than that of the first."""
    order = np.lexsort((start, doc, *keys))
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for key in keys:
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    d, s = doc[order], start[order]
    return order, head, (d > d[head]) | ((d == d[head]) & (s > s[head]))


def _unpacked(column: pa.Array) -> pa.Array:
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(x.as_buffer()) for x in column], pa.binary()).cast(pa.string())


def _index_rows(joined: DataFrame, window: int, anchor: int) -> DataFrame:
    """Rows of two kinds: documents with the references their own batch gives, and, for the index, the
    windows that come first in their batch, grouped by the place of their anchor."""

    def work(batch: pa.RecordBatch):
        doc_ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        plain = pa.RecordBatch.from_arrays([_unpacked(batch.column("packed"))], ["text"])
        marks, cuts = batch.column("marks").values.to_numpy().view(np.uint64), batch.column("marks").offsets.to_numpy()
        found, base = [], 0
        for part, data, offsets in slices(plain):
            words = Words(data, offsets)
            hashes = words.hashes()
            least, at = _anchors(hashes, window, anchor)
            whole = windows(hashes, window)
            good = _whole(words.first, window, len(least))
            for row, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                here = slice(a, max(a, min(b, len(good))))
                marked = good[here] & np.isin(least[here], marks[cuts[base + row] : cuts[base + row + 1]])
                i = np.flatnonzero(marked) + a
                found.append((np.full(len(i), base + row), whole[i], least[i], i - a, at[i] - i))
            base += part.num_rows
        row, key, gram, start, ahead = (np.concatenate(x) for x in zip(*found, strict=True))
        doc = doc_ids[row]
        order, head, later = _earliest((key,), doc, start)
        # References inside the batch, as runs in the order of rows.
        mine, theirs = order[later], order[head[later]]
        by_row = np.lexsort((start[mine], row[mine]))
        mine, theirs = mine[by_row], theirs[by_row]
        at, length = _runs(row[mine], start[mine], doc[theirs], start[theirs])
        near = pa.StructArray.from_arrays(
            [
                pa.array(start[mine[at]].astype(np.int32)),
                pa.array(length.astype(np.int32)),
                pa.array(doc[theirs[at]]),
                pa.array(start[theirs[at]].astype(np.int32)),
            ],
            fields=list(_RUN),
        )
        n = batch.num_rows
        offsets = np.concatenate(([0], np.cumsum(np.bincount(row[mine[at]], minlength=n)))).astype(np.int32)
        none = lambda size, kind: pa.nulls(size, kind)
        yield {
            "doc_id": batch.column("doc_id"),
            "packed": batch.column("packed"),
            "near": pa.ListArray.from_arrays(pa.array(offsets), near),
            "anchor": none(n, pa.int64()),
            "at": none(n, pa.int32()),
            "ahead": none(n, pa.binary()),
            "rest": none(n, pa.binary()),
        }
        # The first window of each key, grouped by anchor place.
        firsts = np.sort(order[np.unique(head)])
        place = start[firsts] + ahead[firsts]
        new = np.ones(len(firsts), dtype=bool)
        new[1:] = (row[firsts][1:] != row[firsts][:-1]) | (place[1:] != place[:-1])
        group = np.append(np.flatnonzero(new), len(firsts))
        heads = firsts[group[:-1]]
        rest = (key[firsts] >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6]
        binary = lambda values, width: pa.Array.from_buffers(
            pa.binary(),
            len(heads),
            [None, pa.py_buffer((group * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))],
        )
        yield {
            "doc_id": pa.array(doc[heads]),
            "packed": none(len(heads), pa.binary()),
            "near": none(len(heads), pa.list_(_RUN)),
            "anchor": pa.array(gram[heads].view(np.int64)),
            "at": pa.array(place[group[:-1]].astype(np.int32)),
            "ahead": binary(ahead[firsts].astype(np.uint8), 1),
            "rest": binary(rest, 6),
        }

    schema = f"doc_id long, packed binary, near {RUNS}, anchor long, at int, ahead binary, rest binary"
    return map_batches(joined, schema, work)


def _references(index: DataFrame) -> DataFrame:
    """doc_id and runs of windows that have an earlier place in the index, which is their reference.

    Each partition is sorted by anchor and worked through in order, one group of an anchor after another.
    """

    def settle(batch: pa.RecordBatch) -> pa.RecordBatch:
        ahead = batch.column("ahead")
        counts = np.array([x.as_buffer().size for x in ahead], dtype=np.int64)
        row = np.repeat(np.arange(batch.num_rows), counts)
        step = np.frombuffer(b"".join(x.as_buffer() for x in ahead), dtype=np.uint8).astype(np.int64)
        parts = np.frombuffer(b"".join(x.as_buffer() for x in batch.column("rest")), dtype=np.uint8).reshape(-1, 6)
        rest = np.zeros((len(parts), 8), dtype=np.uint8)
        rest[:, :6] = parts
        rest = rest.view(np.uint64).ravel()
        doc = batch.column("doc_id").to_numpy()[row]
        start = batch.column("at").to_numpy().astype(np.int64)[row] - step
        gram = batch.column("anchor").to_numpy()[row]
        order, head, later = _earliest((rest, step, gram), doc, start)
        mine, theirs = order[later], order[head[later]]
        by_doc = np.lexsort((start[mine], doc[mine]))
        mine, theirs = mine[by_doc], theirs[by_doc]
        at, length = _runs(doc[mine], start[mine], doc[theirs], start[theirs])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc[mine[at]]),
                pa.array(start[mine[at]].astype(np.int32)),
                pa.array(length.astype(np.int32)),
                pa.array(doc[theirs[at]]),
                pa.array(start[theirs[at]].astype(np.int32)),
            ],
            ["doc_id", "start", "n", "ref_doc", "ref_start"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last anchor, which the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            gram = batch.column("anchor").to_numpy()
            last = int(np.flatnonzero(gram != gram[-1])[-1]) + 1 if gram[0] != gram[-1] else 0
            if last:
                ready = pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks().to_batches()
                held = []
                for each in ready:
                    yield settle(each)
            elif held and held[-1].column("anchor")[0].as_py() != gram[0]:
                for each in pa.Table.from_batches(held).combine_chunks().to_batches():
                    yield settle(each)
                held = []
            held.append(batch.slice(last))
        if held:
            for each in pa.Table.from_batches(held).combine_chunks().to_batches():
                yield settle(each)

    sent = index.filter("anchor is not null").select("doc_id", "anchor", "at", "ahead", "rest")
    grouped = sent.repartition("anchor").sortWithinPartitions("anchor")
    return grouped.mapInArrow(run, "doc_id long, start int, n int, ref_doc long, ref_start int")


def _factors(joined: DataFrame, window: int) -> DataFrame:
    """Factors of every indexed document, and what is left of it without them."""

    def work(batch: pa.RecordBatch):
        plain = pa.RecordBatch.from_arrays([_unpacked(batch.column("packed"))], ["text"])
        base = 0
        for part, data, offsets in slices(plain):
            words = Words(data, offsets)
            steps = np.zeros(len(words) + 1, dtype=np.int64)
            spans = []
            for row in range(part.num_rows):
                runs = [r for c in ("near", "far") for r in batch.column(c)[base + row].as_py() or []]
                factors: list[dict] = []
                for r in sorted(runs, key=lambda r: (r["start"], r["ref_doc"], r["ref_start"])):
                    f = factors[-1] if factors else None
                    if f and (f["start"] + f["n"], f["ref_doc"], f["ref_start"] + f["n"]) == (
                        r["start"], r["ref_doc"], r["ref_start"],
                    ):
                        f["n"] += r["n"]
                    else:
                        factors.append(dict(r))
                first = words.first[row]
                for f in factors:
                    steps[first + f["start"]] += 1
                    steps[first + f["start"] + f["n"] + window - 1] -= 1
                spans.append(
                    [
                        {"first": f["start"], "n": f["n"] + window - 1, "ref_doc": f["ref_doc"], "ref_first": f["ref_start"]}
                        for f in factors
                    ]
                )
            gone = np.cumsum(steps[:-1]) > 0
            kept, cuts = words.joined(~gone)
            total = np.concatenate(([0], np.cumsum(gone)))
            yield {
                "doc_id": batch.column("doc_id").slice(base, part.num_rows),
                "n_words": words.counts(),
                "n_removed": total[words.first[1:]] - total[words.first[:-1]],
                "kept_sha256": [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                "factors": pa.array(spans, pa.list_(_FACTOR)),
            }
            base += part.num_rows

    return map_batches(joined, f"doc_id long, n_words long, n_removed long, kept_sha256 string, factors {FACTORS}", work)


FACTORS = "array<struct<first:int,n:int,ref_doc:long,ref_first:int>>"
_FACTOR = pa.struct([("first", pa.int32()), ("n", pa.int32()), ("ref_doc", pa.int64()), ("ref_first", pa.int32())])


def parse(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and factors (first word, words, place copied) of every row.

    Words are runs of other characters than white space, compared as they are; a null text has none.
    Windows are judged on the input: equal places are never earlier than each other, so rows repeated
    under one doc_id lose the same words. Rows without a doc_id lose nothing and are nobody's reference.
    """
    keep = Kept(docs.sparkSession)
    source = texts(docs)
    survey = keep(_survey(source, window, anchor), "survey")
    long = survey.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    classes = keep(long.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("k")), "classes")
    copies = long.select("doc_id", "digest").join(classes.filter("k > 1"), "digest").filter("doc_id > first_id")
    copies = keep(copies.select("doc_id", "first_id").distinct(), "copies")
    # A copy may be what stands for an anchor in its batch, so it counts here, as the document it repeats. With
    # ``more``, its batch has the anchor in another document, or in another place, too.
    each = long.join(copies, "doc_id", "left").select(
        "doc_id", F.col("first_id").isNull().alias("first"), F.coalesce("first_id", "doc_id").alias("text_id"),
        F.inline(F.arrays_zip("once", "more")).alias("anchor", "more"),
    )
    same = Window.partitionBy("anchor")
    several = F.max("more").over(same) | (F.min("text_id").over(same) < F.max("text_id").over(same))
    shared = each.withColumn("several", several).filter("several and first")
    firsts = long.join(copies.select("doc_id"), "doc_id", "left_anti")
    again = firsts.filter(F.size("again") > 0).select("doc_id", F.col("again").alias("marks"))
    marks = shared.groupBy("doc_id").agg(F.collect_list("anchor").alias("marks")).unionAll(again)
    marks = keep(marks.groupBy("doc_id").agg(F.flatten(F.collect_list("marks")).alias("marks")), "marks")
    sizes = keep(survey.select("doc_id", "n_words", "whole_sha256"), "sizes")
    keep.drop(survey)

    def squeeze(batch: pa.RecordBatch):
        pack = zstandard.ZstdCompressor(level=3).compress
        packed = [pack(x.as_buffer()) if x.is_valid else pack(b"") for x in batch.column("text")]
        yield {"doc_id": batch.column("doc_id"), "packed": pa.array(packed, pa.binary())}

    moved = map_batches(source, "doc_id long, packed binary", squeeze).join(marks, "doc_id")
    index = keep(_index_rows(moved, window, anchor), "index")
    far = _references(index).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "n", "ref_doc", "ref_start")).alias("far")
    )
    indexed = index.filter("anchor is null").select("doc_id", "packed", "near")
    parsed = keep(_factors(indexed.join(far, "doc_id", "left"), window), "factors")
    keep.drop(index)
    plain = sizes.join(marks.select("doc_id"), "doc_id", "left_anti").join(copies, "doc_id", "left")
    copied = F.col("first_id").isNotNull()
    whole = F.struct(
        F.lit(0).alias("first"), F.col("n_words").cast("int").alias("n"),
        F.col("first_id").alias("ref_doc"), F.lit(0).alias("ref_first"),
    )
    return parsed.unionAll(
        plain.select(
            "doc_id",
            "n_words",
            F.when(copied, F.col("n_words")).otherwise(0).alias("n_removed"),
            F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.col("whole_sha256")).alias("kept_sha256"),
            F.when(copied, F.array(whole)).otherwise(F.array().cast(FACTORS)).alias("factors"),
        )
    )


def cut(docs: DataFrame, parsed: DataFrame) -> DataFrame:
    """``docs`` with the words of all factors, and the white space after them, cut out of the text.

    Other columns and untouched texts stay as they are.
    """
    key, columns = unused(docs, "factor_doc_id"), docs.columns
    spans = parsed.filter("n_removed > 0").select(F.col("doc_id").alias(key), "factors").dropDuplicates([key])
    joined = docs.join(spans, docs["doc_id"].cast("long") == spans[key], "left")
    joined = joined.select(*[docs[c] for c in columns], spans["factors"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, text_at = [], columns.index("text")
            for value, factors in zip(batch.column(text_at), batch.column(len(columns)).to_pylist(), strict=True):
                if not factors or not value.is_valid:
                    out.append(value.as_py())
                    continue
                raw = value.as_buffer().to_pybytes()
                words = Words(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
                steps = np.zeros(len(words) + 1, dtype=np.int64)
                for f in factors:
                    steps[f["first"]] += 1
                    steps[f["first"] + f["n"]] -= 1
                gone = np.cumsum(steps[:-1]) > 0
                begins, ends = words.starts, np.append(words.starts[1:], len(raw))
                left = [raw[: begins[0]]] if len(words) else []
                left += [raw[a:b] for a, b in zip(begins[~gone].tolist(), ends[~gone].tolist(), strict=True)]
                out.append(b"".join(left).decode())
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays[text_at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return joined.mapInArrow(run, docs.schema)
