"""Language identification by error-correcting output codes.

Each language has a codeword of bits: all splits of up to ``EXHAUSTIVE`` languages into two sides, or the best
of some random dense codes for more. For each bit one binary classifier over byte n-grams of words tells
the side of ones from the side of zeros: the log of how much more frequent a hashed n-gram is on one side
than on the other, each language of a side counting alike. A text's margin for a bit is the mean over its n-grams, in units
of the margins of the fit rows.

Decoding is weighted by loss: the distance of a language is the sum over bits of the logistic loss of
the margin against its codeword, weighted by how often that bit is right for rows of that language. The nearest
codeword wins; a text is ambiguous when the second one is hardly farther.

Scale: the fit reads at most ``FIT_ROWS`` texts of each language, so its counts do not grow with the
corpus. What reaches the driver is one row of numbers for each of ``BUCKETS`` buckets and each language; every
task gets that table. Scoring is a map over Arrow batches, in which each distinct word is scored once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areascore.llm.batches import Kept, map_batches, unused
from areascore.llm.words import IS_LETTER, Words, mix, row_slices, text_bytes

FIT_ROWS = 4_000  # texts of a language
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
LONGEST = 5  # bytes of an n-gram
PRIOR = 0.05  # occurrences added to each bucket
EXHAUSTIVE = 6
BLOCK = 1 << 22
UNKNOWN = "und"
AMBIGUOUS = 0.75  # scores below it


def held_out() -> Column:
    """Rows that are never learned from; false without a doc_id."""
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    return F.coalesce(remainder == 2, F.lit(False))


def codewords(n: int) -> np.ndarray:
    """One row of bits a language, any two rows far apart; no bit is the same for all."""
    if n < 2:
        return np.zeros((n, 0), dtype=bool)
    if n <= EXHAUSTIVE:
        numbers = np.arange(1, 1 << (n - 1))  # the first language is always on the side of zeros
        return ((numbers[None, :] >> np.arange(n - 1, -1, -1)[:, None]) & 1).astype(bool)
    random = np.random.Generator(np.random.PCG64(11))
    best, apart = None, -1
    for _ in range(100):
        code = random.integers(0, 2, (n, math.ceil(10 * math.log2(n)))).astype(bool)
        ones = code.sum(axis=0)
        code = code[:, (ones > 0) & (ones < n)]
        signs = np.where(code, 1, -1)
        agreeing = signs @ signs.T
        nearest = int(((code.shape[1] - agreeing) // 2 + np.eye(n, dtype=int) * code.shape[1]).min())
        if nearest > apart:
            best, apart = code, nearest
    return best


def distinct_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the distinct words with a space before and behind each, their offsets, and the number of each word."""
    column = words.dictionary()
    _, offsets, data = column.dictionary.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[: len(column.dictionary) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[: at[-1]]
    spaced = np.insert(data, np.concatenate([at[:-1], at[1:]]), 0x20)
    return spaced, at + 2 * np.arange(len(at)), column.indices.to_numpy().astype(np.int64)


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the buckets of all n-grams inside the words, and how many each word has."""
    sizes = np.diff(offsets)
    left = np.repeat(offsets[1:], sizes) - np.arange(len(data))
    packed = np.zeros(len(data), dtype=np.uint64)
    for n in range(1, LONGEST + 1):
        packed = packed[: len(data) - n + 1] | (data[n - 1 :].astype(np.uint64) << np.uint64(8 * (n - 1)))
        inside = left[: len(packed)] >= n
        key = packed[inside] | np.uint64(n << 56)
        yield (mix(key) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.maximum(sizes - n + 1, 0)


@dataclass
class Model:
    """Languages, their codewords, a weight for each bucket and bit, margins' units, weights of the losses."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    units: np.ndarray
    trust: np.ndarray

    def word_margins(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the weights of each word's n-grams for each bit, and how many n-grams it has."""
        total, many = np.zeros((len(offsets) - 1, self.code.shape[1])), np.zeros(len(offsets) - 1)
        for buckets, counts in grams(data, offsets):
            sums = np.zeros((len(buckets) + 1, self.code.shape[1]))
            np.cumsum(self.weights[buckets], axis=0, out=sums[1:])
            ends = np.cumsum(counts)
            total += sums[ends] - sums[ends - counts]
            many += counts
        return total, many

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean weight of each text's n-grams for each bit, in the bit's unit; zeros without words."""
        words = Words(data, offsets, ~IS_LETTER)
        out = np.zeros((len(offsets) - 1, self.code.shape[1]))
        if not len(words) or not self.code.shape[1]:
            return out
        spaced, at, number = distinct_words(words)
        total, many = self.word_margins(spaced, at)
        sums = np.concatenate([np.zeros((1, out.shape[1])), np.cumsum(total[number], axis=0)])
        size = np.concatenate([[0], np.cumsum(many[number])])
        n = np.maximum(size[words.first[1:]] - size[words.first[:-1]], 1)
        return (sums[words.first[1:]] - sums[words.first[:-1]]) / n[:, None] / self.units

    def distances(self, margins: np.ndarray) -> np.ndarray:
        """Loss-weighted distance of each text's margins to each codeword."""
        return np.stack(
            [
                np.logaddexp(0, -2 * np.where(word, margins, -margins)) @ trust
                for word, trust in zip(self.code, self.trust, strict=True)
            ],
            axis=1,
        )


def _lowered(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, the text in lower case, whether it has a letter, and columns asked for."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.lower(text).alias("text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
        *more,
    )


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(batch.column("text"))
    for a, b in row_slices(offsets, BLOCK):
        yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _fit_rows(docs: DataFrame, keep: Kept, fit_rows: int) -> DataFrame:
    """text and language of the rows to learn from: of each language at most ``fit_rows``, the first by a hash of the doc_id."""
    named = unused(docs, "language")
    rows = docs.withColumn(named, F.col("lang").cast("string")).filter(
        F.col(named).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    )
    rows = _lowered(rows, F.col(named).alias("language"))
    ids = rows.select("doc_id", "language")
    # One row a language. About three times as many ids as are wanted go on to be ranked.
    sizes = {r.language: r.n for r in ids.groupBy("language").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return rows.select("text", "language").limit(0)
    share = F.create_map(*[x for name, n in sizes.items() for x in (F.lit(name), F.lit(min(1.0, 3 * fit_rows / n)))])
    steps = 1 << 24
    place = F.pmod(F.xxhash64("doc_id"), F.lit(steps))
    ids = ids.filter(place < share[F.col("language")] * steps).distinct()
    rank = F.row_number().over(Window.partitionBy("language").orderBy(place, "doc_id"))
    ids = keep(ids.withColumn("place", rank).filter(F.col("place") <= fit_rows).select("doc_id", "language"), "fit-ids")
    chosen = rows.join(F.broadcast(ids), ["doc_id", "language"])  # fit_rows numbers of each language
    return chosen.groupBy("doc_id", "language").agg(F.min("text").alias("text")).select("text", "language")


def _gram_counts(rows: DataFrame) -> DataFrame:
    """language, bucket and n, summed for each language of an Arrow batch first."""

    def work(batch: pa.RecordBatch):
        languages = batch.column("language").dictionary_encode()
        names, of_row = languages.dictionary, languages.indices.to_numpy()
        for number in range(len(names)):
            mine = batch.filter(pa.array(of_row == number))
            counts = np.zeros(BUCKETS, dtype=np.int64)
            for _, data, offsets in _blocks(mine):
                words = Words(data, offsets, ~IS_LETTER)
                if len(words):
                    spaced, at, each = distinct_words(words)
                    times = np.bincount(each, minlength=len(at) - 1)
                    for buckets, sizes in grams(spaced, at):
                        counts += np.bincount(buckets, np.repeat(times, sizes), BUCKETS).astype(np.int64)
            seen = np.flatnonzero(counts)
            yield {"language": pa.array([names[number].as_py()] * len(seen), pa.string()), "bucket": seen, "n": counts[seen]}

    counts = map_batches(rows, "language string, bucket long, n long", work)
    return counts.groupBy("language", "bucket").agg(F.sum("n").alias("n"))


def _bit_weights(counts: DataFrame, totals: dict[str, int], languages: list[str], code: np.ndarray) -> np.ndarray:
    """Log of the mean share of each bucket on the side of ones over that on the side of zeros."""
    size = {name: totals.get(name, 0) + PRIOR * BUCKETS for name in languages}
    per_language = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(1 / size[name]))])
    share = counts.select("bucket", "language", (F.col("n") * per_language[F.col("language")]).alias("share"))
    sides = [[name for name, bit in zip(languages, column, strict=True) if bit] for column in code.T]
    sums = share.groupBy("bucket").agg(
        F.sum("share").alias("all"),
        *[F.sum(F.when(F.col("language").isin(side), F.col("share")).otherwise(0.0)).alias(f"b{j}") for j, side in enumerate(sides)],
    )
    table = sums.toArrow()  # one row a bucket
    found = np.zeros((BUCKETS, len(sides) + 1))
    found[table.column("bucket").to_numpy()] = np.column_stack([table.column(c).to_numpy() for c in table.column_names[1:]])
    base = np.array([PRIOR / size[name] for name in languages])
    ones = found[:, 1:] + base @ code
    zeros = found[:, :1] - found[:, 1:] + base @ ~code
    return np.log(ones / code.sum(axis=0)) - np.log(zeros / (~code).sum(axis=0))


def fit(docs: DataFrame, keep: Kept, fit_rows: int = FIT_ROWS) -> Model:
    """From text and lang of the rows that are not held out, of at most ``fit_rows`` texts of each language."""
    chosen = keep(_fit_rows(docs, keep, fit_rows), "fit-rows")
    # One row a language.
    languages = sorted(r.language for r in chosen.select("language").distinct().collect())
    code = codewords(len(languages))
    n_bits = code.shape[1]
    if not n_bits:
        return Model(languages, code, np.zeros((BUCKETS, 0)), np.ones(0), np.ones((len(languages), 0)))
    counts = keep(_gram_counts(chosen), "grams")
    totals = {r.language: r.n for r in counts.groupBy("language").agg(F.sum("n").alias("n")).collect()}
    weights = _bit_weights(counts, totals, languages, code)
    model = Model(languages, code, weights, np.ones(n_bits), np.ones(code.shape))
    bits = np.where(code, 1, -1)

    def work(batch: pa.RecordBatch):
        number = {name: i for i, name in enumerate(languages)}
        for part, data, offsets in _blocks(batch):
            mine = np.array([number[x] for x in part.column("language").to_pylist()])
            signed = model.margins(data, offsets) * bits[mine]
            for at in np.unique(mine).tolist():
                own = signed[mine == at]
                yield {
                    "at": [at] * n_bits,
                    "bit": np.arange(n_bits),
                    "n": [len(own)] * n_bits,
                    "reach": np.abs(own).sum(axis=0),
                    "right": (own > 0).sum(axis=0),
                }

    sums = map_batches(chosen, "at long, bit long, n long, reach double, right long", work).groupBy("at", "bit")
    found = sums.agg(*[F.sum(c).alias(c) for c in ("n", "reach", "right")]).collect()  # languages times bits
    n, reach, right = (np.zeros(code.shape) for _ in range(3))
    for r in found:
        n[r.at, r.bit], reach[r.at, r.bit], right[r.at, r.bit] = r.n, r.reach, r.right
    model.units = np.maximum((reach / np.maximum(n, 1)).mean(axis=0), 1e-9)
    accuracy = (right + 1) / (n + 2)
    model.trust = accuracy / accuracy.sum(axis=1, keepdims=True) * n_bits
    return model


def identify(docs: DataFrame, fit_rows: int = FIT_ROWS, ambiguous: float = AMBIGUOUS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, second and ambiguous of every row.

    Learns from ``text`` and non-null ``lang`` of the rows whose crc32(doc_id) mod 4 is not 2; a row
    without a doc_id is not learned from. No column but the text has a part in a prediction. ``score`` is the share of the winner in
    the exponentials of the negative distances, ``second`` the next language (null if there is only one) and ``ambiguous`` whether the
    score is below the bound. Texts that are null or have no letter are ``und`` with score 0 and not
    ambiguous, and so is every text when no language is known; with one language every other text has it, with score 1.
    Equal distances go to the language that sorts first. Repeated rows are predicted each.
    """
    keep = Kept(docs.sparkSession)
    model = fit(docs, keep, fit_rows)

    def work(batch: pa.RecordBatch):
        for part, data, offsets in _blocks(batch):
            lettered = part.column("lettered").to_numpy(zero_copy_only=False)
            n = part.num_rows
            best, second, score = np.full(n, -1), np.full(n, -1), np.zeros(n)
            if model.languages:
                distances = model.distances(model.margins(data, offsets))
                order = np.argsort(distances, axis=1, kind="stable")
                likely = np.exp(distances.min(axis=1, keepdims=True) - distances)
                best = np.where(lettered, order[:, 0], -1)
                score = np.where(lettered, 1 / likely.sum(axis=1), 0.0)
                if len(model.languages) > 1:
                    second = np.where(lettered, order[:, 1], -1)
            yield {
                "doc_id": part.column("doc_id"),
                "lang_pred": [model.languages[i] if i >= 0 else UNKNOWN for i in best.tolist()],
                "score": score,
                "second": pa.array([model.languages[i] if i >= 0 else None for i in second.tolist()], pa.string()),
                "ambiguous": (best >= 0) & (score < ambiguous),
            }

    schema = "doc_id long, lang_pred string, score double, second string, ambiguous boolean"
    found = map_batches(_lowered(docs), schema, work)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "second", "ambiguous")
