"""Toxicity by maximum-scoring segments.

Each token has a log-odds score: toxic against other labelled documents, each document counting a
token once so that a text which repeats itself has no more say, under an informative Dirichlet
prior (half a document, and more for frequent tokens). Tokens whose log-odds are
significant form the lexicon; any other token counts a little against. A word that is not in it scores
as its beginning does, so inflected forms too rare to be learned one by one are known by their stem. One linear scan finds all
maximal segments of a text (disjoint, none can be made better by growing or shrinking it). The tail
of segment scores in other documents is an extreme-value law whose rate is solved from the scores
themselves; the significant segments of a text add up to one p-value, which a logistic curve over the
labelled rows turns into a probability.

Scale: the fit uses at most ``FIT_ROWS`` labelled rows, so their ids and labels are small enough to
send to every task. Their texts are read where they lie and stored once; near-copy detection shuffles those
and no others. Token counts leave each Arrow batch already summed. What reaches the driver is the lexicon, whose size is a parameter, and a
histogram of the evidence.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.llm import minhash
from areascore.llm.batches import Kept, held_out, map_batches, slices, texts
from areascore.llm.calibration import fit_logistic, logistic
from areascore.llm.words import IS_LETTER, LOWER, Words, distinct_pairs

FIT_ROWS = 50_000
LEXICON_TOKENS = 1 << 16
PRIOR_TOKENS = 1000.0
LEAST_Z = 5.0
NEAR_PERCENT = 80  # similarity of copies, of which the fit takes one
DENSITY = 0.1  # share of lexicon tokens expected inside a toxic passage
THRESHOLD = 0.5
STEM = 4  # bytes
_STEM_SALT = np.uint64(0x5851F42D4C957F2D)


@dataclass
class Lexicon:
    """Sorted hashes of the tokens with a score, the score of any other, the law of the segments."""

    hashes: np.ndarray
    scores: np.ndarray
    other: float
    rate: float
    constant: float
    stem: int = STEM

    def word_scores(self, words: np.ndarray, stems: np.ndarray) -> np.ndarray:
        """Score of each word or else of its stem; zero where neither is in the lexicon."""
        own = self._scores(words)
        return np.where(own > 0, own, self._scores(stems))

    def _scores(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.scores[at], 0.0)


def maximal_segments(positions: np.ndarray, scores: np.ndarray, other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a row of tokens.

    ``positions`` and ``scores`` are those of the positive tokens, in order; every token between
    them scores ``other``, below zero. Each positive token is pushed and merged at most once, so
    the scan is linear.
    """
    stack: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum with it
    total, last = 0.0, -1
    for p, s in zip(positions.tolist(), scores.tolist(), strict=True):
        total += other * (p - last - 1)
        first, before, total = p, total, total + s
        last = p
        while stack:
            hidden = []
            while stack and stack[-1][2] >= before:
                hidden.append(stack.pop())
            if not stack or stack[-1][3] >= total:
                stack.extend(reversed(hidden))
                break
            first, _, before, _ = stack.pop()
        stack.append((first, p, before, total))
    return [(a, b, after - before) for a, b, before, after in stack]


def _tokens(data: np.ndarray, offsets: np.ndarray, stem: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words, their hashes and those of their stems; a word no longer than a stem is its own stem."""
    words = Words(data, offsets, ~IS_LETTER)
    ends = np.minimum(words.ends, words.starts + stem)
    return words, words.hashes(LOWER), Words.of(data, words.starts, ends).hashes(LOWER) ^ _STEM_SALT


def _token_counts(labelled: DataFrame, stem: int) -> DataFrame:
    """token and the rows of (text, label) it is in, n_toxic and n_other; summed in each batch first."""

    def work(batch: pa.RecordBatch):
        found, label = [], []
        for part, data, offsets in slices(batch):
            words, hashes, stems = _tokens(data, offsets, stem)
            rows = words.rows()
            hashes, rows = distinct_pairs(np.concatenate([hashes, stems]), np.concatenate([rows, rows]))
            found.append(hashes)
            label.append(part.column("label").to_numpy(zero_copy_only=False)[rows])
        if found:
            tokens, at = np.unique(np.concatenate(found), return_inverse=True)
            toxic = np.bincount(at, weights=np.concatenate(label), minlength=len(tokens)).astype(np.int64)
            every = np.bincount(at, minlength=len(tokens))
            yield {"token": tokens.view(np.int64), "n_toxic": toxic, "n_other": every - toxic}

    counts = map_batches(labelled, "token long, n_toxic long, n_other long", work)
    return counts.groupBy("token").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_other").alias("n_other"))


def _rate(shares: np.ndarray, scores: np.ndarray) -> float:
    """The positive root of sum(share * exp(rate * score)) = 1; the mean score is below zero."""
    low, high = 0.0, 1.0
    value = lambda x: float(shares @ np.exp(np.clip(x * scores, -700, 700))) - 1
    while value(high) < 0 and high < 1024:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def fit_lexicon(
    labelled: DataFrame, keep: Kept, most: int = LEXICON_TOKENS, least_z: float = LEAST_Z, stem: int = STEM
) -> Lexicon:
    """From rows of (text, label 0 or 1); ``least_z`` alone decides which tokens are significant.

    ``most`` bounds the lexicon, which every task gets, to its most significant tokens.
    """
    counts = keep(_token_counts(labelled, stem), "tokens")
    n1, n0 = counts.agg(F.sum("n_toxic"), F.sum("n_other")).first()
    n1, n0 = n1 or 0, n0 or 0
    if not n1 or not n0:
        return Lexicon(np.zeros(0, dtype=np.uint64), np.zeros(0), math.log1p(-DENSITY), 1.0, 1.0, stem)
    y1, y0 = F.col("n_toxic"), F.col("n_other")
    prior = 0.5 + PRIOR_TOKENS * (y1 + y0) / F.lit(float(n1 + n0))
    odds = F.log((y1 + prior) / (n1 + PRIOR_TOKENS - y1 - prior)) - F.log(
        (y0 + prior) / (n0 + PRIOR_TOKENS - y0 - prior)
    )
    # Signed root of the likelihood ratio against equal frequency in both classes.
    share = F.lit(n1 / (n1 + n0))
    gain = y1 * F.log((y1 + 1e-9) / ((y1 + y0) * share)) + y0 * F.log((y0 + 1e-9) / ((y1 + y0) * (1 - share)))
    z = F.sqrt(2 * F.greatest(gain, F.lit(0.0)))
    top = (
        counts.select("token", "n_toxic", "n_other", odds.alias("odds"), z.alias("z"))
        .filter((F.col("z") >= least_z) & (F.col("odds") > 0))
        .orderBy(F.desc("z"), "token")
        .limit(most)
        .collect()
    )
    hashes = np.array([r.token for r in top], dtype=np.int64).view(np.uint64)
    scores = np.array([r.odds for r in top])
    shares = np.array([r.n_other for r in top], dtype=float) / n0
    order = np.argsort(hashes)
    other = math.log((1 - DENSITY) / (1 - min(float(shares.sum()), DENSITY / 2)))
    rate = 1.0
    if len(top):
        every = np.append(shares, max(1 - shares.sum(), 0.0))
        each = np.append(scores, other)
        rate = _rate(every, each) if float(every @ each) < 0 else 1.0
    # For scores with steps, the constant lies near the share of positions where a segment starts.
    constant = min(max(float(shares.sum()), 1e-6), 1.0)
    return Lexicon(hashes[order], scores[order], other, rate, constant, stem)


def _evidence(segments: list[tuple[int, int, float]], n_tokens: int, model: Lexicon) -> tuple[float, list]:
    """Minus the log of the p-value of all significant segments together, and those segments."""
    base = math.log(max(model.constant * max(n_tokens, 1), 1e-300))
    normal = sorted(((model.rate * s - base, a, b, s) for a, b, s in segments), reverse=True)
    kept = [x for x in normal if x[0] > 0]
    if not kept:
        return 0.0, []
    r, total = len(kept), sum(x[0] for x in kept)
    log_p = -total + (r - 1) * math.log(max(total, 1e-300)) - math.lgamma(r + 1) - math.lgamma(r)
    return max(-log_p, kept[0][0], 0.0), sorted((a, b, s) for _, a, b, s in kept)


def scan(docs: DataFrame, model: Lexicon) -> DataFrame:
    """doc_id, n_tokens, evidence and passages (first and last token, score) of every row."""

    def work(batch: pa.RecordBatch):
        for part, data, offsets in slices(batch):
            words, hashes, stems = _tokens(data, offsets, model.stem)
            scores = model.word_scores(hashes, stems)
            at = np.flatnonzero(scores)
            cuts = np.searchsorted(at, words.first)
            evidence, passages = np.zeros(part.num_rows), []
            for row, n in enumerate(words.counts().tolist()):
                found = []
                if cuts[row + 1] > cuts[row]:
                    mine = at[cuts[row] : cuts[row + 1]]
                    segments = maximal_segments(mine - words.first[row], scores[mine], model.other)
                    evidence[row], found = _evidence(segments, n, model)
                passages.append([{"first": a, "last": b, "score": s} for a, b, s in found])
            kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))
            yield {
                "doc_id": part.column("doc_id"),
                "n_tokens": words.counts(),
                "evidence": evidence,
                "passages": pa.array(passages, kind),
            }

    schema = (
        "doc_id long, n_tokens long, evidence double, passages array<struct<first:long,last:long,score:double>>"
    )
    return map_batches(texts(docs), schema, work)


def toxicity_scores(
    docs: DataFrame, label_rows: DataFrame, fit_rows: int = FIT_ROWS, least_z: float = LEAST_Z, stem: int = STEM
) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages and passages of every row of ``docs``.

    Learns from ``toxic`` of the labels whose crc32(doc_id) mod 5 is not 0, of the ``fit_rows`` first by a
    hash of the doc_id if there are more. Null and empty texts have no
    evidence and get the score of no evidence. Without labels of both classes there is no lexicon and
    every score is 0. Repeated rows are scored each; a label row given twice counts twice.
    """
    keep = Kept(docs.sparkSession)
    known = label_rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    known = known.filter("label in (0, 1) and doc_id is not null").filter(~held_out())
    # At most fit_rows rows of two numbers: bounded, whatever the labels are.
    known = keep(known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(fit_rows), "known")
    known = F.broadcast(known)
    source = texts(docs)
    # The texts to learn from are stored, so that what follows shuffles these and no others.
    known_texts = keep(source.join(F.broadcast(known.select("doc_id").distinct()), "doc_id"), "known-texts")
    # Copies of a text, near ones too, would count its words again and again: one row of each stands for all.
    copies = minhash.near_dedup(known_texts, NEAR_PERCENT)
    once = copies.select("doc_id", "component_id").distinct().join(known, "doc_id")
    once = keep(once.groupBy("component_id", "label").agg(F.min("doc_id").alias("doc_id")), "once").select("doc_id", "label")
    labelled = known_texts.join(F.broadcast(once), "doc_id").select("text", "label")
    model = fit_lexicon(labelled, keep, least_z=least_z, stem=stem)
    scanned = keep(scan(source, model), "passages")
    scanned = scanned.withColumn("root", F.sqrt("evidence"))
    curve = fit_logistic(scanned.join(known, "doc_id"), "root", "label") if len(model.hashes) else None
    score = logistic(curve, "root") if curve else F.lit(0.0)
    return scanned.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
        "passages",
    )
