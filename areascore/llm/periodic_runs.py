"""Periodic runs of words, by minimizers at several scales.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least
three periods and ``least`` words long, that no neighbouring word extends.

Periods up to ``SHORT`` are found by comparing all words at each such distance. Longer ones fall into
scales of periods from ``low`` to ``high`` = 1.5 ``low``. A scale looks at stretches of ``high`` words and
takes those whose hash is smallest in some window of ``2 low - high + 1`` neighbours. In a run of period q of that
scale

* windows q apart hold the same stretches, so where one has its minimum the other has it as well, and
  both windows fit into a run of three periods, as q + (2 low - high + 1) + high - 1 <= 3 q;
* a stretch of at least q words comes back after q words and not before, or the run's smallest
  period would be less.

So each run leaves two consecutive equal minima exactly q apart. Such pairs are seeds: a seed grows as far as
words q apart agree, and seeds inside a stretch already grown are passed over. A stretch found with a
multiple of its period has the same ends as the one found with the period, which alone is kept.

Scale: a map over Arrow batches, nothing is shuffled and nothing but its own text decides a
row. Work is linear in the words for each scale, and a text takes part in those scales only whose periods
fit into it three times.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from areascore.llm.batches import map_batches, slices, texts
from areascore.llm.words import Words, mix

LEAST = 24  # words of a run
TIMES = 3  # periods of a run
SHORT = 16  # periods found by direct comparison

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FACTOR = np.uint64(0xD6E8FEB86659FD93)
TOP = np.iinfo(np.uint64).max


def scales(longest: int) -> list[tuple[int, int, int]]:
    """(least period, greatest period and words of a stretch, neighbours compared) for texts of so many words."""
    found, low = [], SHORT + 1
    while TIMES * low <= longest:
        high = low * 3 // 2
        found.append((low, high, 2 * low - high + 1))
        low = high + 1
    return found


def _sliding(values: np.ndarray, width: int, extreme: np.ufunc) -> np.ndarray:
    """The extreme of each ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        values = extreme(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return extreme(values[: len(values) - rest], values[rest:])


def _longer(grams: np.ndarray, size: int, to: int) -> np.ndarray:
    """Hashes of ``to`` words from those of ``size`` words, by joining two that overlap or meet.

    The last places, where no ``to`` words follow, hold nothing of use.
    """
    while size < to:
        step = min(size, to - size)
        grams = np.concatenate([mix(grams[:-step] * FACTOR + grams[step:]), grams[-step:]])
        size += step
    return grams


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values of two equally long arrays agree; looks at doubled steps until they do not."""
    at, step = 0, 64
    while at < len(a):
        differ = a[at : at + step] != b[at : at + step]
        if differ.any():
            return at + int(differ.argmax())
        at += step
        step *= 2
    return len(a)


def _short(codes: np.ndarray, row: np.ndarray, least: int) -> np.ndarray:
    """(start, end, period) of stretches with periods up to ``SHORT``."""
    found = [np.zeros((0, 3), dtype=np.int64)]
    for q in range(1, min(SHORT, len(codes) - 1) + 1):
        equal = np.zeros(len(codes) - q + 2, dtype=np.int8)
        equal[1:-1] = (codes[q:] == codes[:-q]) & (row[q:] == row[:-q])
        edges = np.flatnonzero(equal[1:] != equal[:-1]).reshape(-1, 2)
        long = edges[edges[:, 1] - edges[:, 0] + q >= max(least, TIMES * q)]
        found.append(np.column_stack([long[:, 0], long[:, 1] + q, np.full(len(long), q)]))
    return np.concatenate(found)


def _seeds(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(place, period) of consecutive equal minima of all scales; ``counts`` has the words of each row."""
    found = [np.zeros((0, 2), dtype=np.int64)]
    places, size = np.arange(len(codes)), 1
    grams = mix(codes.astype(np.uint64) + np.uint64(1))
    for low, high, width in scales(int(counts.max(initial=0))):
        fits = counts >= TIMES * low
        if not fits.all():
            chosen = np.repeat(fits, counts)
            places, grams, counts = places[chosen], grams[chosen], counts[fits]
        grams, size = _longer(grams, size, high), high
        ends = np.repeat(np.cumsum(counts), counts)
        whole = np.arange(high, len(grams) + high) <= ends
        values = np.where(whole, grams, TOP)
        least = _sliding(np.concatenate([values, np.full(width - 1, TOP)]), width, np.minimum)
        # A stretch is the smallest of some window when the greatest minimum of its windows is its own hash.
        greatest = _sliding(np.concatenate([np.zeros(width - 1, dtype=np.uint64), least]), width, np.maximum)
        at = np.flatnonzero((values == greatest) & whole)
        order = at[np.argsort(values[at], kind="stable")]
        before, after = order[:-1], order[1:]
        apart = after - before
        same = (values[before] == values[after]) & (ends[before] == ends[after]) & (apart >= low) & (apart <= high)
        found.append(np.column_stack([places[before], apart])[same])
    return np.concatenate(found)


def _grown(codes: np.ndarray, first: np.ndarray, end: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """(start, end, period) of the stretches around seeds; ``first`` and ``end`` are those of each word's row."""
    found, last, reached = [], -1, -1
    for p, q in seeds[np.lexsort((seeds[:, 0], seeds[:, 1]))].tolist():
        if q == last and p < reached:
            continue
        a, b = int(first[p]), int(end[p])
        back = _agreeing(codes[a:p][::-1], codes[a + q : p + q][::-1])
        ahead = _agreeing(codes[p : b - q], codes[p + q : b])
        last, reached = q, p + ahead
        found.append((p - back, p + ahead + q, q))
    return np.array(found, dtype=np.int64).reshape(-1, 3)


def runs(codes: np.ndarray, first: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, end, period) of all runs, by start and period; ``first`` cuts the words into rows."""
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    begin, end = first[:-1][row], first[1:][row]
    every = np.concatenate([_short(codes, row, least), _grown(codes, begin, end, _seeds(codes, counts))])
    every = every[every[:, 1] - every[:, 0] >= np.maximum(least, TIMES * every[:, 2])]
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    new = np.ones(len(every), dtype=bool)
    new[1:] = (every[1:, 0] != every[:-1, 0]) | (every[1:, 1] != every[:-1, 1])
    every = every[new]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start and period) and the collapsed text of every row.

    Words are runs of bytes other than space and tab to carriage return, compared as they are and
    numbered from 0. The collapsed text has the words that no run holds after its first period, joined by
    one space. A null text has no words and stays null; an empty one, or one of white space only, becomes
    empty. Rows are judged alone, so repeated rows and rows without a doc_id get the result of their text.
    """

    def work(batch: pa.RecordBatch):
        for part, data, offsets in slices(batch):
            words = Words(data, offsets)
            found = runs(words.dictionary().indices.to_numpy(), words.first, least)
            inside = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(inside, found[:, 0] + found[:, 2], 1)
            np.add.at(inside, found[:, 1], -1)
            left, cuts = words.joined(np.cumsum(inside[:-1]) == 0)
            row = np.searchsorted(words.first, found[:, 0], side="right") - 1
            columns = [found[:, 0] - words.first[row], found[:, 1] - found[:, 0], found[:, 2]]
            at = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
            listed = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_RUN))
            text = pa.LargeStringArray.from_buffers(part.num_rows, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(left))
            known = part.column("text").is_valid()
            yield {
                "doc_id": part.column("doc_id"),
                "n_words": words.counts(),
                "runs": pa.ListArray.from_arrays(pa.array(at), listed),
                "text": pc.if_else(known, text, pa.scalar(None, pa.large_string())).cast(pa.string()),
            }

    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"
    return map_batches(texts(docs), schema, work)
