"""SentencePiece encoding by forward filtering and backward sampling, and decoding.

All segmentations of a text into pieces form a lattice. The forward pass sums, for every position, the
weight of all ways to get there; the backward pass draws the pieces from the end on, each in
proportion to the weight that passes through it, which samples whole segmentations by their
probability. Draws come from a hash of the seed, the row's key, the place in the text and the step, so a
row is segmented alike wherever and with whatever other rows it is encoded.

The vocabulary is that of a public model with byte fallback. Its pieces are ranked, not weighted, so a
piece of rank r weighs ``1 / (r + 10)`` to the power ``sharpness``. A space is part of the piece it
starts, and bytes of characters without a piece are pieces of their own; decoding puts
the bytes of the pieces together and gives back exactly the text, whatever it holds.

Pieces never reach across a space or a line feed, so the lattice falls into short units. The distinct units
of a slice are filtered together and all their places sampled together, in numpy; the few units beyond
``SHORT`` bytes are taken one by one, in time linear in their length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.llm.batches import lists, map_batches, slices, texts
from areascore.llm.words import Words, mix

SHORT = 40
GRIDS = (8, 12, 16, 24, SHORT)  # units up to each size are laid out together
SEED = 11
SHARPNESS = 1.0
_SPACE, _FEED = 0x20, 0x0A


@dataclass
class Vocabulary:
    """Pieces as bytes, with a hash table over those that have a rank."""

    spelled: np.ndarray  # bytes of all pieces, one after another
    begins: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray  # one more than pieces: no piece, -1, weighs nothing
    lookup: dict[bytes, int]  # pieces of the lattice; fallback bytes are not in it
    fallback: np.ndarray  # byte -> piece
    slots: np.ndarray  # hash slot -> piece, two candidates each
    hashes: np.ndarray  # by piece
    lengths: tuple[int, ...]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of pieces, and the offset at which each piece starts and the last ends."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[ids] - (ends - sizes), sizes)
        return self.spelled[at], np.concatenate(([0], ends))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each substring hash, -1 where there is none."""
        out = np.full(len(hashes), -1, dtype=np.int32)
        for table, shift in enumerate((0, 24)):
            piece = self.slots[table][(hashes >> np.uint64(shift)) & np.uint64(_SLOTS - 1)]
            hit = (piece >= 0) & (self.hashes[piece] == hashes)
            out[hit] = piece[hit]
        return out


_SLOTS = 1 << 20
_random = np.random.Generator(np.random.PCG64(99))
_VALUES = _random.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0xA0761D6478BD642F)


def _powers(n: int) -> np.ndarray:
    steps = np.full(n + 1, _BASE, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _piece_hash(piece: bytes) -> np.uint64:
    values = _VALUES[np.frombuffer(piece, dtype=np.uint8)]
    # Highest power first, as substring hashes are rolled.
    return mix(np.array([(values * _powers(len(piece) - 1)[::-1]).sum(dtype=np.uint64)]) + np.uint64(len(piece)))[0]


@lru_cache(maxsize=2)
def load_vocabulary(path: str, sharpness: float = SHARPNESS) -> Vocabulary:
    """The pieces of a model file, once a process."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    spelled, lookup, weights = [], {}, np.zeros(n + 1)
    fallback = np.full(256, -1, dtype=np.int64)
    for i in range(n):
        piece, score = model.id_to_piece(i), model.get_score(i)
        if model.is_byte(i):
            spelled.append(bytes([int(piece[3:5], 16)]))
            fallback[spelled[-1][0]] = i
        elif model.is_control(i) or model.is_unknown(i):
            spelled.append(b"")
        else:
            spelled.append(piece.replace("▁", " ").encode())
            if score > -1e6 and b" " not in spelled[-1][1:]:  # others are runs of spaces without a rank
                lookup[spelled[-1]] = i
                weights[i] = (10.0 - score) ** -sharpness
    weights[fallback] = (10.0 + 10 * n) ** -sharpness
    if (fallback < 0).any():
        raise ValueError(f"{path} has no pieces for single bytes")
    hashes = np.zeros(n, dtype=np.uint64)
    slots = np.full((2, _SLOTS), -1, dtype=np.int32)
    for piece, i in lookup.items():
        hashes[i] = h = _piece_hash(piece)
        for table, shift in enumerate((0, 24)):
            slot = int((h >> np.uint64(shift)) & np.uint64(_SLOTS - 1))
            if slots[table][slot] < 0:
                slots[table][slot] = i
                break
        else:
            raise ValueError("two pieces share both slots")
    sizes = np.array([len(s) for s in spelled], dtype=np.int64)
    return Vocabulary(
        np.frombuffer(b"".join(spelled), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes, weights, lookup,
        fallback, slots, hashes, tuple(sorted({len(p) for p in lookup})),
    )


def _draw(keys: np.ndarray, step: int) -> np.ndarray:
    """Uniform numbers in [0, 1) for the steps of places with these keys."""
    salted = keys + np.uint64((step * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
    return (mix(mix(salted)) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of units: each starts with a space or after a line feed, which is one alone."""
    start = np.zeros(len(data) + 1, dtype=bool)
    start[:-1] = (data == _SPACE) | (data == _FEED)
    start[1:] |= np.append(data == _FEED, False)[: len(data)]
    start[offsets] = True
    start[-1] = True
    at = np.flatnonzero(start)
    return at[:-1], at[1:]


class _Lattices:
    """Forward weights of many short units of about one size; row j is after j bytes of a unit."""

    def __init__(self, vocabulary: Vocabulary, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        v = vocabulary
        n, longest = len(starts), int(sizes.max())
        order = np.argsort(-sizes, kind="stable")
        self.place = np.empty(n, dtype=np.int64)  # row of each unit
        self.place[order] = np.arange(n)
        self.sizes, starts = sizes[order], starts[order]
        reach = np.searchsorted(-self.sizes, -np.arange(longest + 2), side="right")  # units of at least j bytes
        grid = data[np.minimum(starts + np.arange(longest)[:, None], len(data) - 1)]
        self.vocabulary = v
        self.lengths = [x for x in v.lengths if x <= longest]
        self.pieces = {x: np.full((longest - x + 1, n), -1, dtype=np.int32) for x in self.lengths}
        for j in range(longest):
            rolled, size = np.zeros(reach[j + 1], dtype=np.uint64), 0
            for x in self.lengths:
                k = reach[j + x] if j + x <= longest else 0
                if not k:
                    break
                while size < x:
                    rolled = rolled[:k] * _BASE + _VALUES[grid[j + size, :k]]
                    size += 1
                self.pieces[x][j, :k] = v.find(mix(rolled[:k] + np.uint64(x)))
        self._fall_back(grid)
        self.forward = np.zeros((longest + 1, n))
        self.forward[0] = 1
        for j in range(1, longest + 1):
            k = reach[j]
            for x in self.lengths:
                if x > j:
                    break
                self.forward[j, :k] += self.forward[j - x, :k] * v.weights[self.pieces[x][j - x, :k]]

    def _fall_back(self, grid: np.ndarray) -> None:
        """Characters that are no piece go byte by byte; so does what is no character."""
        v, longest = self.vocabulary, len(grid)
        inside = np.arange(longest)[:, None] < self.sizes
        odd = np.flatnonzero(((self.pieces[1] < 0) & inside).any(axis=0))
        if not len(odd):
            return
        byte, inside = grid[:, odd], inside[:, odd]
        covered = np.zeros(byte.shape, dtype=bool)  # inside a character that has a piece
        size = np.where(byte < 0x80, 1, np.where(byte < 0xC0, 0, np.where(byte < 0xE0, 2, np.where(byte < 0xF0, 3, 4))))
        for x in (x for x in (1, 2, 3, 4) if x in self.pieces):
            whole = (size[: longest - x + 1] == x) & (self.pieces[x][:, odd] >= 0)
            for step in range(x):
                covered[step : step + len(whole)] |= whole
        j, i = np.nonzero(inside & ~covered)
        self.pieces[1][j, odd[i]] = v.fallback[byte[j, i]]

    def sample(self, unit: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of a segmentation for every place of a unit, one place after another, and how many each."""
        column = self.place[unit]
        at = self.sizes[column].astype(np.int64)
        place = np.arange(len(unit))
        taken, steps = [], 0
        counts = np.zeros(len(unit), dtype=np.int64)
        while len(place):
            target = _draw(keys[place], steps) * self.forward[at, column]
            chosen = np.zeros(len(place), dtype=np.int64)
            piece = np.zeros(len(place), dtype=np.int32)
            open_ = np.arange(len(place))
            total = np.zeros(len(place))
            for x in self.lengths:
                open_ = open_[at[open_] >= x]
                if not len(open_):
                    break
                j, c = at[open_] - x, column[open_]
                found = self.pieces[x][j, c]
                weight = self.vocabulary.weights[found]
                some = np.flatnonzero(weight)
                if not len(some):
                    continue
                o, j, c = open_[some], j[some], c[some]
                total[o] += self.forward[j, c] * weight[some]
                # Until a draw is met, the piece is the last one with any weight.
                chosen[o], piece[o] = x, found[some]
                met = np.zeros(len(place), dtype=bool)
                met[o[total[o] > target[o]]] = True
                open_ = open_[~met[open_]]
            taken.append((place, piece))
            counts[place] += 1
            at = at - chosen
            more = at > 0
            place, at, column = place[more], at[more], column[more]
            steps += 1
        ends = np.cumsum(counts)
        out = np.empty(ends[-1] if len(ends) else 0, dtype=np.int32)
        for step, (place, piece) in enumerate(taken):
            out[ends[place] - 1 - step] = piece
        return out, counts


def _sample_long(vocabulary: Vocabulary, unit: bytes, key: np.uint64) -> list[int]:
    """One segmentation of a unit of any length; weights are logarithms."""
    v, n = vocabulary, len(unit)
    covered, edges = bytearray(n), [[] for _ in range(n + 1)]
    for i in range(n):
        lead = unit[i]
        size = 0 if 0x80 <= lead < 0xC0 else 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        if size and unit[i : i + size] in v.lookup:
            covered[i : i + size] = b"\1" * size
    forward = [0.0] + [-math.inf] * n
    for j in range(1, n + 1):
        for x in v.lengths:
            if x > j:
                break
            piece = v.lookup.get(unit[j - x : j])
            if piece is not None:
                edges[j].append((x, piece))
        if not covered[j - 1]:
            edges[j] = [(1, int(v.fallback[unit[j - 1]])), *[e for e in edges[j] if e[0] > 1]]
        edges[j] = [(x, piece) for x, piece in edges[j] if forward[j - x] > -math.inf]
        if not edges[j]:  # inside a character
            continue
        logs = [forward[j - x] + math.log(v.weights[p]) for x, p in edges[j]]
        most = max(logs)
        forward[j] = most + math.log(sum(math.exp(x - most) for x in logs))
    out, j, step = [], n, 0
    while j:
        target, total = float(_draw(np.array([key]), step)[0]), 0.0
        for x, piece in edges[j]:  # noqa: B007
            total += math.exp(forward[j - x] + math.log(v.weights[piece]) - forward[j])
            if total > target:
                break
        out.append(piece)
        j -= x
        step += 1
    return out[::-1]


def segment(
    vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Sampled pieces of all rows, one row after another, and how many each row has."""
    n_rows = len(offsets) - 1
    starts, ends = _units(data, offsets)
    if not len(starts):
        return np.zeros(0, dtype=np.int32), np.zeros(n_rows, dtype=np.int64)
    row = np.searchsorted(offsets, starts, side="right") - 1
    key = mix(keys[row] ^ mix((starts - offsets[row]).astype(np.uint64)))
    sizes = ends - starts
    counts = np.zeros(len(starts), dtype=np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for least, most in zip((0, *GRIDS), GRIDS, strict=False):
        which = np.flatnonzero((sizes > least) & (sizes <= most))
        if len(which):
            hashes = Words.of(data, starts[which], ends[which]).hashes()
            _, first, unit = np.unique(hashes, return_index=True, return_inverse=True)
            lattices = _Lattices(vocabulary, data, starts[which][first], sizes[which][first])
            pieces, counts[which] = lattices.sample(unit, key[which])
            parts.append((which, pieces))
    long = np.flatnonzero(sizes > SHORT)
    if len(long):
        each = [_sample_long(vocabulary, data[starts[i] : ends[i]].tobytes(), key[i]) for i in long.tolist()]
        counts[long] = [len(x) for x in each]
        parts.append((long, np.array([p for x in each for p in x], dtype=np.int32)))
    ends_at = np.cumsum(counts)
    out = np.empty(ends_at[-1], dtype=np.int32)
    for which, pieces in parts:
        n = counts[which]
        out[np.arange(len(pieces)) + np.repeat(ends_at[which] - np.cumsum(n), n)] = pieces
    return out, np.bincount(row, weights=counts, minlength=n_rows).astype(np.int64)


def encode(
    docs: DataFrame, model_path: str, key: str = "doc_id", seed: int = SEED, sharpness: float = SHARPNESS
) -> DataFrame:
    """doc_id, n_bytes, n_pieces, pieces (ids) and lossless of every row.

    ``key`` is the column that seeds a row; rows with equal keys and texts are segmented alike, rows
    without one as under the key 0. Null and empty texts have no pieces. ``lossless`` says that the
    pieces were decoded and gave the very bytes of the text.
    """
    source = texts(docs, F.coalesce(F.xxhash64(F.col(key)), F.lit(0)).alias("row_key"))

    def work(batch: pa.RecordBatch):
        v = load_vocabulary(model_path, sharpness)
        salt = mix(np.array([seed], dtype=np.uint64))[0]
        for part, data, offsets in slices(batch):
            keys = mix(part.column("row_key").to_numpy().view(np.uint64) ^ salt)
            pieces, counts = segment(v, data, offsets, keys)
            again, piece_at = v.decode(pieces)
            cuts = piece_at[np.concatenate(([0], np.cumsum(counts)))]
            if np.array_equal(again, data) and np.array_equal(cuts, offsets):
                lossless = np.ones(part.num_rows, dtype=bool)
            else:
                lossless = np.array(
                    [
                        np.array_equal(again[cuts[i] : cuts[i + 1]], data[offsets[i] : offsets[i + 1]])
                        for i in range(part.num_rows)
                    ]
                )
            yield {
                "doc_id": part.column("doc_id"),
                "n_bytes": np.diff(offsets),
                "n_pieces": counts,
                "pieces": lists(pieces, counts, pa.int32()),
                "lossless": lossless,
            }

    schema = "doc_id long, n_bytes long, n_pieces long, pieces array<int>, lossless boolean"
    return map_batches(source, schema, work)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text from rows of (doc_id, pieces); null pieces give the empty text."""

    def work(batch: pa.RecordBatch):
        v = load_vocabulary(model_path)
        out = []
        for value in batch.column("pieces"):
            ids = value.values.to_numpy() if value.is_valid else np.zeros(0, dtype=np.int32)
            out.append(v.decode(ids)[0].tobytes().decode())
        yield {"doc_id": batch.column("doc_id"), "text": pa.array(out, pa.string())}

    return map_batches(encoded.select("doc_id", "pieces"), "doc_id long, text string", work)
