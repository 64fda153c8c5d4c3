"""Words, word hashes and shingles of whole Arrow batches, in numpy.

A word is a run of bytes other than space and tab to carriage return. All functions work on the
UTF-8 bytes of a batch at once and in tiles of bounded size, so memory follows the batch, not the
longest text. Hashes have 64 bits: polynomials over random byte values, finished by a mixer, for words of
up to ``LONG`` bytes. Polynomials modulo a power of two send some long words to one value (those made by doubling
two letters, from 1,024 bytes on, whatever the values are), so longer words are digested with a keyed blake2b. Hashes
are the same in every process and on every machine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
TILE = 1 << 18  # bytes hashed at a time
LONG = 32  # bytes of a word from which on it is digested
SLICE = 1 << 21  # bytes of the documents looked at together
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
IS_WHITE = np.zeros(256, dtype=bool)
IS_WHITE[list(WHITE)] = True
IS_LETTER = np.zeros(256, dtype=bool)  # A-Z, a-z and every byte of longer characters
IS_LETTER[65:91] = IS_LETTER[97:123] = IS_LETTER[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    steps = np.full(TILE + 1, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_POWER, _INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def row_slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes together; a longer row is a range of its own."""
    row, last = 0, len(offsets) - 1
    while row < last:
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(end, row + 1), last)
        yield row, end
        row = end


class Words:
    """Words of some rows: where each starts and ends, and ``first[row]``, the row's first word.

    ``gaps`` says for each byte value whether it lies between words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = IS_WHITE):
        self.data, self.offsets = data, offsets
        full = ~gaps[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.concatenate(([True], ~full[:-1])) if len(full) else full
        after = np.concatenate((~full[1:], [True])) if len(full) else full
        self.starts = np.flatnonzero(full & (before | edge[:-1]))
        self.ends = np.flatnonzero(full & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)

    @classmethod
    def of(cls, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Words:
        """Any stretches of bytes in order, as words of one row."""
        self = cls.__new__(cls)
        self.data, self.offsets, self.starts, self.ends = data, np.array([0, len(data)]), starts, ends
        self.first = np.array([0, len(starts)])
        return self

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, fold: np.ndarray | None = None) -> np.ndarray:
        """One 64-bit hash a word; ``fold`` maps bytes first, :data:`LOWER` for A-Z."""
        values = _BYTE if fold is None else _BYTE[fold]
        out = np.zeros(len(self), dtype=np.uint64)
        word = 0
        while word < len(self):
            begin = self.starts[word]
            stop = int(np.searchsorted(self.ends, begin + TILE, side="right"))
            if stop > word:
                span = self.data[begin : self.ends[stop - 1]]
                sums = np.empty(len(span) + 1, dtype=np.uint64)
                sums[0] = 0
                np.cumsum(values[span] * _POWER[: len(span)], out=sums[1:])
                s, e = self.starts[word:stop] - begin, self.ends[word:stop] - begin
                out[word:stop] = (sums[e] - sums[s]) * _INVERSE[s] + (e - s).astype(np.uint64)
            word = max(stop, word + 1)
        out = mix(out)
        for word in np.flatnonzero(self.ends - self.starts > LONG).tolist():
            content = self.data[self.starts[word] : self.ends[word]]
            content = (content if fold is None else fold[content]).tobytes()
            out[word] = int.from_bytes(hashlib.blake2b(content, digest_size=8, key=b"word").digest(), "little")
        return out

    def dictionary(self) -> pa.DictionaryArray:
        """The words as an Arrow dictionary: equal numbers for equal words and for no others."""
        steps = np.zeros(len(self.data) + 1, dtype=np.int8)
        steps[self.starts] += 1
        steps[self.ends] -= 1
        full = self.data[np.cumsum(steps[:-1], dtype=np.int8) > 0]
        offsets = np.concatenate(([0], np.cumsum(self.ends - self.starts))).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(full)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self), buffers).dictionary_encode()

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def joined(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and row offsets of the words, or those of a mask, with one space between two."""
        which = np.arange(len(self)) if keep is None else np.flatnonzero(keep)
        rows, ends = self.rows()[which], self.ends[which]
        steps = np.zeros(len(self.data) + 1, dtype=np.int8)
        steps[self.starts[which]] += 1
        steps[ends] -= 1
        taken = np.cumsum(steps[:-1], dtype=np.int8) > 0
        between = ends[:-1][rows[1:] == rows[:-1]]  # a later word follows, so white space does
        taken[between] = True
        data = self.data.copy()
        data[between] = 0x20
        sums = np.concatenate(([0], np.cumsum(taken, dtype=np.int64)))
        return data[taken], sums[self.offsets]


def windows(hashes: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hash of ``width`` consecutive words from every word on, rows not looked at.

    Doubling: a window is put together from windows of half the width.
    """
    if len(hashes) < width:
        return np.zeros(0, dtype=np.uint64)
    factor = np.uint64((0xD6E8FEB86659FD93 + 2 * salt) & ((1 << 64) - 1))

    def join(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
        n = len(b) - shift
        return mix(a[:n] * factor + (b[shift:] ^ np.uint64(salt)))

    power, out, done = hashes, None, 0
    bit, level = width, 1
    while bit:
        if bit & 1:
            out = power if out is None else join(out, power, done)
            done += level
        bit >>= 1
        if bit:
            power = join(power, power, level)
            level *= 2
    return out


def distinct_pairs(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row, sorted by row and value."""
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], rows[new]
