"""Alignment of two tokenizers by galloping intersection.

Both tokenizers cut the same bytes (a space and the text), so a text has two rising lists of token ends.
The shorter list drives: each of its ends is searched in the longer one from the place of a
neighbour, by doubling steps and then by halving. Ends in both lists slice the text into groups.
The ranks of a token's two ends in the other list differ by the number of tokens it overlaps, which
gives the links. How often a pair of ids is linked in the whole corpus says how well it fits.

Encoding: texts are cut before a plain space that has other than white space on both sides. The
pre-tokenizer of the first kind starts anew there, and no piece of the second kind may hold a space behind
another character, which is checked when it is loaded; so tokens never cross a cut. A process encodes a
piece once while it remembers it, a stretch without such a space as a whole, whatever its length.

Scale: a block is about ``BLOCK`` bytes of texts, or one longer text. It passes on its distinct id pairs with
their counts and, for each text, which pieces it is made of. Pairs are summed over all blocks, each block gets
back the counts of the pairs it has, and adds them up for its texts. Neither texts nor tokens are shuffled. Rows of a
block are bounded by its bytes, and a pair that every text has costs one row a block.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areascore.llm.batches import Kept, lists, map_batches, texts
from areascore.llm.words import row_slices, text_bytes

BLOCK = 1 << 21
CHUNK = 1 << 12  # bytes that go to an encoder as one string
STORED = 1 << 18  # pieces that a process remembers
ADDED = 1 << 13  # pieces that are encoded at a time: encodings take up some hundred times the bytes of their text
RENDERED = 1 << 15  # groups that are written as text at a time
SPACE = "▁"
COMMA, BAR, SEMICOLON = b",|;"
# First bytes of characters among which there is white space beyond ASCII (U+0085, U+00A0, U+1680, U+2000 to U+3000).
MAYBE_WHITE = np.zeros(256, dtype=bool)
MAYBE_WHITE[:0x21] = MAYBE_WHITE[0x7F] = True
MAYBE_WHITE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


@dataclass
class Vocabulary:
    """Bytes of each id, one after another; ``digits`` has the ids as text with a place for one more byte."""

    data: np.ndarray
    offsets: np.ndarray
    digits: np.ndarray
    n_digits: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens])))
        width = len(str(len(tokens))) + 1
        digits = np.array([str(i).ljust(width) for i in range(len(tokens))], dtype=f"S{width}")
        return cls(
            np.frombuffer(b"".join(tokens), dtype=np.uint8),
            offsets,
            digits.view(np.uint8).reshape(-1, width),
            np.array([len(str(i)) for i in range(len(tokens))]),
        )

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return self.offsets[ids + 1] - self.offsets[ids]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spans(self.offsets[ids], self.lengths(ids))]


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of start, start + 1, … of each span, one span after another."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def byte_level() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte.

    Printable bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def load_first(path: str):
    """A byte-level tokenizer of a .json file that takes special strings for plain text, and its vocabulary."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    names = {i: name for name, i in tokenizer.get_vocab(with_added_tokens=True).items()}
    to_byte = byte_level()
    size = max(names) + 1
    return tokenizer, Vocabulary.of([bytes(to_byte.get(c, 0x3F) for c in names.get(i, "")) for i in range(size)])


@lru_cache(maxsize=2)
def load_second(path: str):
    """A piece tokenizer of a .model file, and its vocabulary; refuses one whose pieces hold inner spaces."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(pieces.get_piece_size()):
        name = pieces.id_to_piece(i)
        if SPACE in name.lstrip(SPACE):
            raise ValueError(f"{path}: a space inside the piece {name!r}")
        if pieces.is_byte(i):
            tokens.append(bytes([int(name[3:-1], 16)]))
        else:
            tokens.append(name.replace(SPACE, " ").encode())
    return pieces, Vocabulary.of(tokens)


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start: at each row, and before each safe space inside one."""
    at = np.flatnonzero(data[1:-1] == 0x20) + 1 if len(data) > 2 else np.zeros(0, dtype=np.int64)
    after = data[at + 1]
    before = data[at - 1]
    for back in (2, 3, 4):  # the first byte of the character before
        inside = (before & 0xC0) == 0x80
        before = np.where(inside, data[np.maximum(at - back, 0)], before)
    start = np.zeros(len(data) + 1, dtype=bool)
    start[at[~MAYBE_WHITE[after] & ~MAYBE_WHITE[before]]] = True
    start[offsets[:-1]] = True
    return np.flatnonzero(start)


def lower_bounds(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each value of a rising list, the first place in a longer one whose value is not less.

    Values far apart are placed first; one halfway between two that are placed gallops from the left
    one's place, never beyond the right one's.
    """
    n = len(short)
    if not n:
        return np.zeros(0, dtype=np.int64)
    found = np.full(n + 1, len(long), dtype=np.int64)
    found[:1] = _gallop(short[:1], long, np.zeros(1, dtype=np.int64), found[n:])
    step = (1 << (n - 1).bit_length()) >> 1
    while step:
        at = np.arange(step, n, 2 * step)
        found[at] = _gallop(short[at], long, found[at - step], found[np.minimum(at + step, n)])
        step >>= 1
    return found[:n]


def _gallop(values: np.ndarray, long: np.ndarray, low: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Lower bounds of ``values`` within [low, limit]: steps of 1, 2, 4, …, then halving between the last two."""
    low, high = low.copy(), limit.copy()
    active, step = np.arange(len(values)), 1
    while len(active):
        probe = low[active] + step - 1
        inside = probe < high[active]
        active, probe = active[inside], probe[inside]
        less = long[probe] < values[active]
        high[active[~less]] = probe[~less]
        low[active[less]] = probe[less] + 1
        active = active[less]
        step *= 2
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) >> 1
        less = long[middle] < values[active]
        low[active[less]] = middle[less] + 1
        high[active[~less]] = middle[~less]
        active = active[low[active] < high[active]]
    return low


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the ends they share; the shorter list drives."""
    if len(a_ends) > len(b_ends):
        b, a = common_ends(b_ends, a_ends)
        return a, b
    at = lower_bounds(a_ends, b_ends)
    same = at < len(b_ends)
    same[same] = b_ends[at[same]] == a_ends[same]
    return np.flatnonzero(same), at[same]


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray, a_common: np.ndarray, b_common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First overlapping token of the other list, and how many overlap, of each token of the first list.

    Inside a group only its last ends agree. There the rank of an end among the other ends says which
    token holds it; the next token starts in that one, or in the next if both end.
    """
    last = lower_bounds(a_ends, b_ends)
    first = np.concatenate(([0], last[:-1]))
    after = a_common[a_common + 1 < len(a_ends)]
    first[after + 1] += 1
    return first, last - first + 1


def _rendered(
    a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray, text_ends: np.ndarray, first: Vocabulary, second: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all groups, and the bytes of each group with the sign behind it.

    ``a_cuts`` and ``b_cuts`` are the tokens up to each group; ``text_ends`` marks the last group of a text.
    """
    n_a, n_b = np.diff(a_cuts), np.diff(b_cuts)
    a_at = np.arange(len(a)) + np.repeat(b_cuts[:-1], n_a)
    b_at = np.arange(len(b)) + np.repeat(a_cuts[1:], n_b)
    a_sign, b_sign = (np.full(len(x), COMMA, dtype=np.uint8) for x in (a, b))
    a_sign[a_cuts[1:] - 1] = BAR
    b_sign[b_cuts[1:] - 1] = np.where(text_ends, 0, SEMICOLON)
    width = max(first.digits.shape[1], second.digits.shape[1])
    cells = np.zeros((len(a) + len(b), width), dtype=np.uint8)
    sizes = np.empty(len(cells), dtype=np.int64)
    for ids, at, sign, v in ((a, a_at, a_sign, first), (b, b_at, b_sign, second)):
        cells[at, : v.digits.shape[1]] = v.digits[ids]
        cells[at, v.n_digits[ids]] = sign
        sizes[at] = v.n_digits[ids] + (sign > 0)
    sums = np.concatenate(([0], np.cumsum(sizes)))
    return cells[np.arange(width) < sizes[:, None]], np.diff(sums[a_cuts + b_cuts])


def _ids(encode, vocabulary: Vocabulary, pieces: list[str], sizes: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ids of all pieces, and where those of each piece start and how many there are.

    Pieces go to the encoder side by side in strings of about ``CHUNK`` bytes, but for those ``alone``; in a
    string whose tokens have other bytes than it they are encoded one by one.
    """
    order = np.argsort(alone, kind="stable")
    ends = np.cumsum(sizes[order])
    chunk = np.where(alone[order], len(order) + np.arange(len(order)), ends // CHUNK)
    first = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
    bounds = np.append(first, len(order))
    parts = [pieces[i] for i in order.tolist()]
    found = encode(["".join(parts[x:y]) for x, y in zip(first.tolist(), bounds[1:].tolist(), strict=True)])
    flat, counts = np.fromiter(chain.from_iterable(found), dtype=np.int64), np.array([len(x) for x in found])
    sums, last = np.concatenate(([0], np.cumsum(vocabulary.lengths(flat)))), np.cumsum(counts)
    limits = np.concatenate(([0], ends))[bounds]
    fits = sums[last] - sums[last - counts] == np.diff(limits)
    several = np.diff(bounds) > 1
    if (~fits & several).any():
        alone = alone.copy()
        alone[order[np.repeat(~fits & several, np.diff(bounds))]] = True
        return _ids(encode, vocabulary, pieces, sizes, alone)
    # Where a piece's tokens have other bytes, all of them end where it ends.
    token_ends = np.where(
        np.repeat(fits, counts), sums[1:] + np.repeat(limits[:-1] - sums[last - counts], counts), np.repeat(limits[1:], counts)
    )
    stops = np.searchsorted(token_ends, ends, side="right")
    starts, many = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
    starts[order] = np.concatenate(([0], stops[:-1]))
    many[order] = np.diff(np.concatenate(([0], stops)))
    return flat, starts, many


class Pieces:
    """Pieces met so far in a process: ids by both tokenizers, whether both give the piece's bytes, links.

    At most ``STORED`` are kept, which bounds memory; what is forgotten is encoded again.
    """

    def __init__(self, first, second):
        (self.tokenizer, self.a_vocabulary), (self.processor, self.b_vocabulary) = first, second
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        none = np.zeros(0, dtype=np.int64)
        # Values, starts and counts of each piece: ids of both sides, links as pairs a << 32 | b.
        self.a = self.b = self.links = (none, none, none)
        self.good = np.zeros(0, dtype=bool)

    def numbers(self, pieces: pa.Array) -> np.ndarray:
        """The number of each piece, new ones encoded."""
        raw = pieces.to_pylist()
        if len(self.known) + len(raw) > STORED:
            self.forget()
        new = [x for x in raw if x not in self.known]
        for i in range(0, len(new), ADDED):
            self.add(new[i : i + ADDED])
        return np.array([self.known[x] for x in raw], dtype=np.int64)

    def add(self, raw: list[bytes]) -> None:
        texts_of, valid = [], np.ones(len(raw), dtype=bool)
        for i, piece in enumerate(raw):
            try:
                texts_of.append(piece.decode())
            except UnicodeDecodeError:
                texts_of.append("")
                valid[i] = False
        sizes = np.array([len(x.encode()) if v else 0 for x, v in zip(texts_of, valid.tolist(), strict=True)])
        # Whole strings of pieces are cut where a document would be: not at white space, nor at the sign for a space.
        ends = np.array([x[-1] if x else 0 for x in raw], dtype=np.uint8)
        seconds = np.array([x[1] if len(x) > 1 else 0 for x in raw], dtype=np.uint8)
        alone = ~valid | MAYBE_WHITE[seconds] | (ends <= 0x20) | (ends >= 0x7F) | np.array([SPACE in x for x in texts_of], dtype=bool)
        a = _ids(
            lambda x: [e.ids for e in self.tokenizer.encode_batch_fast(x, add_special_tokens=False)],
            self.a_vocabulary, texts_of, sizes, alone,
        )
        b = _ids(
            lambda x: self.processor.encode([t[1:] for t in x], num_threads=1), self.b_vocabulary, texts_of, sizes, alone
        )
        good = valid.copy()
        whole = np.frombuffer(b"".join(raw), dtype=np.uint8)
        begin = np.cumsum([len(x) for x in raw]) - [len(x) for x in raw]
        for (flat, starts, many), v in ((a, self.a_vocabulary), (b, self.b_vocabulary)):
            each = np.flatnonzero(good)
            ids, n = _chosen((flat, starts, many), each), many[each]
            sums, last = np.concatenate(([0], np.cumsum(v.lengths(ids)))), np.cumsum(n)
            equal = sums[last] - sums[last - n] == sizes[each]
            good[each[~equal]] = False
            each = each[equal]
            same = v.joined(_chosen((flat, starts, many), each)) == whole[spans(begin[each], sizes[each])]
            wrong, last = np.concatenate(([0], np.cumsum(~same))), np.cumsum(sizes[each])
            good[each[wrong[last] > wrong[last - sizes[each]]]] = False
        links = self._links(a, b, good)
        base = len(self.known)
        self.known.update((x, base + i) for i, x in enumerate(raw))
        for name, (flat, starts, many) in (("a", a), ("b", b), ("links", links)):
            old = getattr(self, name)
            setattr(self, name, tuple(map(np.concatenate, ((old[0], flat), (old[1], starts + len(old[0])), (old[2], many)))))
        self.good = np.concatenate([self.good, good])

    def _links(self, a_side, b_side, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links of each good piece: pairs, where each piece's start and how many it has."""
        which = np.flatnonzero(good)
        a, b = _chosen(a_side, which), _chosen(b_side, which)
        a_ends, b_ends = np.cumsum(self.a_vocabulary.lengths(a)), np.cumsum(self.b_vocabulary.lengths(b))
        begin, many = overlaps(a_ends, b_ends, *common_ends(a_ends, b_ends))
        sums = np.concatenate(([0], np.cumsum(many)))
        last = np.cumsum(a_side[2][which])
        counts = np.zeros(len(good), dtype=np.int64)
        counts[which] = sums[last] - sums[last - a_side[2][which]]
        return np.repeat(a << 32, many) | b[spans(begin, many)], np.cumsum(counts) - counts, counts


def _chosen(side: tuple[np.ndarray, np.ndarray, np.ndarray], which: np.ndarray) -> np.ndarray:
    """Values of the pieces ``which``, one piece after another."""
    flat, starts, many = side
    return flat[spans(starts[which], many[which])]


@lru_cache(maxsize=1)
def load_pieces(a_path: str, b_path: str) -> Pieces:
    return Pieces(load_first(a_path), load_second(b_path))


def _first_pass(docs: DataFrame, a_path: str, b_path: str, block_bytes: int) -> DataFrame:
    """A row a text: its block, sizes, groups and pieces; the first row of a block has the links of all of its pieces."""

    def work(batch: pa.RecordBatch):
        store = load_pieces(a_path, b_path)
        context = TaskContext.get()
        data, offsets = text_bytes(batch.column("text"))
        for low, high in row_slices(offsets, block_bytes):
            work.block += 1
            block = (context.partitionId() << 32) + work.block if context else work.block
            part = batch.slice(low, high - low)
            yield {"block": np.full(high - low, block), "doc_id": part.column("doc_id")} | _aligned(
                data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], store
            )

    work.block = 0
    schema = (
        "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pieces array<int>, "
        "links array<int>, link_counts array<int>, pairs array<long>, pair_counts array<long>"
    )
    return map_batches(docs, schema, work)


def _aligned(data: np.ndarray, offsets: np.ndarray, store: Pieces) -> dict:
    """The columns of :func:`_first_pass` for the texts of one block."""
    n = len(offsets) - 1
    empty = np.diff(offsets) == 0
    data = np.insert(data, offsets[:-1], 0x20)
    offsets = offsets + np.arange(n + 1)
    starts = cuts(data, offsets)
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)]
    ).dictionary_encode()
    number = store.numbers(column.dictionary)
    piece = column.indices.to_numpy()
    at = np.searchsorted(starts, offsets)
    bad = np.concatenate(([0], np.cumsum(~store.good[number][piece])))
    fine = (bad[at[1:]] == bad[at[:-1]]) & ~empty
    many = np.where(fine, np.diff(at), 0)
    used = piece[np.repeat(fine, np.diff(at))]
    each = number[used]
    a, b = _chosen(store.a, each), _chosen(store.b, each)
    of_text = np.concatenate(([0], np.cumsum(many)))
    a_first, b_first = (np.concatenate(([0], np.cumsum(side[2][each])))[of_text] for side in (store.a, store.b))
    # The ends of all texts of the block make up one rising list for each tokenizer.
    a_ends, b_ends = np.cumsum(store.a_vocabulary.lengths(a)), np.cumsum(store.b_vocabulary.lengths(b))
    a_common, b_common = common_ends(a_ends, b_ends)
    last = np.zeros(len(a), dtype=bool)
    last[a_first[1:][a_first[1:] > a_first[:-1]] - 1] = True
    a_cuts, b_cuts = (np.concatenate(([0], x + 1)) for x in (a_common, b_common))
    group_first = np.searchsorted(a_common, a_first)
    rendered = []
    for low in range(0, max(len(a_common), 1), RENDERED):
        x, y = (c[low : low + RENDERED + 1] for c in (a_cuts, b_cuts))
        rendered.append(
            _rendered(
                a[x[0] : x[-1]], b[y[0] : y[-1]], x - x[0], y - y[0], last[a_common[low : low + RENDERED]],
                store.a_vocabulary, store.b_vocabulary,
            )
        )
    text, sizes = map(np.concatenate, zip(*rendered, strict=True))
    text_at = np.concatenate(([0], np.cumsum(sizes)))[group_first]
    n_a, n_b, n_groups = np.diff(a_first), np.diff(b_first), np.diff(group_first)
    # Pairs of the pieces that occur, counted for the block.
    link_counts = np.where(store.good[number], store.links[2][number], 0)
    pairs, links = np.unique(_chosen(store.links, number), return_inverse=True)
    times = np.repeat(np.bincount(used, minlength=len(number)), link_counts)
    pair_counts = np.bincount(links, weights=times, minlength=len(pairs)).astype(np.int64)
    only = lambda values, kind: lists(values, np.array([len(values), *[0] * (n - 1)]), kind)
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": n_groups,
        "n_links": n_a + n_b - n_groups,
        "groups": pa.LargeStringArray.from_buffers(n, pa.py_buffer(text_at.astype(np.int64)), pa.py_buffer(text)).cast(pa.string()),
        "pieces": lists(used, many, pa.int32()),
        "links": only(links, pa.int32()),
        "link_counts": only(link_counts, pa.int32()),
        "pairs": only(pairs, pa.int64()),
        "pair_counts": only(pair_counts, pa.int64()),
    }


def _sums(texts_of: pa.Table, scores: pa.Table) -> pa.Table:
    """Adds up the scores of a block's pairs for its pieces, and those for its texts."""
    texts_of = texts_of.combine_chunks()

    def flat(name: str) -> tuple[np.ndarray, np.ndarray]:
        column = texts_of.column(name).combine_chunks()
        sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return column.flatten().to_numpy(zero_copy_only=False), sizes

    def added(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        sums, ends = np.concatenate(([0], np.cumsum(values))), np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]

    (links, _), (link_counts, _), (pieces, n_pieces) = flat("links"), flat("link_counts"), flat("pieces")
    out = {name: texts_of.column(name) for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    place = scores.column("place").to_numpy()
    for name, score in (("n_best", "best"), ("count_sum", "count")):
        of_pair = np.zeros(int(links.max(initial=-1)) + 1, dtype=np.int64)
        mine = place < len(of_pair)
        of_pair[place[mine]] = scores.column(score).to_numpy()[mine]
        out[name] = pa.array(added(added(of_pair[links], link_counts)[pieces], n_pieces))
    return pa.table(out | {"groups": texts_of.column("groups")})


def align(
    docs: DataFrame, a_path: str, b_path: str, groups: Column | None = None, block_bytes: int = BLOCK
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups of every row.

    ``a_path`` is a byte-level .json tokenizer, which encodes a space and the text; ``b_path`` a .model, which
    adds the space itself. Special strings are plain text. ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids of both sides of each
    group; the argument of that name is an expression over this text that is kept in its place.

    ``count_sum`` adds up, over the links of a text, how many links of all texts hold the same two
    ids; ``n_best`` counts links whose pair is the most frequent one of its second id. Null and empty texts, and texts whose
    tokens do not give back a space and the text, have no tokens, no groups and zeros. Repeated rows are counted each; a null
    doc_id is carried.
    """
    keep = Kept(docs.sparkSession)
    found = _first_pass(texts(docs), a_path, b_path, block_bytes)
    if groups is not None:
        found = found.withColumn("groups", groups)
    found = keep(found, "aligned")
    each = found.filter(F.size("pairs") > 0).select(
        F.col("block").alias("of_block"), F.posexplode(F.arrays_zip("pairs", "pair_counts")).alias("place", "x")
    )
    each = each.select("of_block", "place", F.col("x.pairs").alias("pair"), F.col("x.pair_counts").alias("n"))
    counts = keep(each.groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b_id")
    most = counts.groupBy(b_id).agg(F.max("count").alias("most"))  # at most one row for each id of the second vocabulary
    ranked = counts.withColumn("b_id", b_id).join(most, "b_id")
    ranked = ranked.select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    scores = each.drop("n").join(ranked, "pair").drop("pair")
    kind = dict(found.dtypes)["groups"]
    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        f"groups {kind}"
    )
    rows = found.drop("pairs", "pair_counts")
    return rows.groupBy("block").cogroup(scores.groupBy("of_block")).applyInArrow(_sums, schema)
