"""Token alignment: against whole texts encoded one by one, and the search by itself."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from cases import corpus, documents_frame, frame, none, odd  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from areascore.llm import token_alignment as ta
from areascore.llm.batches import documents
from areascore.llm.queries import QUERIES, tokenizer_path

A_PATH, B_PATH = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
SF_DIR = "/root/testdata/sf0.001"


def byte_ranges(tokens):
    ends = np.cumsum([len(t) for t in tokens]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def brute(docs):
    """doc_id -> (n_a, n_b, n_groups, n_links, n_best, count_sum, groups), texts encoded as a whole."""
    tokenizer, _ = ta.load_first(A_PATH)
    pieces, _ = ta.load_second(B_PATH)
    to_byte = ta.byte_level()
    found, links, every = {}, {}, Counter()
    for d, text in docs:
        found[d], links[d] = (0, 0, 0, 0, ""), []
        if not text:
            continue
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids
        b = pieces.encode(text)
        a_bytes = [bytes(to_byte[c] for c in tokenizer.id_to_token(i)) for i in a]
        names = [pieces.id_to_piece(i) for i in b]
        b_bytes = [
            bytes([int(n[3:-1], 16)]) if pieces.is_byte(i) else n.replace("▁", " ").encode()
            for i, n in zip(b, names, strict=True)
        ]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            continue
        x, y = byte_ranges(a_bytes), byte_ranges(b_bytes)
        groups, i, j = [], 0, 0
        for cut in sorted({e for _, e in x} & {e for _, e in y}):
            m, n = i, j
            while m < len(x) and x[m][1] <= cut:
                m += 1
            while n < len(y) and y[n][1] <= cut:
                n += 1
            groups.append((a[i:m], b[j:n]))
            links[d] += [(a[p], b[q]) for p in range(i, m) for q in range(j, n) if x[p][0] < y[q][1] and y[q][0] < x[p][1]]
            i, j = m, n
        text_of = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        found[d] = (len(a), len(b), len(groups), len(links[d]), text_of)
        every.update(links[d])
    most = Counter()
    for (_, b), n in every.items():
        most[b] = max(most[b], n)
    return {
        d: (*f[:4], sum(every[p] == most[p[1]] for p in links[d]), sum(every[p] for p in links[d]), f[4])
        for d, f in found.items()
    }


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def check(got, docs):
    want = brute(docs)
    assert {r.doc_id: (*(r[c] for c in COLUMNS), r.groups) for r in got.collect()} == want


def test_corpus_in_small_blocks(spark, corpus, documents_frame):
    check(ta.align(documents_frame, A_PATH, B_PATH, block_bytes=5_000), corpus)


@pytest.mark.parametrize("piece", ["x", " ", "\n"])
def test_awkward_texts(spark, piece):
    texts = [
        "<|endoftext|> and <s> </s> <unk>", "<0x41> a", "▁under ▁ line", "a▁ b", " leading", "trailing ", "   ", "\t\ta  b",
        "no break 　 wide", "é à́ ", "日本語 中文 かな", "\U0001f600 \U0001f600x", "don't I'll", "\x00 nul \x1f x",
        "a   b", "12345 6789", "x" * 3_000, "ab " * 500, "\u0085 next", "tab\tand\x0bothers\x0c \r\n",
    ]
    docs = [(i, t) for i, t in enumerate(texts)] + [(100 + i, piece + t + piece) for i, t in enumerate(texts)]
    check(ta.align(frame(spark, docs), A_PATH, B_PATH), docs)


def test_query_keeps_its_contract(spark):
    docs = [(r.doc_id, r.text) for r in documents(spark, SF_DIR).collect()]
    want = brute(docs)
    got = {r.doc_id: r for r in QUERIES["op12_token_alignment"](spark, SF_DIR).collect()}
    assert set(got) == set(want) and any(w[0] for w in want.values())
    for d, w in want.items():
        assert tuple(got[d][c] for c in COLUMNS) == w[:6]
        assert got[d].groups_sha256 == (hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "")


def test_odd_rows(spark, odd, none):
    got = [(r.doc_id, r.n_a, r.groups) for r in ta.align(odd, A_PATH, B_PATH).collect()]
    assert len(got) == 7
    three = [g for g in got if g[0] in (5, None) and g[1]]
    assert len(three) == 3 and len({g[1:] for g in three}) == 1
    assert sorted(g[0] or -1 for g in got if not g[1]) == [-1, 2, 9]
    assert all(g[2] == "" for g in got if not g[1])
    assert [g[1] > 0 for g in got if g[0] == 3] == [True]  # two spaces are tokens of both
    assert ta.align(none, A_PATH, B_PATH).count() == 0


def test_nothing_but_refused_texts(spark):
    docs = [(1, "▁"), (2, None), (3, "")]
    check(ta.align(frame(spark, docs), A_PATH, B_PATH), docs)


rising = st.lists(st.integers(1, 40), max_size=60).map(lambda x: np.cumsum(np.array(x, dtype=np.int64)))


@settings(max_examples=200, deadline=None)
@given(rising, rising)
def test_galloping_finds_what_searching_finds(a, b):
    assert ta.lower_bounds(a, b).tolist() == np.searchsorted(b, a).tolist()
    i, j = ta.common_ends(a, b)
    assert a[i].tolist() == b[j].tolist() == np.intersect1d(a, b).tolist()


@settings(max_examples=100, deadline=None)
@given(rising, rising)
def test_overlaps_of_two_partitions(a, b):
    if not len(a) or not len(b):
        return
    end = max(a[-1], b[-1])
    a, b = (x if x[-1] == end else np.append(x, end) for x in (a, b))
    first, many = ta.overlaps(a, b, *ta.common_ends(a, b))
    x, y = ([(s, e) for s, e in zip([0, *z[:-1].tolist()], z.tolist(), strict=True)] for z in (a, b))
    for i, (s, e) in enumerate(x):
        assert [j for j, (p, q) in enumerate(y) if p < e and s < q] == list(range(first[i], first[i] + many[i]))
    assert many.sum() == len(a) + len(b) - len(np.intersect1d(a, b))


def test_hot_pair_costs_a_row_a_block(spark):
    """The same words in every text: the pairs of a block are rows once, whatever its texts."""
    docs = frame(spark, [(i, "the same words " * 20) for i in range(400)]).repartition(4)
    found = ta._first_pass(docs.select("doc_id", "text"), A_PATH, B_PATH, ta.BLOCK)
    rows = found.filter("size(pairs) > 0").collect()
    assert len(rows) <= 4 and all(len(r.pairs) < 10 for r in rows)
    got = ta.align(docs, A_PATH, B_PATH).select(*COLUMNS).distinct().collect()
    assert len(got) == 1 and got[0].n_links * 400 <= got[0].count_sum


def test_encodings_and_text_in_portions(monkeypatch):
    """What is held at a time is bounded, and portions of any size give the same columns."""
    texts = [f"word{i} plain text {i * 7919} é{i}" for i in range(3000)]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    added, add = [], ta.Pieces.add

    def counted(self, raw):
        added.append(len(raw))
        add(self, raw)

    monkeypatch.setattr(ta.Pieces, "add", counted)

    def aligned():
        found = ta._aligned(data, offsets, ta.Pieces(ta.load_first(A_PATH), ta.load_second(B_PATH)))
        return {name: np.asarray(x).tolist() if isinstance(x, np.ndarray) else x.to_pylist() for name, x in found.items()}

    whole = aligned()
    assert sum(added) > 8192 >= max(added)
    monkeypatch.setattr(ta, "ADDED", 100)
    monkeypatch.setattr(ta, "RENDERED", 333)
    assert aligned() == whole
