"""Periodic runs: against comparing all words at every distance."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from cases import corpus, documents_frame, frame, none, odd  # noqa: F401

from areascore.llm import periodic_runs as pr
from areascore.llm.batches import documents
from areascore.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def brute_runs(words, least=24):
    """(start, length, period), by start and period."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def a_text(draw):
    words = [draw.randrange(draw.choice([1, 2, 3, 50])) for _ in range(draw.choice([0, 1, 23, 24, 60, 300]))]
    for _ in range(draw.randrange(4)):
        period = draw.choice([1, 2, 5, 8, 9, 16, 17, 18, 25, 26, 27, 39, 40, 41, 60, 61, 92, 140])
        values = draw.choice([1, 2, 3, 400])
        block = [draw.randrange(values) for _ in range(period)]
        length = int(period * draw.choice([2, 2.9, 3, 3, 3.1, 5, 8])) + draw.randrange(3)
        at = draw.randrange(len(words) + 1)
        words[at:at] = [block[i % period] for i in range(length)]
    return words


@pytest.mark.parametrize("seed", range(25))
def test_all_runs_and_no_others(seed):
    draw = random.Random(seed)
    rows = [a_text(draw) for _ in range(8)]
    first = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    got = pr.runs(np.array(sum(rows, []), dtype=np.int32), first).tolist()
    want = [[s + at, s + n + at, q] for at, row in zip(first.tolist(), rows, strict=False) for s, n, q in brute_runs(row)]
    assert got == want


def test_every_period_of_exactly_three_times():
    draw = random.Random(1)
    for period in range(8, 150):
        block = [draw.randrange(10**6) for _ in range(period)]
        words = [-1 - i for i in range(5)] + block * 3 + [-10, -11]
        got = pr.runs(np.array(words) + 20, np.array([0, len(words)])).tolist()
        assert got == [[5, 5 + 3 * period, period]]


def test_scales_leave_no_period_out():
    found = pr.scales(10**6)
    assert found[0][0] == pr.SHORT + 1
    assert all(b[0] == a[1] + 1 for a, b in zip(found, found[1:], strict=False))
    assert all(low <= high and width >= 1 and width + high - 1 <= 2 * low for low, high, width in found)


@pytest.mark.parametrize("least", [24, 6])
def test_corpus(spark, corpus, documents_frame, least):
    for r in pr.find_runs(documents_frame, least).collect():
        text = dict(corpus)[r.doc_id]
        if text is not None and len(text) > 100_000:
            assert [tuple(x) for x in r.runs] == [(0, 30_000, 1)] and r.text == "long"
            continue
        want = brute_runs(words_of(text), least)
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(words_of(text)), want)
        assert r.text == (None if text is None else collapsed(words_of(text), want))


def test_query_keeps_its_contract(spark):
    docs = {r.doc_id: r.text for r in documents(spark, SF_DIR).collect()}
    some = 0
    for r in QUERIES["op13_periodic_runs"](spark, SF_DIR).collect():
        words = planted(r.doc_id, words_of(docs[r.doc_id]))
        runs = brute_runs(words)
        best = None
        for s, n, q in runs:
            if best is None or n * best[2] > best[1] * q:
                best = (s, n, q)
        some += len(runs)
        shown = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert tuple(r)[:6] == (r.doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert some > 5


def test_odd_rows(spark, odd, none):
    got = sorted(((r.doc_id, r.n_words, r.runs, r.text) for r in pr.find_runs(odd).collect()), key=repr)
    three = "one two three"
    want = [(5, 3, [], three), (5, 3, [], three), (None, 3, [], three), (None, 0, [], None), (9, 0, [], None), (2, 0, [], ""), (3, 0, [], "")]
    assert got == sorted(want, key=repr)
    assert pr.find_runs(none).count() == 0


def test_long_texts_take_time_in_proportion(spark):
    draw = np.random.default_rng(2)
    seconds = []
    for n in (100_000, 800_000):
        start = time.perf_counter()
        words = np.concatenate([draw.integers(0, 1000, n), np.zeros(n, dtype=np.int64), np.arange(n) % 1700])
        assert len(pr.runs(words, np.array([0, len(words)]))) >= 2
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 30 * max(seconds[0], 0.1)


def test_same_words_in_two_rows_are_no_run(spark):
    docs = [(1, "a b c " * 5), (2, "a b c " * 5), (3, "a b c " * 9)]
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in pr.find_runs(frame(spark, docs)).collect()}
    assert got == {1: [], 2: [], 3: [(0, 27, 3)]}
