import brute
import numpy as np
import pyarrow as pa
import pytest
from cases import frame
from hypothesis import given, settings
from hypothesis import strategies as st

from areascore.llm import minhash, relative_lz
from areascore.llm import words as w

TEXT = st.text(st.sampled_from("abAB é\t\n\x0b\x0c\r\x1f 日"), max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=6))
def test_words_of_rows(texts):
    data, offsets = w.text_bytes(pa.array(texts, pa.string()))
    found = w.Words(data, offsets)
    expected = [brute.words(t) for t in texts]
    assert found.counts().tolist() == [len(x) for x in expected]
    got = [data[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends, strict=True)]
    assert got == [x for row in expected for x in row]
    hashes, folded = found.hashes().tolist(), found.hashes(w.LOWER).tolist()
    assert len(set(hashes)) == len(set(got))
    assert len(set(folded)) == len({brute.lowered(x) for x in got})
    keep = np.arange(len(got)) % 3 != 1
    for mask in (None, keep):
        joined, cuts = found.joined(mask)
        kept, at = [], 0
        for row in expected:
            kept.append(" ".join(x for i, x in enumerate(row, at) if mask is None or mask[i]))
            at += len(row)
        assert [joined[a:b].tobytes().decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == kept


def test_hashes_do_not_depend_on_tiles(monkeypatch):
    text = " ".join(["word", "x" * 1000, "é", "word"] * 50)
    data, offsets = w.text_bytes(pa.array([text]))
    expected = w.Words(data, offsets).hashes().tolist()
    for tile in (33, 100, 1500):
        monkeypatch.setattr(w, "TILE", tile)
        assert w.Words(data, offsets).hashes().tolist() == expected


@pytest.mark.parametrize("width", [1, 2, 5, 8, 13, 20])
def test_windows_are_equal_when_their_words_are(width):
    values = np.random.default_rng(width).integers(0, 2, 300).astype(np.uint64)
    got = w.windows(values, width).tolist()
    keys = [tuple(values[i : i + width].tolist()) for i in range(len(values) - width + 1)]
    assert len(got) == len(keys)
    assert len(dict(zip(keys, got, strict=True))) == len(set(got)) == len(set(zip(keys, got, strict=True)))
    assert len(w.windows(values[: width - 1], width)) == 0


def test_slices_cover_all_rows():
    offsets = np.array([0, 0, 5, 5, 100, 101, 101])
    for most in (1, 4, 60, 1000):
        ranges = list(w.row_slices(offsets, most))
        assert [x for a, b in ranges for x in range(a, b)] == list(range(6))


def doubled(n):
    """Two words of 2 ** n letters: each doubling puts both together, in either order."""
    u, v = "a", "b"
    for _ in range(n):
        u, v = u + v, v + u
    return u, v


@pytest.mark.parametrize("n", [4, 5, 6, 10, 11, 14, 19])
def test_doubled_words_stay_apart(n):
    u, v = doubled(n)
    data, offsets = w.text_bytes(pa.array([f"x {u} {v} {u} y", u.upper()]))
    words = w.Words(data, offsets)
    hashes = words.hashes()
    assert hashes[1] == hashes[3] != hashes[2] and hashes[5] not in hashes[:5]
    lowered = words.hashes(w.LOWER)
    assert lowered[1] == lowered[5] != lowered[2]


def test_doubled_words_make_no_copies(spark):
    u, v = doubled(10)
    rest = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rest[:15] + [x] + rest[16:])) for i, x in enumerate((u, v))]
    docs += [(2, " ".join([u, *rest])), (3, " ".join([v, *rest])), (4, u), (5, v)]
    got = {r.doc_id: tuple(r)[1:] for r in relative_lz.parse(frame(spark, docs)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()}
    assert got == brute.words_left(docs)
    assert {r[0]: tuple(r)[1:] for r in minhash.near_dedup(frame(spark, docs)).collect()} == brute.near_groups(docs)
