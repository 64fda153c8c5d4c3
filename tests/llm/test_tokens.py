from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import corpus, none, odd  # noqa: F401
from conftest import rows

from areascore.llm import piece_sampling as ps
from areascore.llm import token_counts as tc
from areascore.llm.queries import tokenizer_path
from areascore.llm.words import mix, text_bytes
from areascore.scratch import release

MODEL = tokenizer_path("piece_bpe_32k.model")
ODD_TEXTS = [
    "", " ", "\n\n", "  a  b\t\tc  ", "▁x ▁▁ y", "日本語 の テキスト　 は  x   y", "<|endoftext|> a<|endoftext|>b <|endo",
    "é à ô", "x" * 3000, "it's  I'll 've  ' s", "😀 😀 ", "a\x1c b \x7f c", "\x00\x01", "12 34  5 a1 b2\r\n x", "ab " * 2000, "日" * 700,
    "漢字，仮名。テスト！다음，한국어。" * 40, "a  b\n\n\tc \r\n d\u3000 e" * 30, "one,two.three" * 40, "，。，。日，，日 。" * 20,
]


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    release(spark)


@pytest.mark.parametrize("batch_bytes", [1, 50, tc.BATCH_BYTES])
def test_counts_are_the_librarys(spark, corpus, batch_bytes):
    docs = [*corpus, *enumerate(ODD_TEXTS, 100_000)]
    path = tokenizer_path()
    tokenizer = tc.load_tokenizer(path)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in tc.count_tokens(df, path, batch_bytes=batch_bytes).collect()}
    for doc_id, text in docs:
        n = len(tokenizer.encode(text or "", add_special_tokens=False))
        row = got[doc_id]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((text or "").encode()), n, n > 512)


@pytest.mark.parametrize("unit", ["漢字仮名，", "한국어。", "line\n", "two  spaces", "tab\t\t"])
def test_long_texts_are_cut_by_bytes(unit):
    text = unit * 2000
    parts = list(tc.safe_parts(text, 500))
    assert "".join(parts) == text
    assert max(len(p.encode()) for p in parts) <= 500 + 4 * len(unit.encode())


def test_balanced_by_bytes():
    groups = list(tc._balanced(iter([(i, "日" * 10) for i in range(100)]), 300))
    assert {len(g) for g in groups} == {10}


def test_only_known_pretokenizers_are_cut(tmp_path):
    import json

    assert tc.can_cut(tokenizer_path())
    plain = {"pre_tokenizer": {"type": "ByteLevel", "use_regex": True, "add_prefix_space": False}}
    others = [
        {}, {**plain, "normalizer": {"type": "NFC"}}, {**plain, "added_tokens": [{"content": "a b"}]},
        {**plain, "added_tokens": [{"content": "<x>", "rstrip": True}]}, {"pre_tokenizer": {"type": "Split"}},
    ]
    for i, content in enumerate([plain, *others]):
        path = tmp_path / f"{i}.json"
        path.write_text(json.dumps(content))
        assert tc.can_cut(str(path)) == (i == 0)


def test_counts_of_odd_rows(odd, none):
    got = rows(tc.count_tokens(odd, tokenizer_path()))
    assert len(got) == 7 and (9, 0, 0, False) in got
    assert tc.count_tokens(none, tokenizer_path()).count() == 0


def segmented(texts, keys):
    v = ps.load_vocabulary(MODEL)
    data, offsets = text_bytes(pa.array(texts))
    pieces, counts = ps.segment(v, data, offsets, keys)
    cuts = np.concatenate(([0], np.cumsum(counts)))
    return [pieces[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def test_round_trip(spark, corpus):
    docs = [*corpus, *enumerate(ODD_TEXTS, 100_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    encoded = ps.encode(df, MODEL).cache()
    assert encoded.filter("not lossless").count() == 0
    assert dict(rows(ps.decode(encoded, MODEL))) == {d: t or "" for d, t in docs}
    encoded.unpersist()


def test_rows_are_segmented_alike_wherever_they_are():
    texts = [t for t in ODD_TEXTS if t] + ["the quick brown fox jumps over it " * 20]
    keys = mix(np.arange(len(texts), dtype=np.uint64))
    together = segmented(texts, keys)
    for i in range(len(texts)):
        assert segmented([texts[i]], keys[i : i + 1]) == [together[i]]
    assert segmented([texts[-1]], keys[:1]) != [together[-1]]


def test_samples_follow_the_weights():
    v = ps.load_vocabulary(MODEL)
    unit = " thanin"

    def every(rest):
        if not rest:
            yield (), 1.0
        for n in range(1, len(rest) + 1):
            piece = v.lookup.get(rest[:n])
            if piece is not None:
                for more, weight in every(rest[n:]):
                    yield (piece, *more), weight * v.weights[piece]

    expected = dict(every(unit.encode()))
    total, n = sum(expected.values()), 20_000
    keys = mix(np.arange(n, dtype=np.uint64))
    got = Counter(map(tuple, segmented([unit] * n, keys)))
    assert set(got) <= set(expected)
    assert max(abs(got[s] / n - w / total) for s, w in expected.items()) < 0.015
    places = mix(keys[:300] ^ mix(np.zeros(1, dtype=np.uint64)))
    one_by_one = [ps._sample_long(v, unit.encode(), k) for k in places]
    assert one_by_one == segmented([unit] * 300, keys[:300])


def test_pieces_of_odd_rows(odd, none):
    got = ps.encode(odd, MODEL)
    assert rows(got.select("doc_id", "n_bytes", "lossless"))[:2] and got.count() == 7
    pairs = got.filter("doc_id = 5").select("pieces").collect()
    assert pairs[0] == pairs[1]
    assert ps.encode(none, MODEL).count() == 0
