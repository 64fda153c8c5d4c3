"""Language identification: codes, a plain-Python run of the whole, held-out rows and odd ones."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import frame, none, odd  # noqa: F401

from areascore.llm import language_id as li
from areascore.llm.batches import documents
from areascore.llm.queries import QUERIES
from areascore.llm.words import mix

SYLLABLES = {"aa": "ba be bi lo mu", "bb": "ka ke zo xu ri", "cc": "éa ño tü la si", "dd": "да не ли со ку", "ee": "ph th wy oo ck"}


def corpus(n, languages="aa bb cc dd ee", seed=3):
    draw = random.Random(seed)
    docs = []
    for i in range(n):
        lang = draw.choice(languages.split())
        parts = SYLLABLES[lang].split()
        words = ["".join(draw.choices(parts, k=draw.randint(1, 3))) for _ in range(draw.randint(3, 40))]
        docs.append((i, " ".join(words).capitalize() + ".", lang))
    return docs


def rows(spark, docs):
    schema = "doc_id long, text string, lang string, language string, score string, place int"
    return spark.createDataFrame([(*d, "x", "y", 1) for d in docs], schema).repartition(3)


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 12, 40])
def test_codewords_are_apart(n):
    code = li.codewords(n)
    ones = code.sum(axis=0)
    assert ((ones > 0) & (ones < n)).all()
    apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
    assert min(apart) >= {2: 1, 3: 2, 4: 4, 6: 16}.get(n, 5)


def test_a_wrong_bit_is_corrected():
    code = li.codewords(4)
    model = li.Model(list("abcd"), code, np.zeros((li.BUCKETS, 7)), np.ones(7), np.ones(code.shape))
    for lang in range(4):
        for bit in range(7):
            margins = np.where(code[lang], 1.0, -1.0)[None, :].copy()
            margins[0, bit] *= -1
            assert model.distances(margins)[0].argmin() == lang


def brute(docs):
    """doc_id -> distances to the sorted languages, in plain Python."""

    def grams(text):
        for w in re.findall(rb"[A-Za-z\x80-\xff]+", text.lower().encode()):
            w = b" " + w + b" "
            for n in range(1, li.LONGEST + 1):
                for i in range(len(w) - n + 1):
                    key = np.uint64(int.from_bytes(w[i : i + n], "little") | n << 56)
                    yield int(mix(np.array([key]))[0] >> np.uint64(64 - li.BUCKET_BITS))

    found = {d: list(grams(t)) for d, t, _ in docs}
    learned = [(d, lang) for d, _, lang in docs if not is_held_out(d)]
    languages = sorted({lang for _, lang in learned})
    code = li.codewords(len(languages))
    counts = {lang: Counter() for lang in languages}
    for d, lang in learned:
        counts[lang].update(found[d])
    share = lambda g, lang: (counts[lang][g] + li.PRIOR) / (counts[lang].total() + li.PRIOR * li.BUCKETS)
    weights = {}
    for g in {g for f in found.values() for g in f}:
        each = [share(g, lang) for lang in languages]
        weights[g] = [
            math.log(np.mean([s for s, c in zip(each, column, strict=True) if c]))
            - math.log(np.mean([s for s, c in zip(each, column, strict=True) if not c]))
            for column in code.T
        ]
    margins = {d: np.mean([weights[g] for g in f], axis=0) if f else np.zeros(code.shape[1]) for d, f in found.items()}
    own = {lang: [margins[d] for d, x in learned if x == lang] for lang in languages}
    units = np.mean([np.abs(own[lang]).mean(axis=0) for lang in languages], axis=0)
    trust = []
    for lang, word in zip(languages, code, strict=True):
        right = (np.array(own[lang]) * np.where(word, 1, -1) > 0).sum(axis=0)
        accuracy = (right + 1) / (len(own[lang]) + 2)
        trust.append(accuracy / accuracy.sum() * code.shape[1])
    out = {}
    for d, m in margins.items():
        signed = np.where(code, 1, -1) * m / units
        out[d] = (np.logaddexp(0, -2 * signed) * np.array(trust)).sum(axis=1)
    return languages, out


@pytest.mark.parametrize("languages", ["aa bb cc", "aa bb cc dd ee"])
def test_whole_run_by_brute_force(spark, languages):
    docs = corpus(150, languages)
    names, distances = brute(docs)
    for r in li.identify(rows(spark, docs)).collect():
        d = distances[r.doc_id]
        order = np.argsort(d, kind="stable")
        assert (r.lang_pred, r.second) == (names[order[0]], names[order[1]])
        assert r.score == pytest.approx(float(1 / np.exp(d.min() - d).sum()), abs=1e-9)
        assert r.held_out == is_held_out(r.doc_id) and r.ambiguous == (r.score < li.AMBIGUOUS)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in documents(spark, sf_dir).select("doc_id", "lang").collect()}
    got = [r for r in QUERIES["op11_language_id"](spark, sf_dir).collect() if r.held_out]
    assert len(got) > 200 and np.mean([truth[r.doc_id] == r.lang_pred for r in got]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_labels_have_no_part(spark):
    docs = corpus(120)
    wrong = [(d, t, "aa" if is_held_out(d) else lang) for d, t, lang in docs]
    without = [(d, t, None if is_held_out(d) else lang) for d, t, lang in docs]
    a, b, c = (sorted(map(tuple, li.identify(rows(spark, x)).collect())) for x in (docs, wrong, without))
    assert a == b == c


def test_a_mixed_text_is_ambiguous(spark):
    docs = corpus(200, "aa bb")
    halves = [t for _, t, lang in docs if lang == "aa"][:20], [t for _, t, lang in docs if lang == "bb"][:20]
    docs.append((10_000, " ".join(" ".join(p) for p in zip(*halves, strict=True)), None))
    got = {r.doc_id: r for r in li.identify(rows(spark, docs)).collect()}
    assert got[10_000].ambiguous and got[10_000].score < li.AMBIGUOUS
    assert sum(r.ambiguous for r in got.values()) < 20


def test_fit_is_bounded(spark):
    """One doc_id and one language with most rows: the rows learned from stay within the bound."""
    docs = corpus(300, "aa bb") + [(1, "ba be bi", "aa")] * 500
    from areascore.llm.batches import Kept

    chosen = li._fit_rows(rows(spark, docs), Kept(spark), 40).groupBy("language").count().collect()
    assert {r.language for r in chosen} == {"aa", "bb"} and all(r["count"] <= 40 for r in chosen)


def test_odd_rows(spark, odd, none):
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in li.identify(odd).collect()), key=repr)
    want = [(5, "en", 1.0), (5, "en", 1.0), (None, "en", 1.0), (None, "und", 0.0), (9, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert got == sorted(want, key=repr)
    assert li.identify(none).count() == 0


def test_no_language_and_no_letters(spark):
    docs = [(i, t, None) for i, t in enumerate(["words", "", None, "123 !?", "—"])]
    assert {r.lang_pred for r in li.identify(rows(spark, docs)).collect()} == {"und"}
    docs = corpus(60, "aa dd") + [(1000, "12 34", "aa"), (1001, "Да " * 9, None), (1002, "x" * 200_000, None), (1003, "БА", None)]
    got = {r.doc_id: r.lang_pred for r in li.identify(rows(spark, docs)).collect()}
    assert got[1000] == "und" and got[1001] == "dd" and got[1002] in ("aa", "dd")


def test_documents_with_clashing_columns(spark):
    docs = frame(spark, [(i, "some words here") for i in range(20)])
    assert {r.lang_pred for r in li.identify(docs).collect()} == {"en"}
