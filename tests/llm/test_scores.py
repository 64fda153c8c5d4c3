import random

import numpy as np
import pytest
from cases import none, odd  # noqa: F401
from conftest import rows

from areascore.llm import minhash, quality, toxicity
from areascore.llm.batches import documents, labels
from areascore.scratch import release

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    release(spark)


def accuracy(spark, scored, label):
    both = scored.join(labels(spark, SF_DIR).select("doc_id", label), "doc_id")
    held = both.filter("held_out").select("predicted", label).collect()
    assert len(held) > 50
    return np.mean([r[0] == r[1] for r in held])


def test_quality_on_held_out_labels(spark):
    scored = quality.quality_scores(documents(spark, SF_DIR), labels(spark, SF_DIR))
    assert scored.count() == documents(spark, SF_DIR).count()
    assert accuracy(spark, scored, "quality") > 0.95


def test_toxicity_on_held_out_labels(spark):
    scored = toxicity.toxicity_scores(documents(spark, SF_DIR), labels(spark, SF_DIR))
    assert scored.count() == documents(spark, SF_DIR).count()
    assert accuracy(spark, scored, "toxic") > 0.9


def test_toxicity_of_a_long_tailed_vocabulary(spark):
    """300 slurs, each in about 1 % of the toxic texts, and no two with a common stem."""
    random_ = random.Random(11)
    letters = "bcdfghjklmnpqrstvwxz"
    slurs = [f"{a}{b}uq{c}" for a in letters for b in letters for c in "x"][:300]
    usual = [f"{c}{v}{d}{w}" for c in letters[:12] for v in "aei" for d in letters[:12] for w in "ao"]
    docs, known = [], []
    for i in range(6_000):
        toxic = i % 8 == 0
        w = [random_.choice(usual) for _ in range(40)]
        if toxic:
            for at in random_.sample(range(40), 4):
                w[at] = random_.choice(slurs)
        docs.append((i, " ".join(w)))
        known.append((i, 1, int(toxic)))
    scored = toxicity.toxicity_scores(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(known, "doc_id long, quality int, toxic int"),
    )
    held = scored.filter("held_out").select("doc_id", "predicted").collect()
    caught = [r.predicted for r in held if r.doc_id % 8 == 0]
    wrong = [r.predicted for r in held if r.doc_id % 8]
    assert np.mean(caught) > 0.95 and np.mean(wrong) < 0.01


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_scores_of_odd_rows(spark, odd, none, score):
    labelled = labels(spark, SF_DIR)
    extra = spark.createDataFrame([(5, 1, 1), (5, 0, 0), (9, 1, 0), (None, 1, 1), (2, None, None)], labelled.schema)
    for known in (extra, labelled.limit(0), extra.filter("quality = 1 and toxic = 1")):
        got = rows(score(odd, known).select("doc_id", "held_out", "score", "predicted"))
        assert len(got) == 7 and all(0 <= r[2] <= 1 for r in got)
        assert len({r[2:] for r in got if r[0] == 5}) == 1
    assert score(none, extra).count() == 0


def test_discriminant_is_the_textbook_one():
    generator = np.random.default_rng(1)
    d = len(quality.FEATURES)
    x = {k: generator.normal(k, 1 + k, size=(200, d)) for k in (0, 1)}
    model = quality._discriminant({k: (len(v), v.sum(0), v.T @ v) for k, v in x.items()}, 0.1)
    z = (x[1][:5] - model.centre) / model.scale
    for k in (0, 1):
        own = (x[k] - model.centre) / model.scale
        covariance = np.cov(own.T, bias=True)
        shrunk = 0.9 * covariance + 0.1 * np.trace(covariance) / d * np.eye(d)
        off = z - own.mean(0)
        expected = -0.5 * (np.einsum("ij,jk,ik->i", off, np.linalg.inv(shrunk), off) + np.linalg.slogdet(2 * np.pi * shrunk)[1])
        assert np.allclose(model.classes[k].log_density(z), expected)


def every_maximal_segment(scores):
    """By the definition: the best segment, then the best of what lies left and right of it."""

    def best(a, b):
        found = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if found is None or found[0] <= 0:
            return []
        *_, i, j = found
        return [*best(a, i), (i, j - 1, found[0]), *best(j, b)]

    return best(0, len(scores))


def test_maximal_segments():
    random_ = random.Random(2)
    for _ in range(200):
        n = random_.randint(0, 14)
        # Distinct powers keep sums apart, so ties do not make the definition ambiguous.
        scores = [random_.random() * 3 if random_.random() < 0.4 else -0.37 for _ in range(n)]
        at = np.array([i for i, s in enumerate(scores) if s > 0], dtype=int)
        got = toxicity.maximal_segments(at, np.array([scores[i] for i in at]), -0.37)
        expected = every_maximal_segment(scores)
        assert [g[:2] for g in got] == [e[:2] for e in expected]
        assert np.allclose([g[2] for g in got], [e[2] for e in expected])


def test_rate_solves_its_equation():
    shares, scores = np.array([0.02, 0.01, 0.97]), np.array([3.0, 2.0, -0.3])
    rate = toxicity._rate(shares, scores)
    assert rate > 0 and abs(shares @ np.exp(rate * scores) - 1) < 1e-9


def test_only_labelled_texts_are_folded(spark, monkeypatch):
    """Near-copy detection reads the stored labelled texts, so no plan of it can shuffle the others."""
    seen = []

    def spy(docs, percent):
        seen.append(docs)
        return near_dedup(docs, percent)

    near_dedup = minhash.near_dedup
    monkeypatch.setattr(toxicity.minhash, "near_dedup", spy)
    docs, known = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    toxicity.toxicity_scores(docs, known, fit_rows=50).count()
    assert len(seen) == 1 and 0 < seen[0].count() <= 50
    assert not any("documents.parquet" in f for f in seen[0].inputFiles())
