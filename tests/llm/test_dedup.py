import collections
import math

import brute
import numpy as np
import pytest
from cases import corpus, documents_frame, none, odd  # noqa: F401
from conftest import rows
from pyspark.sql import functions as F

from areascore.llm import block_naming, components, line_windows, minhash, relative_lz
from areascore.llm.batches import Kept
from areascore.scratch import release


def as_dict(df):
    return {row[0]: tuple(row[1:]) for row in df.collect()}


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    release(spark)


@pytest.mark.parametrize("block_bytes", [16, 4096])
def test_exact_dedup(documents_frame, corpus, block_bytes):
    got = block_naming.exact_dedup(documents_frame, block_bytes)
    assert as_dict(got) == brute.exact_groups(corpus)


def test_names_are_shared_by_equal_texts_only(documents_frame, corpus):
    named = block_naming.name_documents(documents_frame, 16).groupBy("level", "name")
    found = named.agg(F.countDistinct("text_sha256").alias("texts"))
    assert found.filter("texts > 1").count() == 0
    assert found.count() == len({x[3] for x in brute.exact_groups(corpus).values()})


def test_exact_dedup_of_odd_rows(odd, none):
    got = rows(block_naming.exact_dedup(odd).drop("text_sha256"))
    # Null and empty are one group; white space is another; the repeated row stays with itself.
    assert got == sorted(
        [(5, 5, 3, True), (5, 5, 3, True), (None, 5, 3, False), (None, 2, 3, False), (9, 2, 3, False), (2, 2, 3, True), (3, 3, 1, True)],
        key=repr,
    )
    assert block_naming.exact_dedup(none).count() == 0


def test_line_dedup(documents_frame, corpus):
    assert as_dict(line_windows.line_dedup(documents_frame)) == brute.lines_left(corpus)


def test_line_dedup_of_odd_rows(spark, odd, none):
    got = rows(line_windows.line_dedup(odd))
    assert len(got) == 7 and all(r[2] == 0 for r in got)
    assert line_windows.line_dedup(none).count() == 0
    twice = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc"), (4, "a\nb\nc")], "doc_id long, text string")
    assert rows(line_windows.line_dedup(twice).select("doc_id", "n_removed")) == sorted(
        [(1, 0), (1, 0), (None, 0), (4, 3)], key=repr
    )


def test_near_dedup(documents_frame, corpus):
    assert as_dict(minhash.near_dedup(documents_frame)) == brute.near_groups(corpus)


def test_near_dedup_of_large_buckets(documents_frame, corpus, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 3)
    monkeypatch.setattr(minhash, "HUBS", 1)
    monkeypatch.setattr(minhash, "BLOCK", 2)
    assert as_dict(minhash.near_dedup(documents_frame)) == brute.near_groups(corpus)


@pytest.mark.parametrize("percent", [80, 85, 99])
def test_signatures_rule_out_less_than_bands_miss(percent):
    n, share, least = minhash.n_bands(percent) * minhash.ROWS, percent / 100, minhash.least_agreement(percent)
    lost = sum(math.comb(n, k) * share**k * (1 - share) ** (n - k) for k in range(least))
    assert lost <= minhash.MISSED / 1000


def test_pairs_of_the_exact_join_are_confirmed_without_signatures(spark):
    """Sets above and below the threshold whose signatures agree in nothing."""
    n = minhash.n_bands(85) * minhash.ROWS
    rows_ = [(i, 20 - i, list(range(i, 20)), [i] * n) for i in (0, 2, 4)]
    sets = spark.createDataFrame(rows_, "id long, n long, shingles array<long>, minima array<int>")
    pairs = spark.createDataFrame([(0, 2), (0, 4), (2, 4)], "a long, b long")
    keep = Kept(spark)
    assert rows(minhash._confirm(pairs, sets, keep, 85, 0)) == [(0, 2), (2, 4)]
    assert rows(minhash._confirm(pairs, sets, keep, 85, minhash.least_agreement(85))) == []


def _random_sets(n_sets, seed):
    """Sets around a few bases, in numbers that make shared shingles frequent."""
    random = np.random.default_rng(seed)
    bases = [random.integers(-(2**63), 2**63 - 1, size=n) for n in (6, 30, 30, 60)]
    out = []
    for i in range(n_sets):
        base = bases[i % len(bases)]
        own = random.integers(-(2**63), 2**63 - 1, size=int(random.integers(0, 8)))
        out.append(np.unique(np.concatenate((base[random.random(len(base)) > 0.05], own, base[:1]))))
    return out


@pytest.mark.parametrize("percent, block", [(80, 8), (85, 512)])
def test_prefix_pairs_hold_every_link(spark, monkeypatch, percent, block):
    """Every similar pair in different components is paired, once, however frequent its shingles are."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    found = _random_sets(120, percent)
    sets = spark.createDataFrame([(i, len(s), s.tolist()) for i, s in enumerate(found)], "id long, n long, shingles array<long>")
    rest = spark.createDataFrame([(i, i // 3) for i in range(len(found))], "id long, component long")
    got = rows(minhash._prefix_pairs(rest, sets, Kept(spark), percent))
    assert len(got) == len(set(got)) and all(a < b and a // 3 != b // 3 for a, b in got)
    linked = set()
    for a, x in enumerate(found):
        for b in range(a + 1, len(found)):
            both = len(np.intersect1d(x, found[b]))
            if a // 3 != b // 3 and 100 * both >= percent * (len(x) + len(found[b]) - both):
                linked.add((a, b))
    assert linked and linked <= set(got)


def test_parities_differ_in_no_more_bits_than_sets_do():
    found = _random_sets(40, 3)
    for x in found:
        for y in found:
            bits = sum(int(v).bit_count() for v in (minhash.parity(x) ^ minhash.parity(y)).view(np.uint64))
            assert bits <= len(np.setxor1d(x, y))


def test_pairs_of_a_hub_are_dealt_over_blocks(spark, monkeypatch):
    """A document in very many pairs has its set copied to blocks; no block holds more than about ``BLOCK`` pairs."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    base = list(range(40))
    data = [(i, 40, base if i % 2 else base[:20] + list(range(100 * i, 100 * i + 20)), [0]) for i in range(1, 301)]
    sets = spark.createDataFrame([(0, 40, base, [0]), *data], "id long, n long, shingles array<long>, minima array<int>")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 301)], "a long, b long")
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = minhash._with_sets(pairs, sets, "a", Kept(spark)).withColumn("task", F.spark_partition_id())
        found = [tuple(r) for r in met.select("a", "b", F.size("a_set"), "task").collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(r[:3] for r in found) == [(0, i, 40) for i in range(1, 301)]
    assert max(collections.Counter(r[3] for r in found).values()) < 300 and met.filter("size(a_set) = 40").count() == 300


def test_near_dedup_of_odd_rows(odd, none):
    got = rows(minhash.near_dedup(odd))
    assert got == sorted(
        [(5, 1, 5, True), (5, 1, 5, True), (None, 1, 5, False), (None, 0, None, True), (9, 0, 9, True), (2, 0, 2, True), (3, 0, 3, True)],
        key=repr,
    )
    assert minhash.near_dedup(none).count() == 0


@pytest.mark.parametrize("links", [[], [(1, 2), (2, 3), (3, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)] + [(50, 51), (51, 52), (5, 5)]])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    expected = brute.components(nodes, links) if nodes else {}
    assert dict(rows(components.connected_components(df))) == expected


def test_substring_dedup(documents_frame, corpus):
    got = relative_lz.parse(documents_frame)
    assert as_dict(got.drop("factors")) == brute.words_left(corpus)


@pytest.mark.parametrize("alone", [50, 1])
def test_substring_dedup_where_copies_stand_for_an_anchor(spark, alone):
    """Each partition is one Arrow batch, whose first row in order stands for the anchors of the passage."""
    passage = " ".join(f"p{i}" for i in range(30))
    z, w, x = (f"{' '.join(c + str(i) for i in range(25))} {passage} end{c}" for c in "zwx")
    batches = [[(30, z), (5, w)], [(20, w), (3, z)], [(alone, x)]]
    parts = spark.sparkContext.parallelize([r for b in batches for r in b], 1).zipWithIndex()
    at = [i for i, b in enumerate(batches) for _ in b]
    dealt = parts.map(lambda r: (at[r[1]], r[0])).partitionBy(3, lambda k: k).values()
    docs = [r for b in batches for r in b]
    got = relative_lz.parse(spark.createDataFrame(dealt, "doc_id long, text string"))
    assert as_dict(got.drop("factors")) == brute.words_left(docs)


def test_substring_dedup_where_one_text_stands_everywhere(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    z, w = (f"{' '.join(c + str(i) for i in range(25))} {passage} end{c}" for c in "zw")
    docs = [(30, z), (5, w), (3, z)]
    dealt = spark.sparkContext.parallelize([(0, docs[0]), (0, docs[1]), (1, docs[2])], 1)
    dealt = dealt.partitionBy(2, lambda k: k).values()
    got = relative_lz.parse(spark.createDataFrame(dealt, "doc_id long, text string"))
    assert as_dict(got.drop("factors")) == brute.words_left(docs)


def test_factors_are_copies_of_earlier_places(documents_frame, corpus):
    words = {d: brute.words(t) for d, t in corpus}
    parsed = relative_lz.parse(documents_frame).filter("n_removed > 0").collect()
    assert parsed
    for row in parsed:
        for f in row.factors:
            assert f.n >= 20 and (f.ref_doc, f.ref_first) < (row.doc_id, f.first)
            mine = words[row.doc_id][f.first : f.first + f.n]
            assert mine == words[f.ref_doc][f.ref_first : f.ref_first + f.n] and len(mine) == f.n


def test_cut_keeps_the_other_words_and_columns(documents_frame, corpus):
    parsed = relative_lz.parse(documents_frame)
    left = relative_lz.cut(documents_frame, parsed)
    assert left.columns == documents_frame.columns
    texts = {d: t for d, t in corpus}
    expected = brute.without_windows(corpus, brute.words, 20)
    for row in left.collect():
        kept = [x for x, gone in expected[row.doc_id] if not gone]
        assert brute.words(row.text) == kept
        if len(kept) == len(expected[row.doc_id]):
            assert row.text == texts[row.doc_id]


def test_substring_dedup_of_odd_rows(spark, odd, none):
    assert rows(relative_lz.parse(odd).select("doc_id", "n_words", "n_removed")) == sorted(
        [(5, 3, 0), (5, 3, 0), (None, 3, 0), (None, 0, 0), (9, 0, 0), (2, 0, 0), (3, 0, 0)], key=repr
    )
    assert relative_lz.parse(none).count() == 0
    text = " ".join(f"w{i}" for i in range(30))
    docs = [(1, text), (1, text), (None, text), (4, text), (6, "x " + text), (6, "x " + text)]
    got = relative_lz.parse(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(got.select("doc_id", "n_removed")) == sorted(
        [(1, 0), (1, 0), (None, 0), (4, 30), (6, 30), (6, 30)], key=repr
    )
