import random
from collections import defaultdict

import pytest
from cases import corpus, documents_frame, none, odd  # noqa: F401
from conftest import rows

from areascore.llm import packing
from areascore.scratch import release


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    release(spark)


@pytest.mark.parametrize("group_rows", [20, 4096])
def test_bins_hold_everything_once_without_conflicts(documents_frame, corpus, group_rows):
    import brute

    packed = packing.best_fit_packing(documents_frame, 64, group_rows).collect()
    bins, parts = defaultdict(list), defaultdict(list)
    for row in packed:
        bins[row.bin_id].append(row)
        parts[row.doc_id].append((row.first_word, row.n_words))
    words = {d: brute.words(t) for d, t in corpus}
    for doc_id, w in words.items():
        at = 0
        for first, n in sorted(parts.get(doc_id, [])):
            assert first == at and n > 0
            at += n
        assert at == len(w)
    for members in bins.values():
        at = 0
        for row in sorted(members, key=lambda r: r.bin_offset):
            assert row.bin_offset == at
            at += row.n_words
        assert at <= 64
        assert len({r.source for r in members}) == len(members)
        texts = [brute.lowered(" ".join(words[r.doc_id])) for r in members]
        assert len(set(texts)) == len(members)


def test_tightest_compatible_bin():
    random_ = random.Random(4)
    bins, plain = packing.Bins(50), []  # plain: [rest, sources, clusters]
    for _ in range(600):
        size, source, cluster = random_.randint(1, 49), 1 << random_.randint(0, 5), random_.choice([0, 0, 1, 2, 4])
        fits = [(b[0], i) for i, b in enumerate(plain) if b[0] >= size and not b[1] & source and not b[2] & cluster]
        expected = min(fits)[1] if fits else len(plain)
        if not fits:
            plain.append([50, 0, 0])
        got, before = bins.put(size, source, cluster)
        assert got == expected and before == 50 - plain[got][0]
        plain[got] = [plain[got][0] - size, plain[got][1] | source, plain[got][2] | cluster]


def test_packing_of_odd_rows(spark, odd, none):
    got = rows(packing.best_fit_packing(odd, 2).select("doc_id", "part", "n_words"))
    assert got == sorted([(d, p, 2 - p) for d in (5, 5, None) for p in (0, 1)], key=repr)
    assert packing.best_fit_packing(none).count() == 0
    twice = spark.createDataFrame([(1, "a b", None), (1, "a b", None), (2, "c d", None)], "doc_id long, text string, source string")
    bins = packing.best_fit_packing(twice, 10).select("bin_id", "doc_id").collect()
    assert len({r.bin_id for r in bins if r.doc_id == 1}) == 2


def test_repeated_rows_are_dealt_over_groups(spark):
    """Rows that are equal, with and without ids, spread like others; each is packed once."""
    docs = spark.range(9_000).selectExpr("IF(id % 3 = 0, 1, IF(id % 3 = 1, NULL, id)) AS doc_id", "'a b c' AS text", "NULL AS source")
    packed = packing.best_fit_packing(docs, 10, 500).collect()
    assert len(packed) == 9_000
    assert len({r.bin_id for r in packed}) == 9_000  # copies of one cluster never share a bin
    sizes = defaultdict(int)
    for r in packed:
        sizes[r.bin_id.split("-")[0]] += 1
    assert len(sizes) == 19 and max(sizes.values()) < 700


def test_names_of_bins_do_not_depend_on_partitions(spark):
    docs = [(i % 7, " ".join(["w"] * (i % 5 * 10)), f"s{i % 3}" if i % 4 else None) for i in range(60)]
    docs += [(None, "x " * 20, None)] * 3 + [(8, "A " * 20, "s"), (8, "a " * 20, "s"), (8, "a " * 20, "t")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    one, other = (rows(packing.best_fit_packing(frame.repartition(n), 10, 8)) for n in (1, 5))
    assert one == other
    full = [r[0] for r in one if r[5] == 10]
    assert len(full) == len(set(full))
