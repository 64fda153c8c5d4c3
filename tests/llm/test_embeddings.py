import brute
import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from areascore.llm import embedding_graph as eg
from areascore.scratch import release

SCHEMA = "vec_id long, embedding array<float>, label int, weight string"


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    release(spark)


def expected(vectors):
    """vec_id -> (n_links, component_id, kept) by brute force."""
    fit = {}
    for i, v in vectors:
        x = np.array([np.nan if c is None else c for c in v], dtype=np.float64) if v else np.zeros(0)
        if len(x) and np.isfinite(x).all() and np.abs(x).max() > 0:
            fit[i] = np.float32(x).astype(np.float64)
    unit = {i: x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) for i, x in fit.items()}
    links = [(i, j) for i in unit for j in unit if i < j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9]
    found = brute.components([i for i, _ in vectors], links)
    return {i: (sum(i in pair for pair in links), found[i], found[i] == i) for i, _ in vectors}


def clustered(n, groups, dim, noise, seed=0):
    generator = np.random.default_rng(seed)
    centres = generator.normal(size=(groups, dim))
    return centres[generator.integers(0, groups, n)] + noise * generator.normal(size=(n, dim))


@pytest.mark.parametrize("shard_rows,overlap", [(40, 3), (512, 4)])
def test_links_and_components(spark, shard_rows, overlap):
    x = np.concatenate([clustered(300, 12, 16, 0.12), clustered(200, 200, 16, 0.0, 1)])
    vectors = [(3 * i, v.tolist()) for i, v in enumerate(x)]
    vectors += [(5001, vectors[0][1]), (5002, vectors[0][1]), (5003, [2 * c for c in vectors[0][1]])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in vectors], SCHEMA).repartition(3)
    got = {r[0]: tuple(r[1:]) for r in eg.near_dedup(df, shard_rows=shard_rows, overlap=overlap, least_recall=1.0).collect()}
    want = expected(vectors)
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in want)  # never a link too many
    assert sum(g[0] for g in got.values()) >= 0.99 * sum(w[0] for w in want.values())


def test_pairs_beside_a_hot_group_are_audited(spark):
    generator = np.random.default_rng(4)
    hot = clustered(500, 1, 16, 0.02, 5)
    one = generator.normal(size=(250, 16))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    aside = generator.normal(size=(250, 16))
    aside -= (aside * one).sum(axis=1, keepdims=True) * one
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    two = 0.905 * one + (1 - 0.905**2) ** 0.5 * aside
    x = np.concatenate([hot, one, two])
    df = spark.createDataFrame([(i, v.tolist(), 0, "x") for i, v in enumerate(x)], SCHEMA)
    got = {r[0]: r[1] for r in eg.near_dedup(df, shard_rows=10, overlap=1).collect()}
    want = expected(list(enumerate(x.tolist())))
    lonely = [i for i in want if i >= 500 and want[i][0]]
    assert all(got[i] <= want[i][0] for i in want) and len(lonely) > 400
    assert np.mean([got[i] / want[i][0] for i in lonely]) >= 0.93


def test_a_hot_group_does_not_hide_lost_pairs_from_the_audit(spark):
    x = np.concatenate([clustered(200, 1, 64, 0.02, 5), np.repeat(np.random.default_rng(6).normal(size=(100, 64)), 2, axis=0)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    reps = spark.createDataFrame([(i, 64, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, dim int, unit array<double>, weight long")
    counts = spark.createDataFrame([(i, 199, 199) for i in range(200)], "vec_id long, found long, pairs long")
    assert eg._audit(reps, counts, 0.9, 100) == 0.0  # every pair is lost


def test_one_large_group_is_counted_whole(spark):
    x = clustered(600, 1, 16, 0.02)
    df = spark.createDataFrame([(i, v.tolist(), 0, "x") for i, v in enumerate(x)], SCHEMA)
    got = eg.near_dedup(df, shard_rows=20, overlap=2)
    assert rows(got.select("n_links", "component_id").distinct()) == [(599, 0)]
    assert got.filter("kept").count() == 1


def test_odd_vectors(spark):
    e = [1.0, 0.0, 0.0]
    vectors = [
        (1, e), (2, None), (3, []), (4, [0.0, 0.0, 0.0]), (5, [None, 1.0, 0.0]), (6, [float("nan"), 0.0, 0.0]),
        (7, [float("inf"), 0.0, 0.0]), (8, [1.0, 0.1, 0.0]), (9, [1.0, 0.0]), (10, e),
    ]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in vectors], SCHEMA)
    got = {r[0]: tuple(r[1:]) for r in eg.near_dedup(df).collect()}
    assert got == expected(vectors)
    assert eg.near_dedup(df.limit(0)).count() == 0
    twice = eg.near_dedup(df.filter("vec_id = 1").unionAll(df.filter("vec_id in (1, 2)")).withColumn(
        "vec_id", F.when(F.col("vec_id") == 1, 1).cast("long")
    ))
    assert rows(twice) == sorted([(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True)], key=repr)


def test_pruned_neighbours_are_spread_and_reachable():
    x = clustered(400, 8, 12, 0.2, 3)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = eg.robust_prune(x, 0, np.arange(1, 400))
    distance = 1 - x @ x[0]
    assert near[0] == np.argmin(np.where(np.arange(400) == 0, 9, distance))
    for i, b in enumerate(near):
        assert all(eg.ALPHA * (1 - x[a] @ x[b]) > distance[b] for a in near[:i])
    graph, medoid = eg.build_graph(x)
    seen, stack = {medoid}, [medoid]
    while stack:
        for j in graph[stack.pop()].tolist():
            if j not in seen:
                seen.add(j)
                stack.append(j)
    assert len(seen) == 400
