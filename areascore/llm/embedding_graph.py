"""Embedding near-dedup over a robust-pruned flat graph.

Vectors are dealt to the shards of their nearest centroids, several each, so shards overlap. In a
shard every vector gets a short list of neighbours by robust pruning: a candidate is left out
when a chosen neighbour is closer to it by a factor. The lists a vector got in its shards are united.
Every vector is then searched for in its shards, from the medoid on: the best nodes so far are
expanded until none of the best is left, and every node within range is expanded as well, so the search
runs through all of a group of near-duplicates however large it is. Cosines are worked out in double
precision on the vectors themselves, so no link is below the threshold. Afterwards the links found
are held against brute force for a sample of vectors, each of which counts alike; where those with few links,
or those with many, are below the wanted recall, the shards overlap more.

A pair is counted in the shard that is home to its other vector only, and a shard hands on one tie a
vector for the components, so links leave a task as counts, never as pairs.

Scale: a shard holds ``shard_rows`` vectors on average before the overlap; one that would hold many more
is split by a hash, each part with its own graph, and searched by all of its vectors. Centroids come
from a bounded sample; every vector is indexed and searched for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.llm.batches import Kept, lists, map_batches
from areascore.llm.components import connected_components

THRESHOLD = 0.9
SHARD_ROWS = 512
OVERLAP = 4
SAMPLE_ROWS = 20_000
AUDIT_ROWS, AUDIT_MOST = 512, 8_192
AUDIT_LINKED = 64  # linked vectors outside hot groups that the audit wants in its sample
AUDIT_CLASS = 32  # vectors that a class of like numbers of links needs to have a recall of its own
LEAST_RECALL = 0.95
POOL, DEGREE, ALPHA = 48, 16, 1.2
RANDOM_POOL = 8
BEAM, BLOCK = 4, 128
SLACK = 0.05  # nodes so far below the threshold are still expanded


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, unit and key of every vector that has a direction.

    Null and empty vectors, null or non-finite components and zero vectors have none.
    """
    e = F.col("embedding").cast("array<double>")
    fit = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e")).filter(
        F.col("vec_id").isNotNull() & F.col("e").isNotNull() & fit & F.exists("e", lambda x: x != 0)
    )

    def work(batch: pa.RecordBatch):
        sizes = np.diff(batch.column("e").offsets.to_numpy())
        keys, units = [], []
        for value in batch.column("e"):
            x = value.values.to_numpy()
            x = x / np.abs(x).max()
            units.append(x / np.sqrt(x @ x))
            keys.append(hashlib.blake2b(units[-1].tobytes(), digest_size=16).digest())
        yield {
            "vec_id": batch.column("vec_id"),
            "dim": sizes.astype(np.int32),
            "unit": lists(np.concatenate(units), sizes, pa.float64()),
            "key": pa.array(keys, pa.binary()),
        }

    return map_batches(usable, "vec_id long, dim int, unit array<double>, key binary", work)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def _centroids(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means over the sample."""
    generator = np.random.default_rng(5)
    centres = sample[generator.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres


def _deal(reps: DataFrame, shard_rows: int, overlap: int, keep: Kept) -> DataFrame:
    """A row for every vector and shard: its vectors are ``member`` of one part of each, and ``home`` in one."""
    centres: dict[int, np.ndarray] = {}
    for dim, n in [(r.dim, r.n) for r in reps.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n")).collect()]:
        rows = reps.filter(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS)
        sample = np.array([r.unit for r in rows.select("unit").collect()])
        centres[dim] = _centroids(sample, min(-(-n // shard_rows), max(1, len(sample) // 4)))

    def work(batch: pa.RecordBatch):
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            take = pa.array(np.flatnonzero(dims == dim))
            part = batch.take(take)
            near = _matrix(part.column("unit")) @ centres[dim].T
            count = min(overlap, near.shape[1])
            best = np.argsort(-near, axis=1, kind="stable")[:, :count]
            row = pa.array(np.repeat(np.arange(len(take)), count))
            yield {c: part.column(c).take(row) for c in ("vec_id", "dim", "unit", "weight")} | {
                "shard": best.ravel().astype(np.int32),
                "home": np.tile(np.arange(count) == 0, len(take)),
            }

    schema = "vec_id long, dim int, unit array<double>, weight long, shard int, home boolean"
    dealt = keep(map_batches(reps, schema, work), "dealt")
    parts = dealt.groupBy("dim", "shard").agg(F.count("*").alias("n"))
    parts = parts.select("dim", "shard", F.ceil(F.col("n") / (4 * shard_rows * overlap)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    spread = dealt.join(parts, ["dim", "shard"]).withColumn("own", own)
    spread = spread.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    member = F.col("part") == F.col("own")
    return keep(
        spread.select(
            "vec_id", "dim", "unit", "weight", "shard", "part", member.alias("member"),
            (F.col("home") & member).alias("home"),
        ),
        "shards",
    )


def robust_prune(x: np.ndarray, node: int, pool: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Neighbours of a node out of a pool: nearest first, none that a chosen one is closer to by ``alpha``."""
    distance = 1 - x[pool] @ x[node]
    order = np.argsort(distance, kind="stable")
    pool, distance = pool[order], distance[order]
    between = 1 - x[pool] @ x[pool].T
    alive = np.ones(len(pool), dtype=bool)
    chosen = []
    for i in range(len(pool)):
        if alive[i]:
            chosen.append(i)
            if len(chosen) == degree:
                break
            alive &= alpha * between[i] > distance
    return pool[chosen]


def build_graph(x: np.ndarray, seed: int = 0) -> tuple[list[np.ndarray], int]:
    """Neighbours of every row, both ways, all of them reachable from the medoid; and the medoid."""
    n = len(x)
    medoid = int((x @ x.mean(axis=0)).argmax())
    generator = np.random.default_rng(seed)
    out: list[set[int]] = [set() for _ in range(n)]
    for a in range(0, n, 512):
        near = x[a : a + 512] @ x.T
        count = min(POOL + 1, n)
        best = np.argpartition(-near, count - 1, axis=1)[:, :count]
        far = generator.integers(0, n, size=(len(near), RANDOM_POOL))
        for i in range(len(near)):
            pool = np.unique(np.concatenate([best[i], far[i], [medoid]]))
            for j in robust_prune(x, a + i, pool[pool != a + i]).tolist():
                out[a + i].add(j)
                out[j].add(a + i)
    reached, stack = {medoid}, [medoid]
    toward = np.argsort(-(x @ x[medoid]), kind="stable").tolist()
    for start in [medoid, *toward]:
        if start not in reached:
            out[medoid].add(start)
            out[start].add(medoid)
            reached.add(start)
            stack.append(start)
        while stack:
            for j in out[stack.pop()]:
                if j not in reached:
                    reached.add(j)
                    stack.append(j)
    return [np.array(sorted(s), dtype=np.int64) for s in out], medoid


def range_search(
    x: np.ndarray, graph: list[np.ndarray], medoid: int, queries: np.ndarray, threshold: float
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For blocks of queries: the block's first row, the nodes scored, and their cosines to each query.

    The queries of a block share what they score. A node is expanded if it is in range of a query, or
    among a query's best; the search ends when no such node is left.
    """
    n = len(x)
    for a in range(0, len(queries), BLOCK):
        q = queries[a : a + BLOCK]
        seen = np.zeros(n, dtype=bool)
        done = np.zeros(n, dtype=bool)
        nodes, scores = np.zeros(0, dtype=np.int64), np.zeros((len(q), 0))
        new = np.array([medoid])
        while len(new):
            seen[new] = True
            nodes = np.concatenate([nodes, new])
            scores = np.concatenate([scores, q @ x[new].T], axis=1)
            want = (scores >= threshold - SLACK).any(axis=0)
            beam = min(BEAM, len(nodes))
            want[np.unique(np.argpartition(-scores, beam - 1, axis=1)[:, :beam])] = True
            expand = nodes[want & ~done[nodes]]
            done[expand] = True
            around = [graph[i] for i in expand.tolist()]
            new = np.unique(np.concatenate(around)) if around else np.zeros(0, dtype=np.int64)
            new = new[~seen[new]]
        yield a, nodes, scores


def _adjacency(shards: DataFrame) -> DataFrame:
    """vec_id and the neighbours it got in one shard."""

    def work(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        graph, _ = build_graph(_matrix(table.column("unit"))[order])
        ids = ids[order]
        sizes = np.array([len(g) for g in graph])
        return pa.table(
            {"vec_id": ids, "neighbours": lists(ids[np.concatenate(graph)], sizes, pa.int64())}
        )

    members = shards.filter("member").select("dim", "shard", "part", "vec_id", "unit")
    return members.groupBy("dim", "shard", "part").applyInArrow(work, "vec_id long, neighbours array<long>")


def _search(shards: DataFrame, graph: DataFrame, threshold: float) -> DataFrame:
    """vec_id, the links to vectors at home in a shard by weight (found) and by number (pairs), and tie, the least it hangs on there."""

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        table = table.take(pa.array(np.argsort(table.column("vec_id").to_numpy(), kind="stable")))
        ids, unit = table.column("vec_id").to_numpy(), _matrix(table.column("unit"))
        member = np.flatnonzero(table.column("member").to_numpy())
        if not len(member):
            return pa.table({"vec_id": ids[:0], "found": ids[:0], "pairs": ids[:0], "tie": ids[:0]})
        x, at = unit[member], ids[member]
        home = table.column("home").to_numpy()[member]
        weight = table.column("weight").to_numpy()[member] * home
        united = table.column("neighbours").combine_chunks().take(pa.array(member))
        values, offsets = united.values.to_numpy(), united.offsets.to_numpy()
        place = np.minimum(np.searchsorted(at, values), len(at) - 1)
        present = at[place] == values
        neighbours = [
            place[a:b][present[a:b]] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
        ]
        medoid = int((x @ x.mean(axis=0)).argmax())
        # Queries that lie together share most of what they score.
        order = np.argsort(-(unit @ x[medoid]), kind="stable")
        label = (unit @ x[order_spread(len(x))].T).argmax(axis=1)
        order = order[np.argsort(label[order], kind="stable")]
        found, pairs = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
        root = np.arange(len(ids))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for a, nodes, scores in range_search(x, neighbours, medoid, unit[order], threshold):
            rows = order[a : a + len(scores)]
            inside = (scores >= threshold) & (at[nodes][None, :] != ids[rows][:, None])
            found[rows] += inside.astype(np.int64) @ weight[nodes]
            pairs[rows] += inside.astype(np.int64) @ home[nodes].astype(np.int64)
            for i in np.flatnonzero(inside.any(axis=1)).tolist():
                others = np.unique(root[member[nodes[inside[i]]]])
                for other in others.tolist():
                    one, two = top(int(rows[i])), top(other)
                    root[max(one, two)] = min(one, two)
        tie = ids[np.array([top(i) for i in range(len(ids))], dtype=np.int64)]
        use = (found > 0) | (tie != ids)
        return pa.table({"vec_id": ids[use], "found": found[use], "pairs": pairs[use], "tie": tie[use]})

    rows = shards.join(graph, "vec_id")
    return rows.groupBy("dim", "shard", "part").applyInArrow(work, "vec_id long, found long, pairs long, tie long")


def order_spread(n: int, most: int = 32) -> np.ndarray:
    """Up to ``most`` evenly spaced rows."""
    return np.unique(np.linspace(0, n - 1, min(n, most)).astype(np.int64))


def _audit(reps: DataFrame, counts: DataFrame, threshold: float, hot: int) -> float:
    """Recall of a bounded sample of vectors, held against brute force over all rows.

    Each vector with links counts alike, and copies of a vector count once. Vectors are put in classes by
    their number of links; the recall is that of the worst class, so a hot group cannot hide what pairs
    lose. The sample grows until enough vectors of it have links, but no more than ``hot``.
    """
    size = AUDIT_ROWS
    while True:
        got = _audited(reps, counts, threshold, size)
        linked = [(n, min(found / n, 1.0)) for n, found in got if n]
        if len(got) < size or size >= AUDIT_MOST or sum(n <= hot for n, _ in linked) >= AUDIT_LINKED:
            break
        size *= 4
    classes: dict[int, list[float]] = {}
    for n, share in linked:
        classes.setdefault(n.bit_length() // 2, []).append(share)
    means = [float(np.mean(c)) for c in classes.values() if len(c) >= AUDIT_CLASS]
    rest = [x for c in classes.values() if len(c) < AUDIT_CLASS for x in c]
    if rest:
        means.append(float(np.mean(rest)))
    return min(means, default=1.0)


def _audited(reps: DataFrame, counts: DataFrame, threshold: float, size: int) -> list[tuple[int, int]]:
    """Links there are and links found of each of ``size`` vectors."""
    sample = reps.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(size)
    rows = sample.select("vec_id", "dim", "unit").collect()
    asked: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r.dim for r in rows}:
        mine = [r for r in rows if r.dim == dim]
        asked[dim] = (np.array([r.vec_id for r in mine]), np.array([r.unit for r in mine]))

    def work(batch: pa.RecordBatch):
        dims, ids = (batch.column(c).to_numpy() for c in ("dim", "vec_id"))
        for dim, (vec, unit) in asked.items():
            use = np.flatnonzero(dims == dim)
            n = np.zeros(len(vec), dtype=np.int64)
            for a in range(0, len(use), 512):
                some = use[a : a + 512]
                x = _matrix(batch.column("unit").take(pa.array(some)))
                n += ((unit @ x.T >= threshold) & (vec[:, None] != ids[some][None, :])).sum(axis=1)
            yield {"vec_id": vec, "n": n}

    there = map_batches(reps.select("vec_id", "dim", "unit"), "vec_id long, n long", work)
    there = there.groupBy("vec_id").agg(F.sum("n").alias("n"))
    both = there.join(counts, "vec_id", "left").select("n", F.coalesce("pairs", F.lit(0)).alias("pairs"))
    return [(r.n, r.pairs) for r in both.collect()]


def near_dedup(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    shard_rows: int = SHARD_ROWS,
    overlap: int = OVERLAP,
    least_recall: float = LEAST_RECALL,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding).

    Vectors without a direction link with nothing, nor do vectors of different lengths with each other.
    Equal directions are folded into the smallest vec_id and weigh as many. Rows repeated under one
    vec_id are copies of each other and link; rows without a vec_id have no links.
    """
    keep = Kept(vectors.sparkSession)
    units = keep(unit_vectors(vectors), "units")
    classes = keep(units.groupBy("dim", "key").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight")), "classes")
    first = units.dropDuplicates(["vec_id", "key"]).join(classes.withColumnRenamed("first_id", "vec_id"), ["dim", "key", "vec_id"])
    reps = keep(first.select("vec_id", "dim", "unit", "weight"), "vectors")
    while True:
        shards = _deal(reps, shard_rows, overlap, keep)
        graph = _adjacency(shards).groupBy("vec_id").agg(
            F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours")
        )
        hits = keep(_search(shards, graph, threshold), "hits")
        counts = keep(hits.groupBy("vec_id").agg(F.sum("found").alias("found"), F.sum("pairs").alias("pairs")), "counts")
        widest = shards.agg(F.max("shard")).first()[0]
        if widest is None or overlap > widest or _audit(reps, counts, threshold, shard_rows) >= least_recall:
            break
        overlap *= 2
    ties = hits.select(F.col("vec_id").alias("a"), F.col("tie").alias("b"))
    components = connected_components(ties)
    named = units.select("vec_id", "dim", "key").join(classes, ["dim", "key"])
    named = named.join(counts.withColumnRenamed("vec_id", "first_id"), "first_id", "left")
    named = named.join(components.withColumnRenamed("id", "first_id"), "first_id", "left")
    found = named.groupBy("vec_id").agg(
        F.max(F.coalesce("found", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.min(F.coalesce("component", "first_id")).alias("component_id"),
    )
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    out = ids.join(found, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
