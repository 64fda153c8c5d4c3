"""MinHash near-dedup: universal hash minima, bands, verification, components.

A document's set holds its distinct five-word shingles. Documents with equal sets are folded into
the smallest doc_id first. The minima of many universal hashes form the signature; documents that
agree in all minima of a band share a bucket and are candidates. Candidates whose signatures
agree well enough are compared on their full sets, and the links found so are closed by
large-star and small-star.

Buckets, however large, are never expanded into all pairs. Small ones are; in a large one the smallest
members are compared with the rest. Buckets that still hold several components then get an exact
similarity join over their documents by the rarest shingles, which pairs only what can be similar
enough: by lengths, by the places of a shared shingle and by parities of the sets. Members that share a frequent
shingle, and the pairs of a hub, meet in blocks of ``BLOCK``. Before all that, documents leave the buckets in which they cannot have a link: shingles that no
other candidate has bound their similarity with every other. So no pair is skipped for the size of its
bucket.

There are as many bands of 5 minima as it takes for a pair at the threshold to share no bucket once in two
million times: 25 at 0.85, 37 at 0.80. Signatures rule out a thousand times fewer pairs at the threshold than the bands miss,
and none of the pairs that the exact join finds.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areascore.llm.batches import Kept, lists, map_batches, slices, texts
from areascore.llm.components import connected_components
from areascore.llm.words import LOWER, Words, windows

WIDTH = 5
ROWS = 5
MISSED = 4.4e-7  # share of the pairs at the threshold that share no bucket
PERCENT = 85
SMALL_BUCKET = 32
HUBS = 4
BLOCK = 512  # pairs of one document, and members that share a shingle, that are met together
CELLS = 1 << 18  # counters that put shingles in order, rarest first
PARITIES = 8  # 64-bit words of a set's parity
RULED_OUT = MISSED / 1000  # share of the pairs at the threshold that their signatures may rule out


def n_bands(percent: int) -> int:
    """Bands after which at most ``MISSED`` of the pairs at the threshold share no bucket."""
    share = min(percent, 99) / 100
    return math.ceil(math.log(MISSED) / math.log1p(-(share**ROWS)))


def least_agreement(percent: int) -> int:
    """Minima that two signatures agree in at least, but for ``RULED_OUT`` of the pairs at the threshold."""
    share, n = percent / 100, n_bands(percent) * ROWS
    below = 0.0
    for k in range(n + 1):
        below += math.comb(n, k) * share**k * (1 - share) ** (n - k)
        if below > RULED_OUT:
            return k
    return n


def _hashes(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts of ``n`` multiply-shift hashes."""
    random = np.random.Generator(np.random.PCG64(77))
    factors = random.integers(0, 1 << 63, size=(n, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, random.integers(0, 1 << 63, size=(n, 1), dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each row; fewer words than ``width`` form one shingle."""
    words = Words(data, offsets)
    hashes = words.hashes(LOWER)
    every = windows(hashes, width)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(every[a : b - width + 1])
        elif b > a:
            yield windows(hashes[a:b], b - a, salt=b - a)
        else:
            yield hashes[:0]


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Minima of multiply-shift hashes, as 32-bit integers."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 256):
        np.minimum(least, (shingles[at : at + 256] * factors + shifts).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sketches(docs: DataFrame, n_minima: int) -> DataFrame:
    factors, shifts = _hashes(n_minima)

    def work(batch: pa.RecordBatch):
        for part, data, offsets in slices(batch):
            sizes, digests, signatures = [], [], []
            for s in shingle_sets(data, offsets):
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                signatures.append(signature(s, factors, shifts))
            yield {
                "doc_id": part.column("doc_id"),
                "n_shingles": np.array(sizes, dtype=np.int64),
                "digest": pa.array(digests, pa.binary()),
                "minima": lists(np.concatenate(signatures), np.full(len(sizes), n_minima), pa.int32()),
            }

    return map_batches(texts(docs), "doc_id long, n_shingles long, digest binary, minima array<int>", work)


def _full_sets(docs: DataFrame, n_minima: int) -> DataFrame:
    factors, shifts = _hashes(n_minima)

    def work(batch: pa.RecordBatch):
        for part, data, offsets in slices(batch):
            sets = list(shingle_sets(data, offsets))
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            minima = np.concatenate([signature(s, factors, shifts) for s in sets])
            yield {
                "id": part.column("doc_id"),
                "n": sizes,
                "shingles": lists(np.concatenate(sets).view(np.int64), sizes, pa.int64()),
                "minima": lists(minima, np.full(len(sizes), n_minima), pa.int32()),
            }

    return map_batches(docs, "id long, n long, shingles array<long>, minima array<int>", work)


def _with_sets(pairs: DataFrame, sets: DataFrame, name: str, keep: Kept) -> DataFrame:
    """``pairs`` with the set and the signature of the document in column ``name``.

    The pairs of a document that stands in very many are dealt over blocks, each with a copy of its set.
    """
    side = sets.select(
        F.col("id").alias(name), F.col("shingles").alias(f"{name}_set"), F.col("minima").alias(f"{name}_minima")
    )
    blocks = pairs.groupBy(name).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = keep(blocks.filter("blocks > 1"), "blocks")
    count = F.coalesce("blocks", F.lit(1))
    other = "b" if name == "a" else "a"
    dealt = pairs.join(blocks, name, "left").withColumn("block", F.pmod(F.xxhash64(other), count).cast("int"))
    copies = side.join(blocks, name, "left").withColumn("block", F.explode(F.sequence(F.lit(0), count - 1)))
    return dealt.drop("blocks").join(copies.drop("blocks"), [name, "block"]).drop("block")


def _confirm(pairs: DataFrame, sets: DataFrame, keep: Kept, percent: int, least: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough, of those whose signatures agree in ``least`` minima."""
    n_minima = n_bands(percent) * ROWS
    pairs = keep(pairs, "pairs")

    def work(batch: pa.RecordBatch):
        def column(name: str) -> tuple[np.ndarray, np.ndarray]:
            c = batch.column(name)
            return c.values.to_numpy(), c.offsets.to_numpy()

        (a, at_a), (b, at_b) = column("a_set"), column("b_set")
        x, y = (batch.column(c).flatten().to_numpy().reshape(-1, n_minima) for c in ("a_minima", "b_minima"))
        likely = (x == y).sum(axis=1) >= least
        linked = np.zeros(batch.num_rows, dtype=bool)
        for row in np.flatnonzero(likely).tolist():
            s, t = a[at_a[row] : at_a[row + 1]], b[at_b[row] : at_b[row + 1]]
            both = len(np.intersect1d(s, t, assume_unique=True))
            linked[row] = 100 * both >= percent * (len(s) + len(t) - both)
        keep = pa.array(np.flatnonzero(linked))
        yield {"a": batch.column("a").take(keep), "b": batch.column("b").take(keep)}

    met = _with_sets(_with_sets(pairs, sets, "a", keep), sets, "b", keep)
    return map_batches(met.select("a", "b", "a_set", "b_set", "a_minima", "b_minima"), "a long, b long", work)


def _feasible(n_a: Column, m_a: Column, n_b: Column, m_b: Column, percent: int) -> Column:
    """Whether two sets can be similar enough, of n shingles each, m of them also in other sets."""
    return F.least(m_a, m_b) * (100 + percent) >= percent * (n_a + n_b)


def _candidates(bands: DataFrame, sets: DataFrame, keep: Kept, percent: int) -> DataFrame:
    """key, id, n and m of members of buckets that can have a link there, and the bucket's size."""
    seen = sets.select("id", F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("k"), F.min("id").alias("id"))
    alone = seen.filter("k = 1").groupBy("id").agg(F.count("*").alias("u"))
    sizes = sets.select("id", "n").distinct().join(alone, "id", "left")
    sizes = keep(sizes.select("id", "n", (F.col("n") - F.coalesce("u", F.lit(0))).alias("m")), "sizes")
    members = keep(bands.join(sizes, "id"), "members")
    least = keep(members.groupBy("key").agg(F.min("n").alias("least_n")), "buckets")
    able = members.join(least, "key").filter(F.col("m") * (100 + percent) >= percent * (F.col("n") + F.col("least_n")))
    able = keep(able.select("key", "id", "n", "m"), "members")
    size = keep(able.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    return keep(able.join(size, "key"), "members")


def _pairs(hubs: DataFrame, members: DataFrame, percent: int, *also: Column) -> DataFrame:
    """Distinct pairs (a, b) of a hub and a member of its bucket that can be similar enough."""
    names = ("n", "m")
    left = hubs.select("key", F.col("id").alias("x"), *[F.col(c).alias(f"x_{c}") for c in names])
    right = members.select("key", F.col("id").alias("y"), *[F.col(c).alias(f"y_{c}") for c in names])
    met = left.join(right, "key").filter(_feasible(*[F.col(c) for c in ("x_n", "x_m", "y_n", "y_m")], percent))
    for condition in also:
        met = met.filter(condition)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and where each row starts in them."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cell_counts(sets: DataFrame) -> np.ndarray:
    """How many shingles of ``sets`` fall into each of ``CELLS`` cells, at least 1.

    The counts come to the driver and go to the tasks: at most ``CELLS`` numbers, whatever the sets.
    """

    def work(batch: pa.RecordBatch):
        values, _ = _flat(batch.column("shingles"))
        counts = np.bincount(values & (CELLS - 1), minlength=CELLS)
        cells = np.flatnonzero(counts)
        yield {"cell": cells.astype(np.int32), "k": counts[cells].astype(np.int64)}

    found = map_batches(sets.select("shingles"), "cell int, k long", work).groupBy("cell").agg(F.sum("k").alias("k"))
    found = found.toArrow()
    out = np.ones(CELLS, dtype=np.int64)
    out[found.column("cell").to_numpy()] = found.column("k").to_numpy()
    return out


def parity(shingles: np.ndarray) -> np.ndarray:
    """For each of 64 * ``PARITIES`` cells, whether an odd number of the shingles falls in it, packed into 64-bit words.

    Parities of two sets differ in no more bits than there are shingles in one set alone.
    """
    cells = (shingles.view(np.uint64) >> np.uint64(40)).astype(np.int64) % (64 * PARITIES)
    odd = (np.bincount(cells, minlength=64 * PARITIES) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """s, id, component, n, at and parities p0… of the rarest shingles of ``sets``, as many as must hold a shared one.

    The order is that of (count of the shingle's cell, shingle). Any order gives the same links; this one leaves
    frequent shingles out of the prefixes.
    """
    counts = _cell_counts(sets)

    def work(batch: pa.RecordBatch):
        values, offsets = _flat(batch.column("shingles"))
        n = np.diff(offsets).astype(np.int64)
        row = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((values, counts[values & (CELLS - 1)], row))
        at = np.arange(len(values)) - offsets[row]
        order, at, row = (x[at <= (n * (100 - percent) // 100)[row]] for x in (order, at, row))
        bits = np.array([parity(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
        out = {"s": values[order], "n": n[row], "at": at.astype(np.int64)}
        out |= {c: batch.column(c).take(pa.array(row)) for c in ("id", "component")}
        yield out | {f"p{i}": bits[row, i] for i in range(PARITIES)}

    schema = "s long, id long, component long, n long, at long, " + ", ".join(f"p{i} long" for i in range(PARITIES))
    return map_batches(sets.select("id", "component", "shingles"), schema, work)


def _prefix_pairs(rest: DataFrame, sets: DataFrame, keep: Kept, percent: int) -> DataFrame:
    """Pairs (a, b) of ``rest`` (id, component) in different components that can be similar enough.

    Shingles are put in one order, rarest first. Two sets similar enough share a shingle among the first
    few of both, after the first one they share there must be enough left in both, and their parities differ
    in few bits; nothing else is paired. A shingle within one component pairs nothing. Members of a frequent one
    meet block by block.
    """
    left = keep(sets.join(rest, "id").select("id", "component", "shingles"), "sets")
    prefix = keep(_prefixes(left, percent), "prefixes")
    spans = prefix.groupBy("s").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    prefix = prefix.join(spans.filter("lo < hi").select("s", "blocks"), "s")
    prefix = keep(prefix.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")), "prefixes")
    names = ("id", "component", "n", "at", *[f"p{i}" for i in range(PARITIES)])

    def side(p: str, mine: str, other: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias(other)
        return prefix.select("s", F.col("block").alias(mine), every, *[F.col(c).alias(f"{p}_{c}") for c in names])

    n = F.col("x_n") + F.col("y_n")
    rest_of = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    differ = sum((F.bit_count(F.col(f"x_p{i}").bitwiseXOR(F.col(f"y_p{i}"))) for i in range(PARITIES)), F.lit(0))
    met = side("x", "i", "j").join(side("y", "j", "i"), ["s", "i", "j"])
    met = met.filter((F.col("x_id") < F.col("y_id")) & (F.col("x_component") != F.col("y_component")))
    met = met.filter((rest_of * (100 + percent) >= percent * n) & (differ * (100 + percent) <= (100 - percent) * n))
    return met.select(F.col("x_id").alias("a"), F.col("y_id").alias("b")).distinct()


def _links(members: DataFrame, sets: DataFrame, keep: Kept, percent: int) -> DataFrame:
    """id and component of all documents with a link."""
    small = members.filter(F.col("size") <= SMALL_BUCKET)
    large = members.filter(F.col("size") > SMALL_BUCKET)
    place = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    hubs = keep(large.withColumn("place", place).filter(F.col("place") <= HUBS).drop("place"), "hubs")
    pairs = _pairs(small, small, percent, F.col("x") < F.col("y"))
    pairs = pairs.unionAll(_pairs(hubs, large, percent, F.col("x") < F.col("y"))).distinct()
    links = keep(_confirm(pairs, sets, keep, percent, least_agreement(percent)), "links")
    found = keep(connected_components(links), "components")
    if hubs.isEmpty():
        return found
    placed = large.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = keep(placed.select("key", "id", "component"), "members")
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    rest = placed.join(mixed.filter("x < y").select("key"), "key", "left_semi").select("id", "component").distinct()
    # These pairs are exact: signatures have no say.
    more = _prefix_pairs(keep(rest, "rest"), sets, keep, percent)
    more = keep(_confirm(more, sets, keep, percent, 0), "links")
    # Components so far count as stars, so only what is new has to be closed.
    stars = found.filter("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
    return connected_components(stars.unionAll(more)) if not more.isEmpty() else found


def near_dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Words are compared with A-Z lowered. Null texts and texts without words have no shingles and link
    with nothing. The smallest doc_id of a component is the one that is kept. Rows repeated under one
    doc_id share its component and are all kept or not; rows without a doc_id have no component
    of their own and are not kept unless nothing else equals them.
    """
    keep = Kept(docs.sparkSession)
    source = texts(docs)
    n = n_bands(percent)
    sketches = keep(_sketches(source, n * ROWS), "sketches")
    full = sketches.filter("n_shingles > 0")
    classes = keep(full.groupBy("digest").agg(F.min("doc_id").alias("id")), "classes")
    first = full.join(classes.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    band = [F.xxhash64(F.lit(b), *[F.col("minima")[b * ROWS + r] for r in range(ROWS)]) for b in range(n)]
    bands = first.select(F.col("doc_id").alias("id"), F.explode(F.array(*band)).alias("key")).distinct()
    bands = keep(bands, "bands")
    shared = keep(bands.groupBy("key").agg(F.count("*").alias("k")).filter("k > 1").select("key"), "buckets")
    bands = keep(bands.join(shared, "key"), "bands")
    wanted = bands.select(F.col("id").alias("doc_id")).distinct()
    sets = keep(_full_sets(source.join(wanted, "doc_id", "left_semi"), n * ROWS).dropDuplicates(["id"]), "sets")
    found = _links(_candidates(bands, sets, keep, percent), sets, keep, percent)
    named = sketches.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    named = named.withColumn("id", F.when(F.col("n_shingles") > 0, F.col("id")).otherwise(F.col("doc_id")))
    out = named.join(found, "id", "left").withColumn("component_id", F.coalesce("component", "id"))
    return out.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
