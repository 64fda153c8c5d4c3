"""Exact global ranks without sorting a whole metric in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areascore.scratch import materialize, materialize_sized

PIECE_BYTES = 32 << 20


def global_rank(
    df: DataFrame,
    group: str,
    order: Sequence[Column],
    rank: str = "rn",
    total: str = "n",
    pieces: int | None = None,
) -> DataFrame:
    """Adds the 1-based position of each row within its group, and the size of the group.

    A window over the group would sort all its rows in one task. Here the rows are range
    partitioned by (group, order), which cuts a large group, or a value shared by very many rows,
    into pieces; each piece is ranked alone and shifted by the number of rows in the pieces
    before it. ``order`` must be unique within a group for the result to be deterministic.

    ``df`` is written once, which also gives its size and so the number of pieces, one for each
    ``PIECE_BYTES``. The range partitioned rows are written as well: their bounds come from a
    sample, and the ranks and the counts must see the same pieces.
    """
    df, size = materialize_sized(df, "to-rank")
    if pieces is None:
        pieces = size // PIECE_BYTES + 1
    cut = df.repartitionByRange(pieces, F.col(group), *order)
    cut = materialize(cut.withColumn("_piece", F.spark_partition_id()), "ranked")
    # One row per group and piece: bounded by groups + pieces, since a piece that holds
    # several groups holds all of a group but at its two ends.
    counts = cut.groupBy(group, "_piece").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_piece")
    offsets = counts.select(
        group,
        "_piece",
        (F.sum("_rows").over(before) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(group)).alias(total),
    )
    local = Window.partitionBy(group, "_piece").orderBy(*order)
    ranked = cut.withColumn("_local", F.row_number().over(local))
    return (
        ranked.join(offsets, [group, "_piece"])
        .withColumn(rank, F.col("_local") + F.col("_before"))
        .select(*df.columns, rank, total)
    )


def ntile_of(rank: Column, total: Column, k: int) -> Column:
    """The ``ntile(k)`` bucket of a row from its rank and the size of its group.

    The first ``total mod k`` buckets hold one row more than the others.
    """
    base = F.floor(total / F.lit(k))
    extra = total % F.lit(k)
    split = extra * (base + 1)
    early = F.floor((rank - 1) / (base + 1)) + 1
    late = extra + F.floor((rank - 1 - split) / F.nullif(base, F.lit(0))) + 1
    return F.when(rank <= split, early).otherwise(late).cast("int")


def top_bottom(
    long: DataFrame, directions: DataFrame, keys: Sequence[str], n: int = 10
) -> DataFrame:
    """``(metric, kind, rank, keys…, value)``: best and worst ``n`` rows per metric.

    ``long`` is ``(metric, keys…, value)``; ``directions`` gives ``higher_is_better`` per metric,
    one row each. The rank filter is applied before the shuffle too, so each task
    passes on at most ``n`` rows per metric and kind.
    """
    signed = long.join(F.broadcast(directions), "metric").withColumn(
        "_goodness", F.when(F.col("higher_is_better"), F.col("value")).otherwise(-F.col("value"))
    )
    sides = []
    for kind, first in (("top", F.desc("_goodness")), ("bottom", F.asc("_goodness"))):
        window = Window.partitionBy("metric").orderBy(first, *[F.asc(key) for key in keys])
        sides.append(
            signed.withColumn("rank", F.row_number().over(window))
            .filter(F.col("rank") <= n)
            .withColumn("kind", F.lit(kind))
        )
    return sides[0].unionByName(sides[1]).select("metric", "kind", "rank", *keys, "value")
