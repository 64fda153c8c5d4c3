"""Parallelism of inputs that arrive in too few pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Bytes of a piece that needs no help: a cluster with more cores than such pieces is better left idle in
# part than a large table moved.
NORMAL_PIECE = (32 << 20, 256 << 20)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out evenly when the input has fewer pieces than the cluster has cores, of an odd size.

    A CSV with line breaks inside quotes, or a parquet file with one row group, is read
    by one task; a small file as well. Work that is heavy per row should not stay there. Inputs with enough
    pieces, or with pieces of a normal size, are returned as they are, without a shuffle.

    For frames made of scans and narrow steps: counting the pieces of any other frame would run
    its shuffles.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = df.rdd.getNumPartitions()
    if pieces >= cores:
        return df
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if NORMAL_PIECE[0] <= size / max(pieces, 1) <= NORMAL_PIECE[1]:
        return df
    return df.repartition(cores)
