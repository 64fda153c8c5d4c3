"""Arrow batches in and out of the operators, and tables kept between their steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areascore.llm.words import row_slices, text_bytes
from areascore.scratch import remove_path, scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as long, text as string and no other column but those asked for."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more
    )


def unused(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch of bounded bytes, with their UTF-8 bytes and row offsets."""
    data, offsets = text_bytes(batch.column(text))
    for a, b in row_slices(offsets):
        yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column of consecutive runs of ``values``."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def let_workers_import(spark: SparkSession) -> None:
    """Workers on this machine find the package where the driver did; on a cluster it is shipped as usual."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [environment.get("PYTHONPATH", ""), root]))


def map_batches(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], Iterator[dict]]) -> DataFrame:
    """``work`` turns a batch into dicts of equally long columns, each an Arrow batch of the result."""
    names = [field.split()[0] for field in schema.split(", ")]
    let_workers_import(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for out in work(batch):
                    yield pa.RecordBatch.from_arrays(
                        [x if isinstance(x, pa.Array) else pa.array(x) for x in (out[n] for n in names)], names
                    )

    return df.mapInArrow(run, schema)


class Kept:
    """Tables written to the shared folder by one call of an operator."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for frame in frames:
            for path in [p for p in self.paths if any(p.rsplit("/", 1)[-1] in f for f in frame.inputFiles())]:
                self.paths.remove(path)
                remove_path(self.spark, path)
