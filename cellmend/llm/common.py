"""What several operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellmend.operators.sizing import settled

__all__ = ["settled", "importable", "buckets", "map_arrow", "pack", "unpack", "by_bucket", "components", "crc_of_id"]


#: Bytes of a batch of rows on its way to a Python worker and back. Spark's own
#: bound, 64 MB, is held several times over by an executor's tasks and workers.
BATCH_BYTES = 4 << 20


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it (on a
    cluster it is installed, and the entry does nothing), and bound the bytes of
    what is sent to them at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def buckets(spark: SparkSession) -> int:
    """Parts into which keys are hashed: they follow the number of shuffle
    partitions, which whoever runs the job sets by the size of the input."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_of_id(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id written as text, by which rows are held out."""
    return F.crc32(F.col(doc_id).cast("string"))


def map_arrow(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]],
              schema: str, names: list[str] | None = None) -> DataFrame:
    """``mapInArrow`` with steps that give dictionaries of arrays; ``names`` if
    they cannot be read off a schema of plain columns."""
    names = names or [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in step(batches):
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x) for x in (out[n] for n in names)],
                names=names)
        # A worker lives on for later tasks: what they do not need goes back.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def unpack(column: pa.Array | pa.ChunkedArray, dtype) -> np.ndarray:
    """All packed arrays of a column, one behind the other."""
    parts = [np.frombuffer(x.as_buffer(), dtype) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def by_bucket(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, n + 1 limits): keys of bucket b are order[limits[b]:limits[b + 1]]."""
    bucket = (keys % np.uint64(n)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for all nodes of ``edges(a, b)`` (longs): the
    smallest node that can be reached.

    Alternates large-star and small-star steps; each is an aggregate with
    map-side combine and a join, so that no neighbourhood is gathered in one
    task, and each round's edges are cut from their lineage by a checkpoint.
    Nulls and loops are left out; an empty input gives an empty result.
    """
    edges = settled(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    while True:
        # Large star: each greater neighbour, and the node, go to the smallest neighbour.
        both = edges.select("hi", "lo").union(edges.select(F.col("lo"), F.col("hi"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")))
        # Small star: each smaller neighbour, and the node, go to the smallest one.
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi")
                 .select(F.explode(F.array(
                     F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                     F.struct(F.col("hi"), F.col("m").alias("lo")))).alias("e"))
                 .select("e.*").filter("hi <> lo").distinct())
        after = settled(small)
        # A star forest: no node is both a centre and a leaf, and each leaf has one centre.
        ends = after.select(F.explode(F.array(
            F.struct(F.col("hi").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")),
            F.struct(F.col("lo").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))).alias("e"))
        open_ends = ends.select("e.*").groupBy("node").agg(
            F.sum("leaf").alias("leaf"), F.max("centre").alias("centre")).filter("leaf > 1 OR (leaf = 1 AND centre = 1)")
        if open_ends.isEmpty():
            break
        edges = after
    return after.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        after.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()
