"""Running totals over a whole ordered table without a one-task window."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local-mode session without the setting gets a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def running_total(
    df: DataFrame, order_by: list[Column], amount: Column, name: str = "running_total"
) -> DataFrame:
    """Add the inclusive running sum of ``amount`` in ``order_by`` order.

    ``order_by`` has to be a total order. Rows are range-partitioned and summed
    within a partition, and the partition totals (one row each) give the
    offsets. The ranged rows are checkpointed because both branches have to see
    the same range boundaries; since Spark does not know how checkpointed rows
    are partitioned, the sum shuffles them once more, by partition.
    """
    spark = df.sparkSession
    shared_dir(spark)
    ranged = (
        df.repartitionByRange(*order_by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_amount", amount)
        .checkpoint()
    )
    per_part = ranged.groupBy("_part").agg(F.sum("_amount").alias("_sum"))
    # One row per partition: bounded by the partition count, not by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.withColumn("_inner", F.sum("_amount").over(inside))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_inner") + F.col("_offset"))
        .drop("_part", "_amount", "_inner", "_offset")
    )
