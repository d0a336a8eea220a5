"""Broadcasts behind a check of their size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cellmend.functions.normalize import quoted
from cellmend.operators.ordering import scratch_path, shared_dir

# What every executor can hold beside its work: about a million file paths with
# what is known of each file.
MAX_BROADCAST_BYTES = 128 << 20


def settled(df: DataFrame) -> DataFrame:
    """A small derived table, computed once and kept in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def settled_by_column(df: DataFrame) -> DataFrame:
    """A derived table of any size, computed once and kept in the shared folder
    by column: what reads it later reads the columns it needs."""
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bytes(field: T.StructField) -> Column:
    """About what a value takes in a row."""
    col = F.col(quoted(field.name))
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return 8 + F.coalesce(F.octet_length(col), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return 16 + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
    return F.lit(8)


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the measured size allows it; beyond that the join
    is left to Spark, which shuffles and splits skewed keys."""
    row = reduce(lambda a, b: a + b, [_bytes(f) for f in df.schema.fields], F.lit(8))
    size = df.agg(F.sum(row.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df
