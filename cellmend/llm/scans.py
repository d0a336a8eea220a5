"""Running values within keys of any size.

A key may hold a third of all rows, so its rows are not brought into one task:
rows are ranged by key and order, each range is scanned on its own, and what a
range inherits from the ones before it is one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellmend.llm.common import settled

#: Column with the range of a row; kept by ``ranged`` and read by ``scanned``.
RANGE = "_range"

_COMBINE = {"sum": F.sum, "xor": F.bit_xor}


def ranged(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The rows dealt to ranges of (key, order), settled, with their range.

    Rows that are equal in key and order may lie in any of their places."""
    return settled(df.repartitionByRange(F.col(key), *order).withColumn(RANGE, F.spark_partition_id()))


def scanned(df: DataFrame, key: str, order: list[Column],
            values: dict[str, tuple[Column, str]]) -> DataFrame:
    """Add inclusive running values of each key's rows in ``order``.

    ``df`` is (a part of) what ``ranged`` gave, with keys that are not null and
    an order that the ranges follow; ``values`` names long columns and how they
    combine, "sum" or "xor".
    """
    kinds = {name: _COMBINE[kind] for name, (_, kind) in values.items()}
    rows = df.withColumns({f"_of_{name}": value.cast("long") for name, (value, _) in values.items()})
    # One row per range: its first and last key, and what the last key holds in it.
    per_key = rows.groupBy(RANGE, key).agg(*[kinds[n](f"_of_{n}").alias(n) for n in kinds])
    ends = per_key.groupBy(RANGE).agg(
        F.min(key).alias("first"), F.max(key).alias("last"),
        F.max_by(F.struct(*kinds), key).alias("held"))
    along = Window.orderBy(RANGE)
    starts = ends.withColumn(
        "starts", F.coalesce((F.col("first") != F.col("last"))
                             | (F.lag("last").over(along) != F.col("first")), F.lit(True)).cast("int"))
    chain = starts.withColumn("chain", F.sum("starts").over(along))
    within = Window.partitionBy("chain").orderBy(RANGE)
    held = chain.select(RANGE, "first", "last", *[
        kinds[n](f"held.{n}").over(within).alias(f"_held_{n}") for n in kinds])
    inherited = held.select(
        RANGE, F.col("first").alias(key), F.lag("last").over(along).alias("_before"),
        *[F.lag(f"_held_{n}").over(along).alias(f"_base_{n}") for n in kinds]
    ).filter(F.col(key) == F.col("_before")).drop("_before")
    # As many rows as ranges at most, whatever the size of the input.
    inside = Window.partitionBy(RANGE, key).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumns({n: kinds[n](f"_of_{n}").over(inside) for n in kinds}).join(
        F.broadcast(inherited), [RANGE, key], "left")
    plus = {"sum": lambda a, b: a + b, "xor": lambda a, b: a.bitwiseXOR(b)}
    out = out.withColumns({
        n: plus[kind](F.col(n), F.coalesce(f"_base_{n}", F.lit(0).cast("long")))
        for n, (_, kind) in values.items()})
    return out.drop(*[f"_of_{n}" for n in kinds], *[f"_base_{n}" for n in kinds])
