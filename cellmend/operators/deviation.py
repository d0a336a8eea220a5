"""Deviation strategies over batches, patterns and neighbouring columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellmend.functions.classify import is_nullish, matches_pattern
from cellmend.functions.normalize import quoted
from cellmend.operators.cells import KEY_FIELDS, type_counts, value_counts, with_cell_type
from cellmend.operators.metrics import entropy_bits, n_log_n, pct


def _column_names(columns: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("col_idx") + 1)


def type_ratio_drift(df: DataFrame, batch: str, columns: list[str]) -> DataFrame:
    """Drift of each column's type mix against all earlier batches.

    z compares a type's share in the batch with mean and sample deviation of
    its shares in the batches before; beyond 2 it is flagged. The window runs
    over (column, type, batch) shares, not over rows.
    """
    counts = type_counts(df, [batch], columns)
    shares = counts.groupBy(batch, "col_idx").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col("cell_type") == t, F.col("n")).otherwise(0)).alias(t)
          for t in ("null", "int", "float", "string")],
    ).select(batch, "col_idx", F.inline(F.array(*[
        F.struct(F.lit(t).alias("cell_type"), (F.col(t) / F.col("n")).alias("share"))
        for t in ("null", "int", "float", "string")
    ])))
    earlier = Window.partitionBy("col_idx", "cell_type").orderBy(batch).rowsBetween(
        Window.unboundedPreceding, -1)
    mean, deviation = F.avg("share").over(earlier), F.stddev_samp("share").over(earlier)
    scored = shares.withColumn("z", F.when(
        deviation > 1e-12, (F.col("share") - mean) / deviation))
    largest = F.max(F.abs("z")).over(Window.partitionBy(batch))
    return scored.select(
        F.col(batch),
        _column_names(columns).alias("column_name"),
        "cell_type",
        F.round("share", 6).alias("share"),
        F.round("z", 4).alias("z"),
        F.coalesce(F.abs("z") > 2, F.lit(False)).alias("drifted"),
        F.round(F.try_divide(F.abs("z"), largest) * 100, 3).alias("deviation_pct"),
    )


def entropy_drift(df: DataFrame, batch: str, columns: list[str]) -> DataFrame:
    """Change of each column's entropy from one batch to the next, in percent
    of the largest entropy its values over all batches allow."""
    counts = with_cell_type(value_counts(df, [batch], columns)).filter("cell_type <> 'null'")
    per_batch = counts.groupBy("col_idx", batch).agg(
        F.sum("n").alias("n"), F.sum(n_log_n(F.col("n"))).alias("s"))
    overall = (
        counts.select("col_idx", *KEY_FIELDS).distinct()
        .groupBy("col_idx").agg(F.count(F.lit(1)).alias("distinct_values"))
    )
    steps = per_batch.join(overall, "col_idx").withColumn(
        "h", entropy_bits(F.col("n"), F.col("s")))
    previous = F.lag("h").over(Window.partitionBy("col_idx").orderBy(batch))
    top = F.when(F.col("distinct_values") > 1, F.log2("distinct_values")).otherwise(1.0)
    return steps.select(
        F.col(batch),
        _column_names(columns).alias("column_name"),
        F.round("h", 6).alias("entropy_bits"),
        F.round(F.abs(F.col("h") - previous) / top * 100, 4).alias("entropy_drift_pct"),
    )


def _filled(name: str) -> Column:
    return ~is_nullish(F.col(quoted(name)))


def pattern_violations(df: DataFrame, registry: dict[str, str]) -> DataFrame:
    """Per registered column: filled values that break the expected pattern.

    ``registry`` maps column names to pattern kinds. One pass for all columns.
    """
    names = list(registry)
    totals = df.agg(*[
        agg for i, name in enumerate(names) for agg in (
            F.count_if(_filled(name)).alias(f"f{i}"),
            F.count_if(_filled(name) & ~matches_pattern(F.col(quoted(name)), registry[name]))
            .alias(f"v{i}"))
    ])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.lit(registry[name]).alias("kind"),
                 F.col(f"f{i}").alias("filled"), F.col(f"v{i}").alias("violations"),
                 pct(F.col(f"v{i}"), F.col(f"f{i}")).alias("violation_pct"))
        for i, name in enumerate(names)
    ])))


def cross_field_incoherence(df: DataFrame, registry: dict[str, str]) -> DataFrame:
    """Values that slid into a neighbouring column.

    Columns next to each other in ``registry`` form a pair. A pair of filled
    cells is incoherent when one of them breaks its own pattern and fits the
    neighbour's.
    """
    names = list(registry)

    def slid(name: str, neighbour: str) -> Column:
        cell = F.col(quoted(name))
        return ~matches_pattern(cell, registry[name]) & matches_pattern(cell, registry[neighbour])

    expected, violated = [], []
    for left, right in zip(names, names[1:]):
        both = _filled(left) & _filled(right)
        expected.append(both.cast("int"))
        violated.append((both & (slid(left, right) | slid(right, left))).cast("int"))
    total = lambda parts: F.coalesce(F.sum(reduce(lambda a, b: a + b, parts)), F.lit(0))
    return df.agg(
        total(expected).alias("expected_pairs"),
        total(violated).alias("violated_pairs"),
    ).withColumn("incoherence_pct", pct(F.col("violated_pairs"), F.col("expected_pairs")))
