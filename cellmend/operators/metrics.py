"""Integrity metrics from value counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cellmend.functions.classify import is_nullish
from cellmend.functions.normalize import quoted
from cellmend.operators.cells import (
    count_values, type_counts, value_cells, value_counts, value_kind, with_cell_type)

METRICS = ["null_pct", "field_deviation_pct", "type_deviation_pct", "entropy_delta_pct"]
METRIC_FIELDS = METRICS + ["total_rows", "total_cells"]


def pct(part: Column, whole: Column) -> Column:
    """Rounded percentage; 0 when there is nothing to divide."""
    return F.round(F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0)), 3)


def entropy_bits(total: Column, n_log_n: Column) -> Column:
    """Shannon entropy of counts n: log2(N) - sum(n*log2 n)/N."""
    return F.log2(total) - n_log_n / total


def n_log_n(n: Column) -> Column:
    return n * F.log2(n)


def entropy_delta(total: Column, spread: Column, distinct: Column) -> Column:
    """Distance in percent from the uniform distribution; null below two
    values, 100 for a constant column."""
    top = F.when(distinct > 1, F.log2(distinct)).otherwise(1.0)
    return F.when(total >= 2, F.abs(entropy_bits(total, spread) / top - 1) * 100)


def type_counters() -> list[Column]:
    """Aggregates over classified value counts: cells per type, distinct
    values and the entropy input."""
    real = F.col("cell_type") != "null"
    of_type = lambda t: F.sum(F.when(F.col("cell_type") == t, F.col("n")).otherwise(0))
    return [
        F.sum("n").alias("n_cells"),
        of_type("null").alias("n_null"),
        of_type("int").alias("n_int"),
        of_type("float").alias("n_float"),
        of_type("string").alias("n_string"),
        F.count_if(real).alias("distinct_values"),
        F.coalesce(F.sum(F.when(real, n_log_n(F.col("n")))), F.lit(0.0)).alias("n_log_n"),
    ]


def column_stats(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per cell type, distinct values and entropy input per column."""
    return with_cell_type(counts).groupBy(*keys).agg(*type_counters())


def finish_columns(stats: DataFrame) -> DataFrame:
    filled = F.col("n_cells") - F.col("n_null")
    modal = F.greatest("n_int", "n_float", "n_string")
    return (
        stats.withColumn("n_filled", filled)
        .withColumn("n_off_type", F.col("n_filled") - modal)
        .withColumn("delta", entropy_delta(
            F.col("n_filled"), F.col("n_log_n"), F.col("distinct_values")))
    )


def table_metrics(columns: DataFrame, keys: list[str], rows: Column) -> DataFrame:
    """Null, type and entropy metrics per table from finished columns."""
    return columns.groupBy(*keys).agg(
        pct(F.sum("n_null"), F.sum("n_cells")).alias("null_pct"),
        pct(F.sum("n_off_type"), F.sum("n_filled")).alias("type_deviation_pct"),
        F.round(F.coalesce(F.avg("delta"), F.lit(0.0)), 3).alias("entropy_delta_pct"),
        F.coalesce(rows, F.lit(0)).cast("bigint").alias("total_rows"),
        F.sum("n_cells").cast("bigint").alias("total_cells"),
    )


def _all_columns(tables: dict[str, DataFrame]) -> tuple[DataFrame, Column]:
    """Finished column statistics of all tables in one job, and the column
    that describes them. The cells of all tables share one shuffle."""
    cells = reduce(DataFrame.unionByName, [
        value_cells(df).withColumn("table_idx", F.lit(i)) for i, df in enumerate(tables.values())])
    entries = F.array(*[
        F.struct(F.lit(name).alias("table_name"),
                 F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
                 F.array(*[F.lit(value_kind(f.dataType)) for f in df.schema.fields]).alias("kinds"))
        for name, df in tables.items()])
    entry = F.element_at(entries, F.col("table_idx") + 1)
    counts = count_values(cells).withColumn(
        "kind", F.element_at(entry["kinds"], F.col("col_idx") + 1))
    return finish_columns(column_stats(counts, ["table_idx", "col_idx"])), entry


def profile_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column of every table."""
    columns, entry = _all_columns(tables)
    return columns.select(
        entry["table_name"].alias("table_name"),
        F.element_at(entry["columns"], F.col("col_idx") + 1).alias("column_name"),
        F.col("n_cells").alias("total_cells"),
        F.col("n_null").alias("null_cells"),
        "n_int", "n_float", "n_string", "distinct_values",
        F.round(F.when(F.col("n_filled") > 0, F.abs(entropy_bits(
            F.col("n_filled"), F.col("n_log_n")))), 3).alias("entropy_bits"),
        F.round("delta", 3).alias("entropy_delta_pct"),
    )


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Null, type and entropy metrics and sizes of every table, in one job."""
    columns, entry = _all_columns(tables)
    metrics = table_metrics(columns, ["table_idx"], F.max("n_cells"))
    return metrics.select(entry["table_name"].alias("table_name"), *metrics.columns[1:])


def null_pct(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """Share of nullish cells over all columns not in ``by``."""
    columns = [c for c in df.columns if c not in by]
    nullish = reduce(lambda a, b: a + b,
                     [is_nullish(F.col(quoted(c))).cast("int") for c in columns])
    return df.groupBy(*by).agg(
        pct(F.sum(nullish), F.count(F.lit(1)) * len(columns)).alias("null_pct"))


def field_deviation(rows: DataFrame, width: Column, by: list[str] = ()) -> DataFrame:
    """Share of rows whose width is not the most common one."""
    by = list(by)
    sizes = rows.groupBy(*by, width.alias("_width")).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.groupBy(*by).agg(
        pct(F.sum("_n") - F.max("_n"), F.sum("_n")).alias("field_deviation_pct"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
    )


def filled_width(df: DataFrame) -> Column:
    """Number of non-null cells of a row, the width of an already parsed row."""
    return reduce(lambda a, b: a + b,
                  [F.col(quoted(c)).isNotNull().cast("int") for c in df.columns])


def json_key_width(record: Column) -> Column:
    """Number of top-level keys of a JSON object in a text column."""
    return F.coalesce(F.size(F.json_object_keys(record)), F.lit(0))


def type_deviation(df: DataFrame) -> DataFrame:
    """One row: share of filled cells off their column's most common type."""
    filled = F.col("cell_type") != "null"
    columns = type_counts(df).groupBy("col_idx").agg(
        F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("n_filled"),
        F.coalesce(F.max(F.when(filled, F.col("n"))), F.lit(0)).alias("n_modal"))
    return columns.agg(pct(F.sum(F.col("n_filled") - F.col("n_modal")), F.sum("n_filled"))
                       .alias("type_deviation_pct"))


def entropy_delta_pct(df: DataFrame) -> DataFrame:
    """One row: mean distance of the columns from a uniform distribution."""
    columns = finish_columns(column_stats(value_counts(df), ["col_idx"]))
    return columns.agg(
        F.round(F.coalesce(F.avg("delta"), F.lit(0.0)), 3).alias("entropy_delta_pct"))


def with_errors(inventory: DataFrame, metrics: DataFrame, key: str,
                reason: Column | None = None) -> DataFrame:
    """Every inventory row, with null metrics and a reason where none exist.

    ``reason`` explains a row without metrics from the inventory's columns.
    """
    fields = [c for c in metrics.columns if c != key]
    scanned = metrics.withColumn("_scanned", F.lit(True))
    why = reason if reason is not None else F.lit("no metrics")
    return inventory.join(scanned, key, "left").select(
        *[F.col(quoted(c)) for c in inventory.columns],
        *[F.col(c) for c in fields],
        F.when(F.col("_scanned"), "").otherwise(F.coalesce(why, F.lit("no metrics"))).alias("error"),
    )


def attach_metrics(inventory: DataFrame, metrics: DataFrame, key: str = "serial_number") -> DataFrame:
    """Join metrics to the inventory, replacing those of an earlier run."""
    stale = [c for c in metrics.columns if c != key and c in inventory.columns]
    return inventory.drop(*stale).join(metrics, key, "left")


def is_ok(error: Column) -> Column:
    return error.isNull() | (error == "")


def summary(metrics: DataFrame) -> DataFrame:
    """One row per metric: mean and maximum over the files without error,
    with the file counts alongside."""
    ok = is_ok(F.col("error"))
    present = [m for m in METRICS if m in metrics.columns]
    totals = metrics.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(ok).alias("ok"),
        F.count_if(~ok).alias("errors"),
        *[F.avg(F.when(ok, F.col(m))).alias(f"mean_{m}") for m in present],
        *[F.max(F.when(ok, F.col(m))).alias(f"max_{m}") for m in present],
    )
    return totals.select("files", "ok", "errors", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"),
                 F.round(f"mean_{m}", 2).alias("mean"),
                 F.round(f"max_{m}", 2).alias("max"))
        for m in present
    ])))


def error_files(metrics: DataFrame) -> DataFrame:
    return metrics.filter(~is_ok(F.col("error")))
