"""Integrity metrics of many files at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellmend.operators.cells import long_text_type, text_key, with_cell_type
from cellmend.functions.classify import folded_text
from cellmend.operators.metrics import finish_columns, n_log_n, pct, type_counters

WIDTH = -1  # the pseudo column that holds each record's field count


def _text_counts(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct values of text cells with their counts and first place.

    The width cells take part as one more column, so field deviation costs no
    pass of its own.
    """
    folded = F.col("_folded")
    return (
        cells.select(*keys, "place", folded_text(F.col("value")).alias("_folded"))
        .select(*keys, "place", text_key(folded).alias("key_text"),
                long_text_type(folded).alias("long_type"))
        .groupBy(*keys, "key_text", "long_type")
        .agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place"))
        .select("*", F.lit(None).cast("bigint").alias("key_int"),
                F.lit(None).cast("double").alias("key_float"), F.lit("text").alias("kind"))
    )


_TYPES = ("null", "int", "float", "string")
_WIDTHS = 1 << 31  # more than the fields a record can have


def _per_column(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Column statistics plus the first cell and, for widths, the modal ones.

    Count and width share one decimal with room for both, and cell types are
    codes, so that all buffers are fixed-size and the aggregate stays a hash
    aggregate.
    """
    typed = with_cell_type(counts)
    width = F.col("key_text").try_cast("bigint")
    code = F.lit(0)
    for i, name in enumerate(_TYPES):
        code = F.when(F.col("cell_type") == name, i).otherwise(code)
    is_width = F.col("is_width")
    whole = lambda c, digits: c.cast(f"decimal({digits},0)")
    base = whole(F.lit(_WIDTHS), 10)
    packed = lambda w: F.max(F.when(is_width, whole(F.col("n"), 19) * base + whole(w, 11)))
    return typed.groupBy(*keys).agg(
        F.min("place").alias("first_place"),
        F.min_by("n", "place").alias("first_n"),
        F.min_by(code, F.col("place")).alias("first_type"),
        packed(width).alias("widest_top"),
        packed(_WIDTHS - 1 - width).alias("narrowest_top"),
        *type_counters()
    ).withColumn("top_n", ((F.col("widest_top") - F.col("widest_top") % base) / base).cast("bigint")
    ).withColumn("top_is_tie", (F.col("widest_top") % base).cast("bigint")
                 != _WIDTHS - 1 - (F.col("narrowest_top") % base).cast("bigint"))


def _without_header(stats: DataFrame, header: Column) -> DataFrame:
    """Take the header row's cell out of the counts of its column.

    The header is known only once the file's first record is, so it is counted
    like any record and subtracted afterwards; that avoids a second scan.
    """
    n = F.col("first_n")
    gone = header.cast("int")
    real = (F.col("first_type") != _TYPES.index("null")) & header
    less = n_log_n(n) - F.when(n > 1, n_log_n(n - 1)).otherwise(0.0)
    changed = {
        "n_cells": F.col("n_cells") - gone,
        "distinct_values": F.col("distinct_values") - F.when(real & (n == 1), 1).otherwise(0),
        "n_log_n": F.col("n_log_n") - F.when(real, less).otherwise(0.0),
    }
    for i, name in enumerate(_TYPES):
        changed[f"n_{name}"] = F.col(f"n_{name}") - F.when(
            F.col("first_type") == i, gone).otherwise(0)
    return stats.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in stats.columns])


def profile_records(records: DataFrame, key: str = "file_path",
                    has_header: Column | bool = True) -> DataFrame:
    """Null, field, type and entropy deviation and sizes per file.

    Two shuffles for all files together: distinct values, then one row per
    (file, column) and task. ``has_header`` may be a column of ``records``
    that is constant within a file.
    """
    flag = has_header if isinstance(has_header, Column) else F.lit(has_header)
    # Only a file's first split can hold its first record.
    place = F.when(F.col("block") == 0, F.col("line_no"))
    width_cell = F.array(F.struct(F.lit(WIDTH).alias("col_idx"),
                                  F.col("width").cast("string").alias("value")))
    field_cells = F.transform("fields", lambda value, i: F.struct(
        i.alias("col_idx"), value.alias("value")))
    cells = records.select(
        key, flag.alias("headed"), place.alias("place"),
        F.inline(F.concat(width_cell, field_cells)))
    keys = [key, "headed", "col_idx"]
    is_width = F.col("col_idx") == WIDTH
    stats = _per_column(_text_counts(cells, keys).withColumn("is_width", is_width), keys)

    of_file = Window.partitionBy(key)
    first_record = F.min(F.when(~is_width, F.col("first_place"))).over(of_file)
    placed = stats.withColumn("first_record", first_record)
    # Columns beyond the first record's width do not belong to the table.
    known = placed.filter(is_width | (F.col("first_place") == F.col("first_record")))
    head_is_top = (F.col("headed") & (F.col("first_n") == F.col("top_n"))
                   & ~F.col("top_is_tie"))
    modal = F.col("top_n") - head_is_top.cast("int")
    data = _without_header(known.withColumn("modal_rows", modal), F.col("headed"))

    rows = F.max(F.when(F.col("col_idx") == 0, F.col("n_cells"))).over(of_file)
    sized = data.withColumn("rows", F.coalesce(rows, F.lit(0)))
    padded = (sized
              .withColumn("n_null", F.col("n_null") + F.col("rows") - F.col("n_cells"))
              .withColumn("n_cells", F.when(is_width, F.col("n_cells")).otherwise(F.col("rows"))))
    done = finish_columns(padded)
    field = lambda name: F.sum(F.when(~is_width, F.col(name)))
    width = lambda name: F.max(F.when(is_width, F.col(name)))
    return done.groupBy(key).agg(
        pct(field("n_null"), field("n_cells")).alias("null_pct"),
        pct(width("n_cells") - width("modal_rows"), width("n_cells")).alias("field_deviation_pct"),
        pct(field("n_off_type"), field("n_filled")).alias("type_deviation_pct"),
        F.round(F.coalesce(F.avg(F.when(~is_width, F.col("delta"))), F.lit(0.0)), 3)
        .alias("entropy_delta_pct"),
        F.max("rows").alias("total_rows"),
        F.coalesce(field("n_cells"), F.lit(0)).alias("total_cells"),
    )


def profile_json(cells: DataFrame, key: str = "file_path") -> DataFrame:
    """The same metrics for JSON records.

    ``cells`` holds ``(key, column_name, value)`` per leaf and, with a null
    ``column_name``, one row per record whose value is its key count.
    """
    keys = [key, "column_name"]
    counts = _text_counts(cells.withColumn("place", F.lit(None).cast("bigint")), keys)
    is_width = F.col("column_name").isNull()
    stats = _per_column(counts.withColumn("is_width", is_width), keys)
    rows = F.max(F.when(is_width, F.col("n_cells"))).over(Window.partitionBy(key))
    padded = (
        stats.withColumn("rows", rows)
        .withColumn("n_null", F.col("n_null") + F.col("rows") - F.col("n_cells"))
        .withColumn("n_cells", F.col("rows"))
        .withColumn("modal_rows", F.col("top_n")))
    done = finish_columns(padded)
    field = lambda name: F.sum(F.when(~is_width, F.col(name)))
    width = lambda name: F.max(F.when(is_width, F.col(name)))
    return done.groupBy(key).agg(
        pct(field("n_null"), field("n_cells")).alias("null_pct"),
        pct(F.max("rows") - width("modal_rows"), F.max("rows")).alias("field_deviation_pct"),
        pct(field("n_off_type"), field("n_filled")).alias("type_deviation_pct"),
        F.round(F.coalesce(F.avg(F.when(~is_width, F.col("delta"))), F.lit(0.0)), 3)
        .alias("entropy_delta_pct"),
        F.max("rows").alias("total_rows"),
        F.coalesce(field("n_cells"), F.lit(0)).alias("total_cells"),
    )
