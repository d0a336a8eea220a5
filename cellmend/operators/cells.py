"""The long cell shape: one row per (table, column, value).

Counting equal values first is what makes the profile cheap: the map-side
partial aggregate folds repeated values, classification runs once per distinct
value instead of once per cell, and what is shuffled is the set of distinct
values, not the cells. Two long texts are compared by digest, so a column of
whole documents shuffles 64 bytes per value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cellmend.functions.classify import folded_text, infer_cell_type
from cellmend.functions.normalize import quoted

# A SHA-256 digest has 64 hex digits; every text kept as it is is shorter, so
# texts and digests cannot meet.
DIGEST_LENGTH = 64

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def value_kind(data_type: T.DataType) -> str:
    """How a column's cells are keyed: ``int``, ``float``, ``time``, ``text``."""
    if isinstance(data_type, _INTEGRAL):
        return "int"
    if isinstance(data_type, _FRACTIONAL):
        return "float"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType)):
        return "time"
    return "text"


def as_text(col: Column, data_type: T.DataType) -> Column:
    """A cell as text; arrays, structs and maps become JSON."""
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(col)
    return col.cast("string")


# A long text can only be a number if nothing else is in it, and only be a
# "no value" if at most four characters are left without commas and blanks.
_MAYBE_NUMBER = r"^[-0-9., ]*+$"
_MAYBE_NULL = r"^[, ]*+(?:[^, ][, ]*+){0,4}$"


def text_key(folded: Column) -> Column:
    """What folded texts are grouped by: themselves, or a digest when long."""
    return F.when(F.length(folded) >= DIGEST_LENGTH, F.sha2(folded, 256)).otherwise(folded)


def long_text_type(folded: Column) -> Column:
    """Cell type of a text whose key is a digest; null for short texts."""
    special = folded.rlike(_MAYBE_NULL) | folded.rlike(_MAYBE_NUMBER)
    return F.when(F.length(folded) >= DIGEST_LENGTH,
                  F.when(special, infer_cell_type(folded)).otherwise("string"))


def text_cells(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """``(*by, column_name, value)``: every cell as text, one row each."""
    by = list(by)
    return df.select(*[F.col(quoted(b)) for b in by], F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"),
                 as_text(F.col(quoted(f.name)), f.dataType).alias("value"))
        for f in df.schema.fields if f.name not in by
    ])))


KEY_FIELDS = ["key_int", "key_float", "key_text", "long_type"]

_MICROS_NTZ = (
    "(unix_date(CAST({c} AS DATE)) * 24L + hour({c})) * 3600000000L + minute({c}) * 60000000L"
    " + CAST(extract(SECOND FROM {c}) * 1000000 AS BIGINT)")


def _cell_sql(i: int, name: str, data_type: T.DataType) -> str:
    """One cell as a struct of its column number and its value, which stands
    in the field that fits its type."""
    c = quoted(name)
    fields = {"key_int": "CAST(NULL AS BIGINT)", "key_float": "CAST(NULL AS DOUBLE)",
              "text": "CAST(NULL AS STRING)"}
    if isinstance(data_type, _FRACTIONAL):
        fields["key_float"] = f"CAST({c} AS DOUBLE)"
    elif isinstance(data_type, T.DateType):
        fields["key_int"] = f"CAST(unix_date({c}) AS BIGINT)"
    elif isinstance(data_type, T.TimestampType):
        fields["key_int"] = f"unix_micros({c})"
    elif isinstance(data_type, T.TimestampNTZType):
        fields["key_int"] = _MICROS_NTZ.format(c=c)
    elif value_kind(data_type) != "text":
        fields["key_int"] = f"CAST({c} AS BIGINT)"
    elif isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        fields["text"] = f"coalesce(to_json({c}), '')"
    else:
        fields["text"] = f"coalesce(CAST({c} AS STRING), '')"
    return f"named_struct('col_idx', {i}, " + ", ".join(
        f"'{field}', {value}" for field, value in fields.items()) + ")"


def value_cells(df: DataFrame, by: list[str] = (), columns: list[str] | None = None) -> DataFrame:
    """``(*by, col_idx, key_int, key_float, text)``: one row per cell."""
    by = list(by)
    columns = columns or [c for c in df.columns if c not in by]
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = ", ".join(_cell_sql(i, c, types[c]) for i, c in enumerate(columns))
    return df.select(*[F.col(quoted(b)) for b in by], F.expr(f"inline(array({cells}))"))


def count_values(cells: DataFrame) -> DataFrame:
    """``(..., key_*, n)``: how often each value occurs among the cells.

    One shuffle, of distinct values, after a partial aggregate in the map
    tasks; a value that fills a third of the table costs one row per task.
    """
    keyed = keyed_cells(cells)
    return keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("n"))


def keyed_cells(cells: DataFrame) -> DataFrame:
    """Cells with their texts folded, and digests in the place of long ones."""
    kept = [c for c in cells.columns if c != "text"]
    folded = F.col("_folded")
    # The text is folded in a projection of its own, so once per cell.
    return (
        cells.select(*kept, F.when(F.col("text").isNotNull(), folded_text(F.col("text")))
                     .alias("_folded"))
        .select(*kept, text_key(folded).alias("key_text"), long_text_type(folded).alias("long_type")))


def value_counts(df: DataFrame, by: list[str] = (), columns: list[str] | None = None) -> DataFrame:
    """``(*by, col_idx, key_*, n, kind)`` for the columns of one table."""
    columns = columns or [c for c in df.columns if c not in by]
    types = {f.name: f.dataType for f in df.schema.fields}
    labels = F.array(*[F.lit(value_kind(types[c])) for c in columns])
    return count_values(value_cells(df, by, columns)).withColumn(
        "kind", F.element_at(labels, F.col("col_idx") + 1))


def type_counts(df: DataFrame, by: list[str] = (), columns: list[str] | None = None) -> DataFrame:
    """``(*by, col_idx, cell_type, n)``: cells are classified where they are
    read, so only a few counts per column and task are shuffled."""
    columns = columns or [c for c in df.columns if c not in by]
    types = {f.name: f.dataType for f in df.schema.fields}
    labels = F.array(*[F.lit(value_kind(types[c])) for c in columns])
    cells = keyed_cells(value_cells(df, by, columns)).withColumn(
        "kind", F.element_at(labels, F.col("col_idx") + 1))
    return with_cell_type(cells).groupBy(*[F.col(quoted(b)) for b in by], "col_idx", "cell_type").agg(
        F.count(F.lit(1)).alias("n"))


def with_cell_type(counts: DataFrame) -> DataFrame:
    """Classify each distinct value: typed columns by type, text by its form."""
    missing = (
        F.col("key_int").isNull()
        & (F.col("key_float").isNull() | F.isnan("key_float"))
        & F.col("key_text").isNull()
    )
    return counts.withColumn(
        "cell_type",
        F.when(missing, "null")
        .when(F.col("kind").isin("int", "float"), F.col("kind"))
        .when(F.col("kind") == "time", "string")
        .when(F.col("long_type").isNotNull(), F.col("long_type"))
        .otherwise(infer_cell_type(F.col("key_text"))),
    )
