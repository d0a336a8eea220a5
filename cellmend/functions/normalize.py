"""Column normalisation recipes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cellmend.functions import fixed_values as fv


def lower_trim(col: Column) -> Column:
    return F.trim(F.lower(col))


def strip_title(col: Column) -> Column:
    """Drop a parenthesised remark and a leading courtesy title."""
    return F.trim(F.regexp_replace(F.regexp_replace(col, fv.NAME_REMARK, ""), fv.NAME_TITLE, ""))


def squash_whitespace(col: Column) -> Column:
    return F.regexp_replace(col, r"\s+", "")


def phone_last10(col: Column) -> Column:
    """The last ten digits, or null when there are fewer."""
    digits = F.regexp_replace(col, r"[^0-9]", "")
    return F.when(F.length(digits) >= 10, F.right(digits, F.lit(10)))


def upper(col: Column) -> Column:
    return F.upper(col)


def to_long(col: Column) -> Column:
    """Whole number, or null: never an ANSI cast error."""
    return col.try_cast("bigint")


def parse_timestamp(col: Column, formats: tuple[str, ...] = fv.TIMESTAMP_FORMATS) -> Column:
    """First of the given formats that parses."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(fmt)) for fmt in formats])


def canonical_gender(col: Column) -> Column:
    code = F.upper(col)
    return F.when(code.isin("M", "MALE"), "Male").when(code.isin("F", "FEMALE"), "Female")


def strip_money(col: Column) -> Column:
    return F.translate(col, "$,", "")


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by their literal name, dots included."""
    gone = set(names)
    return df.select(*[F.col(quoted(c)) for c in df.columns if c not in gone])


def quoted(name: str) -> str:
    """A column name as one identifier, whatever dots or ticks it holds."""
    return "`" + name.replace("`", "``") + "`"
