"""Predicates and cell classifiers over text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cellmend.functions import fixed_values as fv

WHITESPACE = " \t\n\r\f\x0b"
FLOAT_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$"


def strip(col: Column) -> Column:
    """Remove every kind of ASCII white space from both ends."""
    return F.trim(col.cast("string"), F.lit(WHITESPACE))


def folded_text(col: Column, strip_mode: str = "space") -> Column:
    """Lower-cased, trimmed text; null becomes the empty string.

    ``strip_mode='space'`` trims blanks only, ``'unicode'`` any white space.
    """
    text = F.coalesce(col.cast("string"), F.lit(""))
    if strip_mode == "unicode":
        text = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    else:
        text = F.trim(text)
    return F.lower(text)


def clean_text(col: Column, strip_mode: str = "space") -> Column:
    """Folded text without commas and blanks: what the classifiers look at."""
    return F.translate(folded_text(col, strip_mode), ", ", "")


def is_nullish(col: Column, strip_mode: str = "space") -> Column:
    """True for null and for every spelling of "no value"."""
    return clean_text(col, strip_mode).isin(*fv.NULLISH)


def infer_cell_type(col: Column, strip_mode: str = "space") -> Column:
    """``null``, ``int``, ``float`` or ``string`` for one cell."""
    text = clean_text(col, strip_mode)
    return (
        F.when(text.isin(*fv.NULLISH), "null")
        .when(text.rlike(r"^-?\d+$"), "int")
        .when(text.rlike(r"^-?\d+\.\d+$"), "float")
        .otherwise("string")
    )


def infer_cell_type_lenient(col: Column) -> Column:
    """Like :func:`infer_cell_type`, but takes ``+5``, ``.5``, ``5.``, ``1e5``
    and ``inf`` as numbers. Digit groups joined by ``_`` stay text."""
    folded = F.lower(strip(F.coalesce(col.cast("string"), F.lit(""))))
    digits = F.translate(folded, ", ", "")
    number = F.translate(folded, ",", "")
    return (
        F.when(folded.isin(*fv.NULLISH), "null")
        .when(digits.rlike(r"^[+-]?\d+$"), "int")
        .when(number.rlike(FLOAT_TEXT), "float")
        .when(number.rlike(r"^[+-]?(inf|infinity|nan)$"), "float")
        .otherwise("string")
    )


def is_blank(col: Column) -> Column:
    return strip(F.coalesce(col.cast("string"), F.lit(""))) == ""


def header_cell_type(col: Column) -> Column:
    """``bool``, ``int``, ``float``, ``date``, ``string``; null when blank."""
    text = strip(col)
    lower = F.lower(text)
    return (
        F.when(text.isNull() | (text == ""), F.lit(None).cast("string"))
        .when(lower.isin("true", "false"), "bool")
        .when(text.rlike(r"^[+-]?\d+$"), "int")
        .when(text.rlike(r"^[+-]?\d*\.\d+(?:[eE][+-]?\d+)?$"), "float")
        .when(text.rlike(r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}$"), "date")
        .when(text.rlike(r"^\d{1,2}[-/]\d{1,2}[-/]\d{2,4}$"), "date")
        .when(lower.rlike(fv.MONTH_WORD), "date")
        .otherwise("string")
    )


def looks_like_data(cell: Column) -> Column:
    """The cell holds an e-mail address or is a run of three or more digits.

    One character before the sign tells as much as the whole local part, and
    spares a search that starts anew at every character of a long cell.
    """
    return (cell.contains("@") & cell.rlike(fv.EMAIL_ANYWHERE)) | cell.rlike(fv.LONG_DIGITS)


def has_data_patterns(row: Column) -> Column:
    """Any cell of an array of strings :func:`looks_like_data`."""
    return F.exists(row, lambda cell: F.coalesce(looks_like_data(strip(cell)), F.lit(False)))


def is_plain_number(col: Column) -> Column:
    return col.rlike(fv.PLAIN_NUMBER)


def header_token_score(col: Column) -> Column:
    """How much one cell reads like a column name, 0 to 1."""
    text = F.coalesce(strip(col), F.lit(""))
    return (
        F.when(F.lower(text).isin(*fv.HEADER_WORDS), 1.0)
        .when(text.rlike(fv.HEADER_STYLE), 0.9)
        .when(text.rlike(fv.HEADER_PHRASE) & text.contains(" "), 0.6)
        .otherwise(0.0)
    )


PATTERNS = {
    "email": [fv.EMAIL],
    "url": [fv.URL],
    "zip": [fv.ZIP],
    "phone": [f"^{fv.PHONE}$"],
    "currency": [r"^[(]?[+-]?[$€¥£]?\s*[+-]?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?[)]?$"],
    "date": [fv.DATE_YMD, fv.DATE_MDY, fv.DATE_DMY],
}


def matches_pattern(col: Column, kind: str) -> Column:
    """The whole stripped cell fits the registered pattern of ``kind``."""
    text = strip(col)
    first, *rest = PATTERNS[kind]
    hit = text.rlike(first)
    for pattern in rest:
        hit = hit | text.rlike(pattern)
    return hit
