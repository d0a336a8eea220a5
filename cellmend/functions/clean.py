"""Value cleaners: text in, clean text (or a double) out, null when invalid."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from cellmend.functions import fixed_values as fv
from cellmend.functions.classify import strip

_UNSIGNED = r"^(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_SIGNED = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def clean_phone(col: Column) -> Column:
    """``AAA-BBB-CCCC`` from the first phone-shaped run, else from the last
    ten digits of the cell."""
    text = strip(col)
    run = F.regexp_extract(text, fv.PHONE, 0)
    digits = F.regexp_replace(F.when(run != "", run).otherwise(text), "[^0-9]", "")
    last = F.right(digits, F.lit(10))
    dashed = F.concat_ws("-", F.substring(last, 1, 3), F.substring(last, 4, 3),
                         F.substring(last, 7, 4))
    return F.when(F.length(digits) >= 10, dashed)


def clean_email(col: Column) -> Column:
    text = F.lower(strip(col))
    return F.when(text.rlike(fv.EMAIL), text)


def clean_currency(col: Column, compat: bool = False) -> Column:
    """Amount as double; ``(5)``, ``-5``, ``-$5`` and ``$-5`` are negative.

    ``compat=True`` keeps the historical sign rule, where any ``-`` anywhere
    negates a number that already carries its own sign (``-5`` gives 5).
    """
    text = strip(col)
    bare = F.regexp_replace(text, fv.CURRENCY_MARKS, "")
    if compat:
        negative = text.contains("-") | text.startswith("(")
        amount = F.when(bare.rlike(_SIGNED), bare).try_cast("double")
    else:
        negative = text.startswith("(") | text.rlike(r"^[^0-9.]*-")
        unsigned = F.regexp_replace(bare, "^-", "")
        amount = F.when(
            F.when(negative, unsigned.rlike(_UNSIGNED)).otherwise(bare.rlike(_SIGNED)),
            unsigned,
        ).try_cast("double")
    return F.when(negative & (amount != 0), -amount).otherwise(amount)


def clean_percentage(col: Column) -> Column:
    """First number of the cell, if it lies within 0..100."""
    number = F.regexp_extract(strip(col), r"[-+]?\d+\.?\d*", 0).try_cast("double")
    return F.when(number.between(0, 100), F.abs(number))


def clean_date(col: Column) -> Column:
    """ISO text of a year-month-day, month-day-year or day-month-year date.

    The orders are tried in that sequence; a date that does not exist falls
    through to the next one. Separators ``-`` and ``/`` may be mixed.
    """
    text = F.translate(strip(col), "/", "-")
    ymd = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text)
    mdy = F.when(text.rlike(r"^\d{2}-\d{2}-\d{4}$"),
                 F.concat(F.right(text, F.lit(4)), F.lit("-"), F.substring(text, 1, 5)))
    month = F.substr(text, F.lit(4), F.length(text) - 8)
    dmy = F.when(text.rlike(r"^\d{2}-\d{1,2}-\d{4}$"),
                 F.concat(F.right(text, F.lit(4)), F.lit("-"), month, F.lit("-"),
                          F.substring(text, 1, 2)))
    dated = F.coalesce(ymd.try_cast("date"), mdy.try_cast("date"), dmy.try_cast("date"))
    return F.when(F.year(dated) >= 1, F.date_format(dated, "yyyy-MM-dd"))


def clean_name(col: Column) -> Column:
    """Letters, blanks, ``-`` and ``'`` only, with a capital after any
    non-letter (``mary-jane o'brien`` gives ``Mary-Jane O'Brien``)."""
    text = F.regexp_replace(strip(col), r"\s+", " ")
    text = F.regexp_replace(text, r"[^a-zA-Z\s\-']", "")
    # initcap() starts words at blanks only: open one behind '-' and "'".
    gap = "\x01 "
    split = F.replace(F.replace(text, F.lit("-"), F.lit("-" + gap)), F.lit("'"), F.lit("'" + gap))
    titled = F.replace(F.initcap(split), F.lit(gap), F.lit(""))
    return F.nullif(titled, F.lit(""))


def clean_url(col: Column) -> Column:
    text = F.lower(strip(col))
    return F.when(text.rlike(fv.URL), F.rtrim(text, F.lit("/")))


def clean_zip(col: Column) -> Column:
    text = strip(col)
    return F.when(text.rlike(fv.ZIP), text)


def clean_address(col: Column) -> Column:
    """Spell out street abbreviations and collapse white space."""
    text = strip(col)
    for short, word in fv.STREET_WORDS:
        text = F.regexp_replace(text, rf"(?i)\b{short}\.?\b", word)
    return F.nullif(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


CLEANERS: dict[str, Callable[[Column], Column]] = {
    "phone": clean_phone,
    "currency": clean_currency,
    "date": clean_date,
    "name": clean_name,
    "address": clean_address,
    "email": clean_email,
    "url": clean_url,
    "zip": clean_zip,
    "percentage": clean_percentage,
}
