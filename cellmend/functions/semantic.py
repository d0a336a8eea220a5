"""Semantic types from column names, and rule-driven cleaning of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cellmend.functions import fixed_values as fv
from cellmend.functions.clean import CLEANERS
from cellmend.functions.normalize import quoted


@dataclass(frozen=True)
class Rule:
    """A user's own rule, tried before the built-in ones.

    ``fragment`` is looked for in the lower-cased column name; ``cleaner``
    maps a Column to a Column and defaults to the one of ``semantic_type``.
    """

    fragment: str
    semantic_type: str
    cleaner: Callable[[Column], Column] | None = None


def _fragments(rules: Iterable[Rule]) -> list[tuple[str, tuple[str, ...]]]:
    return [(r.semantic_type, (r.fragment,)) for r in rules] + list(fv.SEMANTIC_FRAGMENTS)


def semantic_type_of(name: str, rules: Iterable[Rule] = ()) -> str | None:
    """Semantic type of one column name; first matching entry wins."""
    lowered = name.lower()
    return next((kind for kind, words in _fragments(rules)
                 if any(word in lowered for word in words)), None)


def semantic_type(name: Column, rules: Iterable[Rule] = ()) -> Column:
    """The same decision for a column of column names."""
    lowered = F.lower(name)
    decided = F.lit(None).cast("string")
    for kind, words in reversed(_fragments(rules)):
        hit = lowered.contains(words[0])
        for word in words[1:]:
            hit = hit | lowered.contains(word)
        decided = F.when(hit, kind).otherwise(decided)
    return decided


def cleaner_for(name: str, rules: Iterable[Rule] = ()) -> Callable[[Column], Column] | None:
    lowered = name.lower()
    for rule in rules:
        if rule.fragment in lowered:
            return rule.cleaner or CLEANERS.get(rule.semantic_type)
    kind = semantic_type_of(name)
    return CLEANERS.get(kind) if kind else None


_TYPED = {
    ("currency", T.NumericType): lambda c: c.cast("double"),
    ("percentage", T.NumericType): lambda c: F.when(c.between(0, 100), c.cast("double")),
    ("date", T.DateType): lambda c: F.date_format(c, "yyyy-MM-dd"),
    ("date", T.TimestampType): lambda c: F.date_format(c, "yyyy-MM-dd"),
    ("date", T.TimestampNTZType): lambda c: F.date_format(c, "yyyy-MM-dd"),
}


def _cleaner(field: T.StructField, rules: list[Rule]) -> Callable[[Column], Column] | None:
    """The cleaner of a column; a number or date that already has its type
    is not read back from text."""
    if not any(rule.fragment in field.name.lower() for rule in rules):
        kind = semantic_type_of(field.name)
        for (wanted, data_type), convert in _TYPED.items():
            if kind == wanted and isinstance(field.dataType, data_type):
                return convert
    return cleaner_for(field.name, rules)


def apply_cleaners(df: DataFrame, rules: Iterable[Rule] = ()) -> DataFrame:
    """Clean every column that has a semantic type, in one projection."""
    rules = list(rules)
    out = []
    for field in df.schema.fields:
        cleaner = _cleaner(field, rules)
        column = F.col(quoted(field.name))
        out.append(cleaner(column).alias(field.name) if cleaner else column)
    return df.select(*out)


def clean_dry_run(df: DataFrame, rules: Iterable[Rule] = ()) -> DataFrame:
    """Per cleaned column: values that would change and that would turn null.

    One pass: all counters are one partial aggregate.
    """
    rules = list(rules)
    counters, names = [], []
    for field in df.schema.fields:
        name, cleaner = field.name, _cleaner(field, rules)
        if cleaner is None:
            continue
        before = F.col(quoted(name)).cast("string")
        after = cleaner(F.col(quoted(name))).cast("string")
        changed = ~before.eqNullSafe(after)
        names.append(name)
        counters += [
            F.count_if(changed & after.isNotNull()).alias(f"changed_{len(names)}"),
            F.count_if(changed & after.isNull()).alias(f"nulled_{len(names)}"),
        ]
    if not names:
        raise ValueError("no column of the table has a cleaner")
    totals = df.agg(F.count(F.lit(1)).alias("rows"), *counters)
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col("rows"),
                 F.col(f"changed_{i}").alias("values_changed"),
                 F.col(f"nulled_{i}").alias("values_nulled"))
        for i, name in enumerate(names, 1)
    ])))
