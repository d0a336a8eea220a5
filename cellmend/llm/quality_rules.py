"""Quality rules: a table of thresholds compiled into one Spark projection.

Every measure and every verdict is an expression of Spark's own functions over
one row; nothing is exploded, shuffled or handed to Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

WINDOW_WORDS = 5
_SPACE = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_MARKS = ".,;:!?"

#: Frequent words of English, German, French and Spanish.
STOP_WORDS = tuple(dict.fromkeys((
    "the of and to in a is that it as for was on are by with be this from or an at "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un une du dans que pour qui sur au par est pas ce "
    "de la que el en y a los se del las un por con una su para es al lo").split()))


@dataclass(frozen=True)
class Rule:
    """``measure`` (a Spark expression over the base columns) within limits."""
    name: str
    measure: str
    least: float | None = None
    most: float | None = None

    def holds(self) -> Column:
        value, out = F.expr(self.measure), F.lit(True)
        if self.least is not None:
            out = out & (value >= self.least)
        if self.most is not None:
            out = out & (value <= self.most)
        return F.coalesce(out, F.lit(False))


RULES = (
    Rule("mean_word_length", "try_divide(word_chars, n_words)", 2.5, 12.0),
    Rule("symbol_ratio", "try_divide(n_symbols, n_words)", most=0.1),
    Rule("stop_word_ratio", "try_divide(n_stop_words, n_words)", 0.04),
    Rule("duplicate_line_ratio", "try_divide(n_dup_lines, n_lines)", most=0.35),
    Rule("words_per_line", "try_divide(n_words, n_lines)", 1.5),
)


def _repeat_words(hashes: str) -> Column:
    """Words in windows of five that occur twice or more, each word once.

    Only a text with such a window sorts its windows, to find their places.
    """
    h = F.col(hashes)
    last = F.size(h) - WINDOW_WORDS
    window = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW_WORDS)])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), window)).otherwise(
        F.array().cast("array<bigint>"))


def _covered() -> Column:
    """Size of the union of the repeated windows, from ``windows``."""
    ordered = F.array_sort(F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def of(s: Column) -> Column:
        at = lambda k: F.get(s, k)["x"]
        twice = F.filter(s, lambda e, k: (e["x"] == at(k - 1)) | (e["x"] == at(k + 1)))
        places = F.array_sort(F.transform(twice, lambda e: e["i"]))
        return F.aggregate(
            places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
            lambda acc, i: F.struct((i + WINDOW_WORDS).alias("end"),
                                    (acc["n"] + i + WINDOW_WORDS - F.greatest(i, acc["end"])).alias("n")),
            lambda acc: acc["n"])

    # One evaluation of the sorted windows, held by a one-element array.
    return F.get(F.transform(F.array(ordered), of), F.lit(0))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept)``, one row per row of ``docs``, and one boolean
    ``ok_<rule>`` per rule.

    ``base_failed``: fewer than 10 words, or more than 20 % of them in repeated
    windows. ``kept``: the base holds and so does every rule; a rule that has
    nothing to divide by does not hold.

    A null text counts as empty: all counts 0, base failed, not kept. A null
    ``doc_id`` and repeated rows stay as they are; other columns are not read.
    An empty table gives an empty result. Whole texts of any length are taken.
    """
    text = F.coalesce("text", F.lit(""))
    long = lambda c: c.cast("long")
    split = docs.select("doc_id", text.alias("_text")).select(
        "doc_id", "_text",
        F.filter(F.split("_text", _SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.filter(F.split(F.translate(F.lower("_text"), _MARKS, " " * len(_MARKS)), _SPACE),
                 lambda w: w.isin(*STOP_WORDS)).alias("stops"))
    hashed = split.select(
        "doc_id", "_text", "lines",
        long(F.size("words")).alias("n_words"), long(F.size("stops")).alias("n_stop_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    windows = hashed.withColumn("windows", _repeat_words("hashes"))
    length = lambda gone: F.length(F.translate("_text", gone, ""))
    measured = windows.select(
        "doc_id", "n_words", "n_stop_words", long(F.size("lines")).alias("n_lines"),
        long(length(_SPACES)).alias("word_chars"),
        long(F.length("_text") - length(SYMBOLS)).alias("n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        long(F.when(F.size(F.array_distinct("windows")) < F.size("windows"), _covered())
             .otherwise(0)).alias("n_repeat_words"))
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = measured.select("*", base_failed.alias("base_failed"),
                             *[rule.holds().alias(f"ok_{rule.name}") for rule in rules])
    kept = ~F.col("base_failed")
    for rule in rules:
        kept = kept & F.col(f"ok_{rule.name}")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", kept.alias("kept"), *[f"ok_{rule.name}" for rule in rules])
