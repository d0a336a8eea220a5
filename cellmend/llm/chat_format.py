"""Conversations as training texts of limited length, with a loss mask.

Each turn costs its words and a little for its marks. Running sums of these costs
cut a conversation into windows of whole turns: within half of what a window may
hold, measured from the conversation's start, turns share a window, and a turn
longer than that half has one of its own. A window repeats the conversation's
system turn and the last turns of the window before it, as far as the history
allows. Every assistant turn is a target in the one window that it belongs to;
repeated, it is masked. Only Spark's own functions run.

A turn is written as ``### role: text</turn>`` and a line end. A backslash stands
before each backslash, ``#`` and ``<`` of a role or text (and ``:`` of a role), so
no text can hold a mark, and leaving out the backslashes gives the text back.

A conversation of up to ``LONG_TURNS`` turns is cut where its rows meet. Longer
ones, whatever their share of the rows, are numbered over ranges of rows and
assembled by window.

Cases: null roles and texts are empty; rows without ``conv_id`` form one
conversation; a null turn comes first; rows of one turn follow the hash of role
and text; repeated rows are turns of their own. A turn is never cut: a window whose
turns, system turn and history cost more than the budget says so. An empty table
gives no windows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellmend.llm.common import settled
from cellmend.llm.scans import ranged, scanned
from cellmend.operators.sizing import broadcast_if_small

BUDGET, HISTORY = 1024, 256
#: What the marks of a turn cost.
MARKS = 4
LONG_TURNS = 10_000
_OPEN, _MID, _CLOSE = "### ", ": ", "</turn>\n"
_TURN = r"(?s)### ((?:[^\\:#<]++|\\.)*+): ((?:[^\\#<]++|\\.)*+)</turn>\n"

Running = Callable[[DataFrame, list[Column], dict[str, Column]], DataFrame]


def escaped(text: Column, marks: str = "#<") -> Column:
    return F.regexp_replace(text, rf"([\\{marks}])", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    head = F.concat(F.lit(_OPEN), escaped(role, "#<:"), F.lit(_MID))
    body = escaped(text)
    return conversations.select(
        F.struct(F.col("conv_id").cast("long").alias("id")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("tie"), (words + MARKS).cast("long").alias("cost"),
        (role == "system").alias("system"), (role == "assistant").alias("target"),
        head.alias("head"), body.alias("body"))


def _plain(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    over = Window.partitionBy("conv").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({n: F.sum(c).over(over) for n, c in sums.items()})


def _over_ranges(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    return scanned(df, "conv", order, {n: (c, "sum") for n, c in sums.items()})


def _windows(turns: DataFrame, running: Running, budget: int, history: int) -> DataFrame:
    """A row per window, with its turns in order."""
    order = [F.asc_nulls_first("turn"), F.col("tie")]
    df = running(turns, order, {"pos": F.lit(1).cast("long"), "sum": F.col("cost")})
    at = [F.col("pos")]
    df = running(df, at, {"kept": F.when((F.col("pos") == 1) & F.col("system"), F.col("cost")).otherwise(0)})
    half = F.greatest(F.floor((F.lit(budget - history) - F.col("kept")) / 2), F.lit(1))
    df = df.withColumns({"half": half, "large": F.col("cost") > half})
    df = running(df, at, {"n_large": F.col("large").cast("long")})
    share = F.when(~F.col("large"), F.floor((F.col("sum") - F.col("cost")) / F.col("half")))
    before = F.col("sum") - F.col("cost")
    return df.groupBy("conv", "n_large", share.alias("share")).agg(
        F.sort_array(F.collect_list(F.struct(
            "pos", before.alias("before"), "system", "target", "cost", "head", "body"))).alias("turns"),
        F.min("pos").alias("first_turn"), F.max("pos").alias("last_turn"), F.max("sum").alias("until"),
    ).withColumn("tail", F.filter("turns", lambda t: (F.col("until") - t["before"] <= history)
                                  & ~((t["pos"] == 1) & t["system"])))


def _opening() -> Column:
    """The system turn, of a conversation's first window."""
    first = F.element_at("turns", 1)
    return F.when((F.col("first_turn") == 1) & first["system"], first)


def _with_repeats(windows: DataFrame) -> DataFrame:
    over = Window.partitionBy("conv").orderBy("first_turn")
    return windows.withColumns({
        "opening": F.first(_opening(), ignorenulls=True).over(
            over.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "history": F.lag("tail").over(over)})


def _with_repeats_by_window(windows: DataFrame) -> DataFrame:
    """The same by joins that no conversation is alone in."""
    windows = settled(windows)
    tails = windows.select("conv", (F.col("last_turn") + 1).alias("first_turn"), F.col("tail").alias("history"))
    openings = windows.select("conv", _opening().alias("opening")).filter("opening IS NOT NULL")
    return windows.join(tails, ["conv", "first_turn"], "left").join(
        broadcast_if_small(settled(openings)), "conv", "left")


def _written(windows: DataFrame, budget: int) -> DataFrame:
    none = F.array().cast(windows.schema["turns"].dataType)
    repeated = F.when(F.col("first_turn") > 1, F.concat(
        F.when(F.col("opening").isNotNull(), F.array("opening")).otherwise(none), F.coalesce("history", none))
    ).otherwise(none)
    rows = windows.withColumn("repeated", repeated).withColumn("all", F.concat("repeated", "turns"))
    piece = lambda t: F.concat(t["head"], t["body"], F.lit(_CLOSE))
    empty = F.array().cast("array<struct<start:int,length:int>>")

    def mask(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(t["head"])
        new = t["target"] & (t["pos"] >= F.col("first_turn"))
        span = F.array(F.struct(start.alias("start"), F.length(t["body"]).alias("length")))
        return F.struct((start + F.length(t["body"]) + len(_CLOSE)).alias("at"),
                        F.when(new, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    cost = F.aggregate("all", F.lit(0).cast("long"), lambda acc, t: acc + t["cost"])
    return rows.select(
        F.col("conv.id").alias("conv_id"), "first_turn", F.size("repeated").alias("n_repeated"),
        F.size("turns").alias("n_turns"), F.array_join(F.transform("all", piece), "").alias("text"),
        F.aggregate("all", F.struct(F.lit(0).alias("at"), empty.alias("spans")), mask)["spans"].alias("loss"),
        cost.alias("cost"), (cost > budget).alias("over_budget"))


def format_chats(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY,
                 long_turns: int = LONG_TURNS) -> DataFrame:
    """A row per window: conv_id, first_turn (the window's first own turn, from
    1), n_repeated, n_turns (own ones), text, loss (spans of code points, from
    0), cost and over_budget."""
    turns = _turns(conversations)
    long = settled(turns.groupBy("conv").count().filter(F.col("count") > long_turns).select("conv"))
    if long.isEmpty():
        return _written(_with_repeats(_windows(turns, _plain, budget, history)), budget)
    hint = broadcast_if_small(long)
    short = _written(_with_repeats(_windows(turns.join(hint, "conv", "left_anti"), _plain, budget, history)), budget)
    rows = ranged(turns.join(hint, "conv", "left_semi"), "conv", [F.asc_nulls_first("turn"), F.col("tie")])
    return short.unionByName(
        _written(_with_repeats_by_window(_windows(rows, _over_ranges, budget, history)), budget))


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars),
    read from the texts and masks. A digest needs its conversation in one value
    (2 GB at most); the windows themselves do not."""
    own = lambda group: F.slice(F.regexp_extract_all("text", F.lit(_TURN), group),
                                F.col("n_repeated") + 1, F.greatest(F.col("n_turns"), F.lit(0)))
    line = lambda role, text: F.concat(unescaped(role), F.lit("\n"), unescaped(text), F.lit("\n"))
    target = lambda s: unescaped(F.substring("text", s["start"] + 1, s["length"]))
    read = windows.select(
        "conv_id", "first_turn", F.size(own(1)).alias("n"), F.length("text").alias("chars"),
        F.array_join(F.zip_with(own(1), own(2), line), "").alias("turns"),
        F.array_join(F.transform("loss", target), "").alias("loss"))
    whole = lambda name: F.array_join(F.transform("parts", lambda p: p[name]), "")
    return read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("first_turn", "turns", "loss"))).alias("parts"),
    ).select(
        "conv_id", "n_turns", F.sha2(whole("turns"), 256).alias("turns_sha256"),
        F.length(whole("loss")).cast("long").alias("loss_chars"), F.sha2(whole("loss"), 256).alias("loss_sha256"),
        "formatted_chars")
