"""Prefix trie over conversations, rolled up in bands of depth.

A node is a distinct sequence of leading turns. Its key joins, by exclusive or,
one number per turn and place, so a key follows from a running value and a
parent's key from its child's. Values of subtrees are summed in bands: a node
explodes to its ancestors within its band only, at most ``BAND`` of them; the
nodes on band borders then form a trie of their own, a ``BAND``-th as deep, which
is rolled up in the same way, and its completed totals come back to the band
above each border. Rounds grow with the logarithm of the depth, and no row
explodes to more than ``BAND``.

Cases: rows without ``conv_id`` belong to no conversation and are left out; null
roles and texts are empty; a null turn comes first; rows of one turn are ordered
by the digest of role and text, and repeated rows are turns of their own. Empty
and very long texts are turns like any other: only digests and lengths travel.
A conversation may hold any share of the rows and have any depth. No
conversation at all gives no nodes. Extra columns are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cellmend.llm.common import map_arrow, settled
from cellmend.llm.scans import RANGE, ranged, scanned
from cellmend.operators.sizing import broadcast_if_small

#: Levels of one band.
BAND = 8
#: A conversation opens with up to ``_OPENING - 1`` turns of another one.
_OPENING = 9
#: Turns of one part of a conversation, and ids of one part of a list (2 ** 12).
_PART, _ID_BITS = 4096, 12
_KEY = ["k1", "k2"]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, g1, g2, bytes): digest and length stand for role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    number = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        number(1).alias("g1"), number(16).alias("g2"), F.octet_length(text).cast("long").alias("bytes"))


def _lane(n: int, g1: Column, g2: Column, depth: Column) -> Column:
    return F.xxhash64(F.lit(n), g1, g2, depth.cast("long"))


def rebuilt_turns(conversations: DataFrame, opening: bool = True) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, bytes, is_end): a row for each prefix of
    each conversation, the empty one included, with its own and its parent's key.

    With ``opening``, conversation c begins with the first h turns of c - c % 5
    in place of its own first h, h being the crc32 of its decimal id modulo 9.
    """
    by = [F.asc_nulls_first("turn"), F.col("g1"), F.col("g2")]
    turns = scanned(ranged(turn_rows(conversations), "conv_id", by), "conv_id", by,
                    {"pos": (F.lit(1), "sum")})
    turns = settled(turns.drop("turn"))
    heads = turns.groupBy("conv_id").agg(
        F.max("pos").alias("n_own"),
        F.sort_array(F.collect_list(F.when(F.col("pos") < _OPENING, F.struct("pos", "g1", "g2", "bytes")))
                     ).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string")) % _OPENING if opening else F.lit(0)
    convs = heads.select("conv_id", "n_own", h.cast("long").alias("h"),
                         (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    empty = F.array().cast(heads.schema["head"].dataType)
    convs = convs.join(heads.select(F.col("conv_id").alias("base"), "head"), "base", "left").withColumn(
        "first", F.slice(F.coalesce("head", empty), F.lit(1), F.col("h").cast("int")))
    start = F.array(F.struct(F.lit(0).cast("long").alias("d"), *[
        F.lit(0).cast("long").alias(n) for n in ("k1", "k2", "p1", "p2", "bytes")]))

    def longer(path: Column, x: Column) -> Column:
        last = F.element_at(path, -1)
        k = [last[f"k{n}"].bitwiseXOR(_lane(n, x["g1"], x["g2"], x["pos"])) for n in (1, 2)]
        return F.concat(path, F.array(F.struct(
            x["pos"].alias("d"), k[0].alias("k1"), k[1].alias("k2"),
            last["k1"].alias("p1"), last["k2"].alias("p2"), x["bytes"].alias("bytes"))))

    convs = settled(convs.select(
        "conv_id", "n_own", "h", F.size("first").cast("long").alias("n_first"),
        F.aggregate("first", start, longer).alias("opening")
    ).withColumn("n_turns", F.col("n_first") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))))
    opened = convs.select("conv_id", "n_turns", F.explode("opening").alias("o")).select(
        "conv_id", F.col("o.d").alias("depth"), "o.k1", "o.k2", "o.p1", "o.p2", "o.bytes",
        (F.col("o.d") == F.col("n_turns")).alias("is_end"))
    # One row per conversation and part of it, so that no key has many rows on the turns' side.
    part = lambda pos: F.shiftright(pos, 12)
    known = convs.filter("n_own > h").select(
        "conv_id", "h", "n_first", "n_turns", F.element_at("opening", -1).alias("from"),
        F.explode(F.sequence(F.lit(0).cast("long"), part(F.col("n_own")))).alias("part"))
    tails = turns.withColumn("part", part(F.col("pos"))).join(known, ["conv_id", "part"]).filter("pos > h")
    tails = tails.withColumn("depth", F.col("pos") - F.col("h") + F.col("n_first"))
    own = {n: _lane(n, F.col("g1"), F.col("g2"), F.col("depth")) for n in (1, 2)}
    tails = scanned(tails, "conv_id", [F.col("pos")], {f"x{n}": (own[n], "xor") for n in own})
    tails = tails.withColumns({f"k{n}": F.col(f"x{n}").bitwiseXOR(F.col(f"from.k{n}")) for n in own})
    return opened.unionByName(tails.select(
        "conv_id", "depth", *_KEY, *[F.col(f"k{n}").bitwiseXOR(own[n]).alias(f"p{n}") for n in own],
        "bytes", (F.col("depth") == F.col("n_turns")).alias("is_end")))


def _paths(rows: DataFrame, step: int) -> DataFrame:
    """``rows`` at depths divisible by ``step``, with the keys of those of their
    ancestors, from the border above them on, that are at such depths too."""
    border = step * BAND
    level = rows.filter(F.col("depth") % step == 0)
    band = F.floor((F.col("depth") - 1) / border)
    below = level.filter(F.col("depth") % border == 0).select(
        "conv_id", (F.col("depth") / border).cast("long").alias("band"), "depth", *_KEY,
        F.lit(True).alias("above"))
    both = level.withColumns({"band": band, "above": F.lit(False)}).unionByName(below, allowMissingColumns=True)
    before = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn("path", F.collect_list(F.struct(*_KEY)).over(before)).filter("NOT above").drop("band", "above")


def _rolled_up(rows: DataFrame, values: DataFrame, sums: list[str], step: int, deepest: int) -> DataFrame:
    """(k1, k2, *sums): for each node at a depth divisible by ``step``, the sums
    over such nodes below it. Nodes without any may be missing."""
    paths = settled(_paths(rows, step).filter("depth > 0").groupBy(*_KEY).agg(
        F.max("depth").alias("depth"), F.first("path").alias("path")))
    total = lambda df: df.groupBy(*_KEY).agg(*[F.sum(s).alias(s) for s in sums])

    def sent(df: DataFrame, path: Column) -> DataFrame:
        return df.select(F.explode(path).alias("to"), *sums).select("to.*", *sums)

    within = total(sent(paths.join(values, _KEY), F.col("path")))
    border = step * BAND
    if deepest <= border:
        return within
    within = settled(within)
    on_border = settled(rows.filter(F.col("depth") % border == 0).select(*_KEY).distinct())
    own = within.join(on_border, _KEY, "left_semi")
    below = _rolled_up(rows, own, sums, border, deepest)
    complete = settled(total(own.unionByName(below)))
    # A border's total goes to the band above it; the next border has it in its own total.
    back = sent(paths.filter(F.col("depth") % border == 0).join(complete, _KEY),
                F.slice("path", F.lit(2), F.lit(BAND)))
    return total(within.join(on_border, _KEY, "left_anti").unionByName(complete).unionByName(back))


def _hashed_lists(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of comma-joined ids, ascending. A list of any length
    passes in parts of bounded size, one behind the other."""
    parts = ends.withColumn("part", F.shiftright("conv_id", _ID_BITS)).groupBy(*_KEY, "part").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
        .alias("ids"))
    ordered = parts.repartition(*_KEY).sortWithinPartitions(*_KEY, "part").select(*_KEY, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        at, state = None, None
        for batch in batches:
            out: list[tuple[int, int, str]] = []
            for k1, k2, ids in zip(*[batch.column(n).to_pylist() for n in (*_KEY, "ids")]):
                if (k1, k2) == at:
                    state.update(b",")
                else:
                    if at:
                        out.append((*at, state.hexdigest()))
                    at, state = (k1, k2), hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield dict(zip((*_KEY, "ends_sha256"), map(list, zip(*out))))
        if at:
            yield {"k1": [at[0]], "k2": [at[1]], "ends_sha256": [state.hexdigest()]}

    return map_arrow(ordered, run, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, opening: bool = True) -> DataFrame:
    """A row per node: conv_id and depth (that conversation's first turns are the
    node's sequence), parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes that members share with the first of them, over the
    subtree) and ends_sha256 of the conversations that end here."""
    rows = settled(rebuilt_turns(conversations, opening))
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    nodes = settled(rows.groupBy(*_KEY).agg(
        F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.max("bytes").alias("bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2")))
    children = settled(nodes.filter("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children")))
    own = settled(nodes.join(children, _KEY, "left").select(
        *_KEY, F.col("n_children").isNull().cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")))
    sums = ["n_leaves", "saved_tokens"]
    below = _rolled_up(rows, own, sums, 1, deepest)
    totals = own.unionByName(below).groupBy(*_KEY).agg(*[F.sum(s).alias(s) for s in sums])
    ends = _hashed_lists(rows.filter("is_end").select(*_KEY, "conv_id"))
    # Parents with many children are few; the others' children fit a task.
    parents = nodes.join(children, _KEY).select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    many = broadcast_if_small(parents.filter(f"n_children > {_PART}").drop("n_children"))
    few = parents.filter(f"n_children <= {_PART}").drop("n_children")
    named = nodes.join(many.withColumnRenamed("parent_conv_id", "_many"), ["p1", "p2"], "left")
    named = (named.filter("_many IS NOT NULL").withColumnRenamed("_many", "parent_conv_id").unionByName(
        named.filter("_many IS NULL").drop("_many").join(few, ["p1", "p2"], "left")))
    return (named.join(children, _KEY, "left").join(totals, _KEY).join(ends, _KEY, "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
