"""Mix sources to target weights, block by block.

The words of a source, document after document in a hashed order, are cut into
blocks of fixed length. Each output shard draws how many of its slots each
source fills: multinomial counts under the condition that each source's slots
add up to its target (drawn down a binary tree over the shards, so any shard is
drawn on its own). A source's slots run through pseudorandom permutations of its
block indices, one for each time around, and slots and blocks meet in a join by
index. Every block is taken at most twice, hence so is every document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellmend.llm.common import map_arrow, settled
from cellmend.llm.text_arrays import mix, word_limits
from cellmend.operators.ordering import running_total

BLOCK_WORDS = 64
SHARD_SLOTS = 1024
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = 17
#: An id of each input row, for rows that have none or share one.
ROW = "_row"


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """``share`` of all sizes by weight; no target above ``most`` times its size."""
    left, open_ = share * sum(sizes), list(range(len(sizes)))
    out = [0.0] * len(sizes)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Where a keyed permutation of 0 .. size - 1 takes each index (a Feistel
    network over an even number of bits, walked until it is back in range)."""
    half = max(1, (int(max(1, size - 1)).bit_length() + 1) // 2)
    mask, keys = np.uint64((1 << half) - 1), mix(np.arange(4, dtype=np.uint64) + np.uint64(key << 8))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


def place_of(block: int, size: int, key: int) -> int:
    """The index that the keyed permutation takes to ``block``: the network run backwards."""
    half = max(1, (int(max(1, size - 1)).bit_length() + 1) // 2)
    mask, keys = np.uint64((1 << half) - 1), mix(np.arange(4, dtype=np.uint64) + np.uint64(key << 8))
    out = np.array([block], np.uint64)
    while True:
        left, right = out >> np.uint64(half), out & mask
        for k in keys[::-1]:
            left, right = right ^ (mix(left + k) & mask), left
        out = (left << np.uint64(half)) | right
        if out[0] < size:
            return int(out[0])


@dataclass
class Plan:
    """What each source gives: one entry per source, in order."""
    sizes: np.ndarray
    slots: np.ndarray    # blocks it fills
    blocks: np.ndarray   # blocks it has
    last: np.ndarray     # words that its last slot takes
    seed: int

    @classmethod
    def of(cls, sizes: list[int], target: list[float], seed: int) -> Plan:
        slots, blocks, last = [], [], []
        for rank, (size, wanted) in enumerate(zip(sizes, target)):
            n, words = -(-size // BLOCK_WORDS), min(round(wanted), int(MOST * size))
            rounds, rest = divmod(words, size) if size else (0, 0)
            short = size - (n - 1) * BLOCK_WORDS if n else 0
            k = -(-rest // BLOCK_WORDS)
            taken = k * BLOCK_WORDS
            if k:
                early = place_of(n - 1, n, cls.key(seed, rank, rounds)) < k
                if early:  # the short block is among the slots
                    taken -= BLOCK_WORDS - short
                    if taken < rest:
                        k, taken = k + 1, taken + BLOCK_WORDS
            slots.append(rounds * n + k)
            blocks.append(n)
            last.append(BLOCK_WORDS - (taken - rest) if k else BLOCK_WORDS)
        as_array = lambda x: np.array(x, np.int64)
        return cls(as_array(sizes), as_array(slots), as_array(blocks), as_array(last), seed)

    @staticmethod
    def key(seed: int, rank: int, around: int) -> int:
        return (seed << 40) ^ (rank << 8) ^ around


def _drawn(counts: np.ndarray, take: int, rng: np.random.Generator) -> np.ndarray:
    """How many of ``take`` slots fall to each source, without replacement."""
    out, left, total = np.zeros(len(counts), np.int64), take, int(counts.sum())
    for i, own in enumerate(counts.tolist()):
        rest = total - own
        low, high = max(0, left - rest), min(own, left)
        if low == high:
            n = low
        elif total < 10**9:
            n = int(rng.hypergeometric(own, rest, left))
        else:  # beyond the generator's range its normal limit is exact enough
            p = own / total
            sd = np.sqrt(left * p * (1 - p) * (total - left) / (total - 1))
            n = int(np.clip(round(rng.normal(left * p, sd)), low, high))
        out[i], left, total = n, left - n, rest
    return out


class Shards:
    """The source counts of any shard, and how many slots of each source come before."""

    def __init__(self, plan: Plan):
        self.plan, self.known = plan, {}
        self.total = int(plan.slots.sum())
        self.n = -(-self.total // SHARD_SLOTS)

    def counts(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = 0, self.n
        own, before = self.plan.slots, np.zeros_like(self.plan.slots)
        while high - low > 1:
            middle = (low + high) // 2
            if (low, high) not in self.known:
                if len(self.known) > 4096:
                    self.known.clear()
                rng = np.random.default_rng([self.plan.seed, low, high])
                self.known[low, high] = _drawn(own, (middle - low) * SHARD_SLOTS, rng)
            left = self.known[low, high]
            if shard < middle:
                own, high = left, middle
            else:
                own, before, low = own - left, before + left, middle
        return own, before


def _slot_rows(plan: Plan):
    def rows(batches):
        shards = Shards(plan)
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                own, before = shards.counts(shard)
                rank = np.repeat(np.arange(len(own)), own)
                at = np.concatenate([np.arange(b, b + n) for b, n in zip(before, own)])
                block, words = np.zeros(len(at), np.int64), np.full(len(at), BLOCK_WORDS, np.int64)
                around = at // np.maximum(plan.blocks[rank], 1)
                for r in np.unique(rank):
                    for turn in np.unique(around[rank == r]):
                        mine = (rank == r) & (around == turn)
                        block[mine] = permuted(at[mine] - turn * plan.blocks[r], int(plan.blocks[r]),
                                               Plan.key(plan.seed, int(r), int(turn)))
                words[at == plan.slots[rank] - 1] = plan.last[rank[at == plan.slots[rank] - 1]]
                place = np.random.default_rng([plan.seed, shard]).permutation(len(at))
                yield {"shard": np.full(len(at), shard), "slot": place, "rank": rank, "block": block,
                       "around": around, "words": words}
    return rows


def _sizes(batches):
    for batch in batches:
        n = np.zeros(batch.num_rows, np.int64)
        for rows, first, _ in word_limits(batch.column("text")):
            n[rows] = np.diff(first)
        yield {ROW: batch.column(ROW), "doc_id": batch.column("doc_id"), "source": batch.column("source"), "size": n}


@dataclass
class Mix:
    """``documents``: _row, doc_id, source, size, source_size, target, rank, start;
    ``slots``: shard, slot, rank, block, around, words;
    ``blocks``: the documents' parts of each block. Slots and blocks both grow
    with the corpus and Spark cannot tell how many there will be, hence the hint
    to sort both and never to broadcast one."""
    documents: DataFrame
    slots: DataFrame
    blocks: DataFrame

    def spans(self) -> DataFrame:
        """The mix itself: ``shard, slot, at, _row, doc_id, source, size,
        first_word, n_words, around``; ``at`` is the place of the words within
        the slot, ``_row`` tells rows apart that have no id or the same one."""
        return (self.blocks.hint("merge").join(self.slots.hint("merge"), ["rank", "block"])
                .withColumn("n_words", F.least("to", "words") - F.col("at")).filter("n_words > 0")
                .select("shard", "slot", "at", ROW, "doc_id", "source", "size", "first_word", "n_words", "around"))

    def taken(self) -> DataFrame:
        """``doc_id, size, source_size, target, taken`` for every row of the input."""
        met = self.blocks.hint("merge").join(self.slots.hint("merge"), ["rank", "block"], "left")
        words = F.greatest(F.least("to", F.coalesce("words", F.lit(0))) - F.col("at"), F.lit(0))
        counted = met.groupBy("rank", "start", "doc_id").agg(
            F.sum(words).alias("taken"))
        filled = self.documents.filter("size > 0").alias("d").join(
            counted.select("rank", "start", "taken"), ["rank", "start"])
        empty = self.documents.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
        columns = ["doc_id", "size", "source_size", "target", "taken"]
        return filled.select(*columns).unionByName(empty.select(*columns))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                seed: int = SEED, row: str | None = None) -> Mix:
    """Plan and deal a mix of all ``docs`` by ``source``.

    Sources in the order of their code points, null last, get ``weights`` in
    turn and share ``share`` times all words by weight; no target exceeds twice
    its source. There is one row per source on the driver.

    A null text has size 0 and nothing is taken from it. Rows that repeat a
    document are documents of their own, as are those without ``doc_id``. Other
    columns are not read, but for the one that ``row`` names: an id of each row
    that the caller has settled. An empty table, or one without words, gives an empty mix. Reruns
    give the same mix.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    own = F.col(f"`{row}`") if row else F.monotonically_increasing_id()
    docs = docs.select(own.alias(ROW), "doc_id", "source", "text")
    sized = settled(map_arrow(docs.select(ROW, "doc_id", "source", "text"), _sizes,
                              f"{ROW} long, doc_id {kind}, source string, size long"))
    found = sized.groupBy("source").agg(F.sum("size").alias("size")).orderBy(
        F.asc_nulls_last("source")).collect()
    sizes = [row["size"] for row in found]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share)
    plan = Plan.of(sizes, wanted, seed)
    base = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).tolist()
    table = spark.createDataFrame(
        [(row["source"], i, base[i], sizes[i], float(wanted[i])) for i, row in enumerate(found)],
        "source string, rank long, base long, source_size long, target double")
    ranked = sized.withColumnRenamed("source", "_source").join(
        F.broadcast(table), F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
    order = [F.col("rank"), F.xxhash64(F.lit(seed), F.col("doc_id")), F.col("doc_id"), F.col("size"), F.col(ROW)]
    documents = settled(
        running_total(ranked, order, F.col("size"), "end")
        .withColumn("start", F.col("end") - F.col("size") - F.col("base"))
        .select(ROW, "doc_id", "source", "size", "source_size", "target", "rank", "start"))
    stop = F.col("start") + F.col("size")
    of_block = F.col("block") * BLOCK_WORDS
    blocks = (
        documents.filter("size > 0")
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / BLOCK_WORDS),
                                                  F.floor((stop - 1) / BLOCK_WORDS))))
        .select("rank", "block", ROW, "doc_id", "source", "size", "start",
                (F.greatest("start", of_block) - of_block).alias("at"),
                (F.least(stop, of_block + BLOCK_WORDS) - of_block).alias("to"),
                (F.greatest("start", of_block) - F.col("start")).alias("first_word")))
    shards = Shards(plan).n
    slots = map_arrow(
        spark.range(0, shards, 1, max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))),
        _slot_rows(plan), "shard long, slot long, rank long, block long, around long, words long")
    return Mix(documents, slots, blocks)


def _rebuilt(batches):
    """Texts cut to their taken words, each time around behind the other."""
    for batch in batches:
        texts = [""] * batch.num_rows
        spans = batch.column("spans").to_pylist()
        for rows, first, (data, starts) in word_limits(batch.column("text")):
            for i, row in enumerate(rows):
                limits = np.append(starts[first[i]:first[i + 1]], data[1][i + 1])
                parts, turn = [], None
                for span in spans[row]:
                    a, b = limits[span["first_word"]], limits[span["first_word"] + span["n_words"]]
                    if turn is not None and span["around"] != turn and parts and not parts[-1].endswith(b"\n"):
                        parts.append(b"\n")
                    turn = span["around"]
                    parts.append(data[0][a:b].tobytes())
                texts[row] = b"".join(parts).decode()
        out = {name: batch.column(name) for name in batch.schema.names if name not in ("text", "spans")}
        yield out | {"text": pa.array(texts, pa.string())}


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: each with the words that the mix takes, what is
    taken a second time once more behind the rest; documents of which nothing is
    taken are left out. Columns as in ``docs``, ``n_chars`` counted anew.

    Rows that have no ``doc_id``, or the same one, are documents of their own:
    each row gets an id that is settled with its text. Null sources are a source
    of their own.
    """
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = settled(docs.select(F.monotonically_increasing_id().alias(ROW), "doc_id", "text", "lang", "source"))
    mix_ = mix_sources(rows, row=ROW, **options)
    spans = mix_.spans().groupBy(ROW).agg(
        F.sort_array(F.collect_list(F.struct("around", "first_word", "n_words"))).alias("spans"))
    joined = rows.join(spans, ROW)
    kinds = dict(docs.dtypes)
    built = map_arrow(joined.select("doc_id", "lang", "source", "spans", "text"), _rebuilt,
                      f"doc_id {kinds['doc_id']}, lang string, source string, text string")
    return built.withColumn("n_chars", F.length("text").cast("long")).select(*columns)
