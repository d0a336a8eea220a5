"""Pack documents into as few token sequences as possible: best-two-fit.

A sequence is filled greedily with the largest piece that fits. Then its
smallest piece is taken out if two pieces not yet packed fill the enlarged gap
more tightly. Which piece is taken depends on lengths only, so the packing is
worked out on the number of pieces of each length (no more numbers than a
sequence has tokens), however many documents there are; a step that can be
repeated is taken for all its sequences at once. Spark numbers the pieces of
each length and sends each to its place.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cellmend.llm.common import map_arrow, settled
from cellmend.llm.pretokens import Encoder

END_ID = 2
SEQUENCE_TOKENS = 1024


@dataclass
class Places:
    """Where the pieces of each length go. Entry i: pieces ``first[i]`` and on of
    its length fill ``uses[i]`` places in each of the sequences from
    ``sequence[i]`` on, the first at ``offset[i]``."""
    length: np.ndarray
    first: np.ndarray
    uses: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def _greedy(counts: np.ndarray, present: np.ndarray, size: int) -> dict[int, int]:
    """The lengths of one sequence, largest first; ``present`` is in order."""
    filled: dict[int, int] = {}
    room = size
    while room:
        at = np.searchsorted(present, room, "right") - 1
        while at >= 0 and filled.get(int(present[at]), 0) >= counts[present[at]]:
            at -= 1
        if at < 0:
            break
        length = int(present[at])
        take = min(room // length, int(counts[length]) - filled.get(length, 0))
        filled[length] = filled.get(length, 0) + take
        room -= take * length
    return filled


def _two_fit(filled: dict[int, int], counts: np.ndarray, present: np.ndarray, size: int) -> dict[int, int]:
    """Replace the smallest piece by the two that fill its gap most tightly."""
    room = size - sum(length * n for length, n in filled.items())
    smallest = min(filled)
    if not room or len(present) == 0:
        return filled
    gap = room + smallest
    left = counts[present] - np.array([filled.get(int(x), 0) for x in present])
    left[present == smallest] += 1
    lengths = present[left > 0]
    lengths, left = lengths[lengths < gap], left[left > 0][lengths < gap]
    if not len(lengths):
        return filled
    partner = np.searchsorted(lengths, gap - lengths, "right") - 1
    # The same length twice needs two pieces of it.
    twice = (partner == np.arange(len(lengths))) & (left < 2)
    partner = partner - twice
    sums = np.where(partner >= 0, lengths + lengths[np.maximum(partner, 0)], 0)
    best = int(np.argmax(sums))
    if sums[best] <= smallest:
        return filled
    changed = dict(filled)
    changed[smallest] -= 1
    for length in (int(lengths[best]), int(lengths[partner[best]])):
        changed[length] = changed.get(length, 0) + 1
    return {length: n for length, n in changed.items() if n}


def plan(counts: np.ndarray, size: int) -> Places:
    """``counts[length]`` pieces of each length up to ``size``."""
    counts, used = counts.copy(), np.zeros(len(counts), np.int64)
    rows, sequence = [], 0
    while True:
        present = np.flatnonzero(counts)
        if not len(present):
            break
        filled = _two_fit(_greedy(counts, present, size), counts, present, size)
        times = min(int(counts[length]) // n for length, n in filled.items())
        offset = 0
        for length, n in sorted(filled.items(), reverse=True):
            rows.append((length, used[length], n, sequence, offset))
            used[length] += n * times
            counts[length] -= n * times
            offset += n * length
        sequence += times
    table = np.array(rows, np.int64).reshape(-1, 5)
    return Places(*table[np.lexsort((table[:, 1], table[:, 0]))].T)


def cut_pieces(docs: DataFrame, tokenizer_path: str, size: int) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` for every document: its ids
    and the end id, cut only if longer than ``size``; the first piece is the
    shorter one."""
    def cut(batches):
        encoder = Encoder.of_worker(tokenizer_path, words=False)
        for batch in batches:
            for rows, flat, at in encoder.ids(batch.column("text")):
                total = np.diff(at) + 1
                pieces = (total + size - 1) // size
                owner = np.repeat(np.arange(len(rows)), pieces)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = (total - 1) % size + 1
                start = np.where(number == 0, 0, head[owner] + (number - 1) * size)
                length = np.where(number == 0, head[owner], size)
                crc = []
                for doc, s, n in zip(owner, start, length):
                    ids = flat[at[doc] + s:min(at[doc] + s + n, at[doc + 1])].astype("<u4").tobytes()
                    if s + n == total[doc]:
                        ids += END_ID.to_bytes(4, "little")
                    crc.append(zlib.crc32(ids))
                yield {"doc_id": batch.column("doc_id").take(pa.array(rows[owner])),
                       "piece": number.astype(np.int32), "start": start, "length": length,
                       "ids_crc32": np.array(crc, np.int64)}

    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(docs.select("doc_id", "text"), cut,
                     f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``; ``offset`` is its place in the sequence, gapless.

    A null or empty text is one piece that holds the end id only. Rows that
    repeat a ``doc_id``, or have none, are packed like any other. Other columns
    are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    pieces = settled(cut_pieces(docs, tokenizer_path, size)).withColumn("part", F.spark_partition_id())
    per_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = settled(per_part.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    counts = np.zeros(size + 1, np.int64)
    for row in starts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # ``size`` rows at most
        counts[row["length"]] = row["n"]
    places = spark.sparkContext.broadcast(plan(counts, size))
    # Within a part, pieces are numbered by content, so that a task run again
    # after a loss numbers them alike.
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (pieces.withColumn("within", F.row_number().over(inside) - 1)
              .join(starts.select("length", "part", "before"), ["length", "part"])
              .withColumn("rank", F.col("before") + F.col("within")))

    def place(batches):
        table = places.value
        key = table.length * (1 << 40) + table.first
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(key, length * (1 << 40) + rank, "right") - 1
            step = rank - table.first[at]
            out = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            yield out | {"sequence_id": table.sequence[at] + step // table.uses[at],
                         "offset": table.offset[at] + step % table.uses[at] * length}

    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(ranked, place, f"doc_id {kind}, piece int, start long, length long, "
                                    "ids_crc32 long, sequence_id long, offset long")
