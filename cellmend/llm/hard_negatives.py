"""Hard negatives of anchor vectors by a vertical scan (BOND).

Vectors lie in blocks, one array per dimension. For an anchor, a block's
dimensions are read in the order of the anchor's descending magnitudes; what the
dimensions not yet read can still add lies between sums of products with each
dimension's least and greatest component. Rows whose interval misses what is
looked for leave the candidate bitmap; who stays to the last dimension has its
exact score. A first scan finds each anchor's best rows of its own label, a
second one fills, for each of them, a window of scores with rows of other labels.

Anchors are a stated query set: blocks of anchors meet blocks of vectors, a task
keeps a few best rows per anchor of everything it reads, and those are merged by
Spark. Nothing is gathered per label or per id.

Cases: rows with a null id, label or vector, or with a null or non-finite
component, take no part. Rows that repeat an id are rows of their own; only the
anchor's own row is left out of its search. Ties go to the smaller id. Of
vectors that differ in length the common dimensions count; components beyond
``2 ** 31 / sqrt(length)`` count as that much, so that scores fit a long. No
anchor, no row of the same label, or a window without rows gives no rows. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from cellmend.llm.common import map_arrow, pack, settled

#: Rows of a block of vectors, and of one of anchors.
BLOCK_ROWS, ANCHOR_ROWS = 4096, 256
#: Blocks that a task reads: beyond so many, more tasks.
TASK_BLOCKS, TASK_ANCHOR_BLOCKS = 64, 512
#: Steps in which the dimensions are read.
STEPS = 8
_EXACT = float(1 << 53)
_DTYPES = ("int16", "int32", "int64")


def _columns(lists: pa.Array) -> np.ndarray:
    """Components by dimension, as whole numbers; short vectors end in zeros."""
    lengths = np.array([len(x) for x in lists], np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    most = np.floor((1 << 31) / np.sqrt(np.maximum(np.repeat(lengths, lengths), 1)))
    whole = np.clip(np.floor(256 * values), -most, most).astype(np.int64)
    out = np.zeros((lengths.max(initial=0), len(lengths)), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[np.arange(len(whole)) - np.repeat(np.cumsum(lengths) - lengths, lengths), row] = whole
    return out


def _packed(x: np.ndarray) -> tuple[int, bytes]:
    size = int(np.abs(x).max(initial=0))
    kind = next(k for k, name in enumerate(_DTYPES) if size <= np.iinfo(name).max)
    return kind, pack(x.astype(_DTYPES[kind]))


def vector_blocks(vectors: DataFrame) -> DataFrame:
    """(block, n, kind, ids, labels, columns) of all rows that take part."""
    taking_part = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter(
        ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        made, held, rows = 0, [], 0

        def block() -> dict:
            ids, labels, lists = (pa.concat_arrays([b.column(k) for b in held]) for k in range(3))
            kind, columns = _packed(_columns(lists))
            return {"block": [(TaskContext.get().partitionId() << 32) + made], "n": [len(ids)], "kind": [kind],
                    "ids": [pack(ids.to_numpy())], "labels": [pack(labels.to_numpy())], "columns": [columns]}

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK_ROWS - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == BLOCK_ROWS:
                    yield block()
                    made, held, rows = made + 1, [], 0
        if rows:
            yield block()

    return map_arrow(taking_part, run, "block long, n long, kind long, ids binary, labels binary, columns binary")


class Block:
    """A block as a task holds it."""

    def __init__(self, row: dict):
        self.number, n = row["block"], row["n"]
        self.ids, self.labels = (np.frombuffer(row[k], np.int64) for k in ("ids", "labels"))
        x = np.frombuffer(row["columns"], _DTYPES[row["kind"]]).reshape(-1, n)
        self.exact = float(np.abs(x.astype(np.float64)).max(initial=0))
        self.x = x.astype(np.float64 if self.exact < 1 << 26 else np.int64)
        self.least, self.most = self.x.min(axis=1), self.x.max(axis=1)
        self.of = {label: np.flatnonzero(self.labels == label) for label in np.unique(self.labels)}
        self.others = {}

    def other(self, label: int) -> np.ndarray:
        if label not in self.others:
            self.others[label] = np.flatnonzero(self.labels != label)
        return self.others[label]


def scan(q: np.ndarray, block: Block, rows: np.ndarray, least: float, most: float,
         first: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, exact scores) of the candidates with scores in [least, most]; with
    ``first``, of those that may be among so many best ones."""
    dims = min(len(q), len(block.x))
    q = q[:dims]
    whole = float(np.abs(q).sum()) * block.exact >= _EXACT
    q = q.astype(np.int64) if whole else q.astype(np.float64)
    x = block.x[:dims].astype(np.int64) if whole else block.x[:dims]
    order = np.argsort(-np.abs(q), kind="stable")
    low, high = q * block.least[:dims].astype(q.dtype), q * block.most[:dims].astype(q.dtype)
    low, high = np.minimum(low, high)[order], np.maximum(low, high)[order]
    rest_low, rest_high = low.sum() - np.cumsum(low), high.sum() - np.cumsum(high)
    score = np.zeros(len(rows), q.dtype)
    step = max(1, -(-dims // STEPS))
    for start in range(0, dims, step):
        read = order[start:start + step]
        score = score + q[read] @ (x[read] if len(rows) == x.shape[1] else x[np.ix_(read, rows)])
        at = min(dims, start + step) - 1
        if first is not None and len(rows) > first:
            least = max(least, np.partition(score + rest_low[at], -first)[-first])
        stay = (score + rest_high[at] >= least) & (score + rest_low[at] <= most)
        if not stay.all():
            rows, score = rows[stay], score[stay]
        if not len(rows):
            break
    stay = (score >= least) & (score <= most)
    return rows[stay], score[stay].astype(np.int64)


def _best(held: list, ids: np.ndarray, scores: np.ndarray, n: int) -> list:
    """The first n of (-score, id), among those held and new ones."""
    first = np.lexsort((ids, -scores))[:n]
    return heapq.nsmallest(n, held + list(zip((-scores[first]).tolist(), ids[first].tolist())))


def _pairs(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each block of anchors with each block of vectors, whose order within a task
    keeps a block of anchors together."""
    return anchors.crossJoin(blocks)


def _in_tasks(blocks: DataFrame, most: int) -> DataFrame:
    """At most so many blocks a task, and no more tasks than that and the cluster need."""
    n = blocks.count()
    return blocks.coalesce(max(-(-n // most), blocks.sparkSession.sparkContext.defaultParallelism))


def anchor_blocks(blocks: DataFrame, every: int) -> DataFrame:
    """(a_block, anchors array of (number, block, row, vec_id, label, vector))."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                at = np.flatnonzero(block.ids % every == 0)
                if len(at):
                    yield {"block": [block.number] * len(at), "row": at.astype(np.int32), "vec_id": block.ids[at],
                           "label": block.labels[at],
                           "vector": [pack(block.x[:, i].astype(np.int64)) for i in at]}

    rows = settled(map_arrow(blocks, run, "block long, row int, vec_id long, label long, vector binary"))
    parts = max(1, -(-rows.count() // ANCHOR_ROWS))

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        made = 0
        for batch in batches:
            for start in range(0, batch.num_rows, ANCHOR_ROWS):
                part = batch.slice(start, ANCHOR_ROWS)
                yield {"a_block": [(TaskContext.get().partitionId() << 32) + made],
                       "anchors": pa.array([part.to_pylist()], pa.list_(pa.struct(part.schema)))}
                made += 1

    return settled(map_arrow(
        rows.repartition(parts), packs,
        "a_block long, anchors array<struct<block:long,row:int,vec_id:long,label:long,vector:binary>>",
        ["a_block", "anchors"]))


def _blocks_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, Block]]:
    kept = (None, None)
    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != kept[0]:
                kept = row["block"], Block(row)
            yield row, kept[1]


def positives(anchors: DataFrame, blocks: DataFrame, n: int) -> DataFrame:
    """(a_block, a_row, anchor_id, place, positive_id, positive_score): each
    anchor's first ``n`` other rows of its label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        best: dict[tuple[int, int], list] = {}
        names: dict[tuple[int, int], int] = {}
        for row, block in _blocks_of(batches):
            for k, a in enumerate(row["anchors"]):
                rows = block.of.get(a["label"])
                if rows is None:
                    continue
                if a["block"] == block.number:
                    rows = rows[rows != a["row"]]
                held = best.setdefault((row["a_block"], k), [])
                names[row["a_block"], k] = a["vec_id"]
                least = -held[-1][0] if len(held) == n else -np.inf
                rows, scores = scan(np.frombuffer(a["vector"], np.int64), block, rows, least, np.inf, n)
                best[row["a_block"], k] = _best(held, block.ids[rows], scores, n)
        found = [(*key, names[key], i, -s) for key, held in best.items() for s, i in held]
        if found:
            yield dict(zip(("a_block", "a_row", "anchor_id", "positive_id", "positive_score"), map(list, zip(*found))))

    found = map_arrow(_pairs(anchors, blocks), run,
                      "a_block long, a_row long, anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("a_block", "a_row").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def windows(anchors: DataFrame, blocks: DataFrame, found: DataFrame, n: int, low: int, high: int) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for each positive the first ``n`` rows of other labels whose scores are from
    ``low`` to ``high`` hundredths of its own."""
    # At most as many as an anchor block has anchors and positives.
    wanted = found.groupBy("a_block").agg(F.collect_list(F.struct(
        "a_row", "place", "positive_id", "positive_score")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        best: dict[tuple[int, int, int], list] = {}
        said: dict[tuple[int, int, int], tuple] = {}
        per_block: dict[int, dict[int, list]] = {}
        for row, block in _blocks_of(batches):
            by_anchor = per_block.get(row["a_block"])
            if by_anchor is None:
                by_anchor = per_block[row["a_block"]] = {}
                for w in row["wanted"]:
                    s = w["positive_score"]
                    least, most = -(-low * s // 100), high * s // 100
                    if least <= most:
                        key = (row["a_block"], w["a_row"], w["place"])
                        said[key] = (row["anchors"][w["a_row"]]["vec_id"], w["positive_id"], s)
                        best[key] = []
                        by_anchor.setdefault(w["a_row"], []).append((key, least, most))
            for k, asked in by_anchor.items():
                a = row["anchors"][k]
                asked = [(key, max(least, -best[key][-1][0]) if len(best[key]) == n else least, most)
                         for key, least, most in asked]
                rows, scores = scan(np.frombuffer(a["vector"], np.int64), block, block.other(a["label"]),
                                    min(x[1] for x in asked), max(x[2] for x in asked), None)
                if len(rows):
                    for key, least, most in asked:
                        fit = (scores >= least) & (scores <= most)
                        if fit.any():
                            best[key] = _best(best[key], block.ids[rows[fit]], scores[fit], n)
        out = [(*key, *said[key], i, -s) for key, held in best.items() for s, i in held]
        if out:
            yield dict(zip(("a_block", "a_row", "place", "anchor_id", "positive_id", "positive_score",
                            "negative_id", "negative_score"), map(list, zip(*out))))

    met = map_arrow(_pairs(anchors.join(wanted, "a_block"), blocks), run,
                    "a_block long, a_row long, place long, anchor_id long, positive_id long, positive_score long, "
                    "negative_id long, negative_score long")
    order = Window.partitionBy("a_block", "a_row", "place").orderBy(F.desc("negative_score"), "negative_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine_hard_negatives(vectors: DataFrame, every: int = 100, n: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """Hard negatives of all rows whose vec_id is divisible by ``every``."""
    blocks = settled(vector_blocks(vectors))
    anchors = _in_tasks(anchor_blocks(blocks, every), TASK_ANCHOR_BLOCKS)
    blocks = _in_tasks(blocks, TASK_BLOCKS)
    found = settled(positives(anchors, blocks, n))
    return windows(anchors, blocks, found, n, low, high)
