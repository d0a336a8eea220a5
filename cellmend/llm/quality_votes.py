"""Text quality by the votes of the nearest labelled texts.

Texts become vectors of a latent-semantic space: hashed terms (word shapes,
word beginnings, repetition), weighted by their rarity and projected on the
leading singular vectors of the labelled sample. The labelled vectors are
broadcast; the cosines of every document with all of them are computed in
blocks, and the nearest ones vote with their similarity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellmend.llm.common import crc_of_id, map_arrow, pack, unpack
from cellmend.llm.text_arrays import span_hashes, words_of

#: Labelled texts that vote: the bound of what is broadcast (with DIMS floats each).
MOST_LABELLED = 4000
TERMS = 1024
DIMS = 48
NEIGHBOURS = 25
#: (terms, weight) of word beginnings, word shapes and repetition: how a text is
#: made says more about its quality than what it is about.
GROUPS = ((768, 1.0), (240, 2.0), (16, 6.0))
POWER = 4
_BLOCK = 512

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = ord("a")
_SHAPE[48:58] = ord("9")


def term_counts(column: pa.Array):
    """(rows, texts x TERMS counts): hashed terms of each text.

    A word gives its shape (letters and digits as one sign each, runs of a sign
    shortened), its beginning, and, if it repeats one of the two words before
    it, a sign of that.
    """
    for words in words_of(column, lower=True):
        n, owners, h = len(words.hashes), words.owners, words.hashes
        shape = _SHAPE[words.data]
        fresh = np.ones(len(shape), bool)
        fresh[1:] = shape[1:] != shape[:-1]
        fresh[words.starts] = True
        kept = np.concatenate([[0], np.cumsum(fresh)])
        shapes = span_hashes(shape[fresh], kept[words.starts], kept[words.ends])
        heads = span_hashes(words.data, words.starts, np.minimum(words.ends, words.starts + 3))
        (n_heads, _), (n_shapes, _), _ = GROUPS
        terms = [(heads % np.uint64(n_heads)).astype(np.int64),
                 n_heads + (shapes % np.uint64(n_shapes)).astype(np.int64)]
        of = [owners, owners]
        for back in (1, 2):
            same = np.zeros(n, bool)
            same[back:] = (h[back:] == h[:-back]) & (owners[back:] == owners[:-back])
            terms.append(np.full(int(same.sum()), n_heads + n_shapes + back))
            of.append(owners[same])
        cell = np.concatenate(of) * TERMS + np.concatenate(terms)
        yield words.rows, np.bincount(cell, minlength=len(words.rows) * TERMS).reshape(-1, TERMS)


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


@dataclass
class Space:
    rarity: np.ndarray    # TERMS
    axes: np.ndarray      # TERMS x dims
    vectors: np.ndarray   # labelled texts x dims, of length 1
    labels: np.ndarray
    base: float           # share of good texts: the score of a text like no other

    @classmethod
    def fit(cls, counts: np.ndarray, labels: np.ndarray) -> Space:
        if not len(labels):
            return cls(np.ones(TERMS), np.zeros((TERMS, 1)), np.zeros((0, 1)), labels, 0.5)
        rarity = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 0.1
        rarity *= np.repeat([w for _, w in GROUPS], [n for n, _ in GROUPS])
        x = cls._weighted(counts, rarity)
        _, axes = np.linalg.eigh(x.T @ x)
        axes = axes[:, ::-1][:, :DIMS]
        return cls(rarity, axes, _unit(x @ axes).astype(np.float32), labels, float(labels.mean()))

    @staticmethod
    def _weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * rarity)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.base)
        if not len(self.labels):
            return out
        x = _unit(self._weighted(counts, self.rarity) @ self.axes).astype(np.float32)
        k = min(NEIGHBOURS, len(self.labels))
        for i in range(0, len(x), _BLOCK):
            cosine = x[i:i + _BLOCK] @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(float) ** POWER
            total = weight.sum(axis=1)
            votes = (weight * self.labels[near]).sum(axis=1)
            out[i:i + _BLOCK] = np.where(total > 0, votes / np.where(total > 0, total, 1), self.base)
        return np.clip(out, 0, 1)


def train(docs: DataFrame, labels: DataFrame, held_out: F.Column) -> Space:
    """Fit on a bounded sample of labelled rows, drawn by a hash of the id from
    those that are not held out."""
    drawn = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).filter(~held_out)
             .groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED))

    def rows(batches):
        for batch in batches:
            packed = [b""] * batch.num_rows
            for at, counts in term_counts(batch.column("text")):
                for row, own in zip(at, counts):
                    packed[row] = pack(own.astype(np.uint32))
            yield {"quality": batch.column("quality"), "counts": pa.array(packed, pa.binary())}

    # One text per id drawn, however many rows repeat it.
    sample = (docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
              .groupBy("doc_id", "quality").agg(F.min("text").alias("text")).select("quality", "text"))
    table = map_arrow(sample, rows, "quality int, counts binary").toArrow()
    counts = unpack(table["counts"], np.uint32).reshape(-1, TERMS).astype(np.float64)
    return Space.fit(counts, table["quality"].to_numpy().astype(float))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    Labels are learned only where crc32 of the id is not 0 modulo 5; labels,
    language, source and id never enter a score. Every whole text is scored.

    Null and empty texts, which are near no other, get the share of good texts
    in the sample. A null ``doc_id`` is scored and counts as not held out;
    labels other than 0 and 1 are not used. Without labels every score is 0.5.
    Repeated rows are scored alike; other columns are not read. An empty table
    gives an empty result.
    """
    out = F.coalesce(F.pmod(crc_of_id(), F.lit(5)) == 0, F.lit(False))
    space = docs.sparkSession.sparkContext.broadcast(train(docs, labels, out))

    def score(batches):
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for rows, counts in term_counts(batch.column("text")):
                for i in range(0, len(rows), _BLOCK):
                    scores[rows[i:i + _BLOCK]] = space.value.scores(counts[i:i + _BLOCK])
            yield {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": scores}

    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(docs.select("doc_id", out.alias("held_out"), "text"), score,
                     f"doc_id {kind}, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
