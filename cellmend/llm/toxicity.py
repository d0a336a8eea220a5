"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier in NumPy is trained on confirmed toxic texts and on texts of
unknown label. Its risk puts the class prior in the place of the missing
negatives, and the part that stands for them is never let below zero, so the
classifier cannot win by pushing down unlabelled toxic texts without end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellmend.llm.common import crc_of_id, map_arrow, pack
from cellmend.llm.text_arrays import LOWER, span_hashes, text_runs

#: The training sample's bounds: confirmed toxic texts, unlabelled texts.
MOST_POSITIVE = 3000
MOST_UNLABELLED = 6000
FEATURES = 1024
#: Features are hashed to so many bits: four bytes each in the sample.
FEATURE_BITS = 22
#: Least share of the toxic texts that a feature occurs in.
LEAST_RATE = 0.01
_PREFIXES = (4, 5, 6)
_SKETCH = 48
_STEPS, _RATE, _DECAY = 300, 0.05, 1e-4
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


def text_features(column: pa.Array):
    """(rows, hashed features, their texts): each run of letters and its first
    letters, lower-cased, run of texts by run of texts."""
    for rows, data, at in text_runs(column):
        data = LOWER[data]
        letter = _LETTER[data]
        edge = np.ones(len(data) + 1, bool)
        np.not_equal(letter[1:], letter[:-1], out=edge[1:-1])
        edge[at] = True
        places = np.flatnonzero(edge)
        real = letter[places[:-1]] if len(data) else np.zeros(0, bool)
        starts, ends = places[:-1][real], places[1:][real]
        owner = np.searchsorted(at, starts, "right") - 1
        hashes, owners = [span_hashes(data, starts, ends)], [owner]
        for n in _PREFIXES:
            long = ends - starts > n
            hashes.append(span_hashes(data, starts[long], starts[long] + n) + np.uint64(n))
            owners.append(owner[long])
        keys = (np.concatenate(hashes) >> np.uint64(64 - FEATURE_BITS)).astype(np.uint32)
        yield rows, keys, np.concatenate(owners)


@dataclass
class Model:
    keys: np.ndarray     # hashed features in order
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        for rows, hashes, owners in text_features(column):
            total = np.full(len(rows), self.bias)
            if len(self.keys):
                place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
                hit = self.keys[place] == hashes
                found = np.unique(owners[hit] * len(self.keys) + place[hit])
                np.add.at(total, found // len(self.keys), self.weights[found % len(self.keys)])
            out[rows] = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return out


def non_negative_risk(f: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The risk of scores ``f`` and its gradient.

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]), l the logistic
    loss. Where the second part is below zero, its gradient is turned round, as
    the method has it.
    """
    p, u = positive, ~positive
    n_p, n_u = max(1, p.sum()), max(1, u.sum())
    loss = lambda x: np.logaddexp(0, -x)
    rest = loss(-f[u]).sum() / n_u - prior * loss(-f[p]).sum() / n_p
    risk = prior * loss(f[p]).sum() / n_p + max(0.0, rest)
    s = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
    gradient = np.zeros(len(f))
    if rest >= 0:
        gradient[p] = prior * ((s[p] - 1) - s[p]) / n_p
        gradient[u] = s[u] / n_u
    else:
        gradient[p] = prior * s[p] / n_p
        gradient[u] = -s[u] / n_u
    return risk, gradient


def distinct_texts(rows: list[np.ndarray]) -> np.ndarray:
    """Which texts do not nearly repeat an earlier one of the sample: a group of
    copies would make each of its words a telling one. Texts are compared by
    their smallest feature hashes."""
    keep, seen = np.zeros(len(rows), bool), {}
    for i, row in enumerate(rows):
        sketch = row[:_SKETCH].tolist()
        met: dict[int, int] = {}
        for key in sketch:
            for other in seen.get(key, ()):
                met[other] = met.get(other, 0) + 1
        keep[i] = not sketch or max(met.values(), default=0) < 0.5 * len(sketch)
        if keep[i]:
            for key in sketch:
                seen.setdefault(key, []).append(i)
    return keep


def fit(rows: list[np.ndarray], positive: np.ndarray, prior: float) -> Model:
    """Train on each text's distinct features, in order; the most telling
    ``FEATURES`` of them are kept."""
    keep = np.zeros(len(rows), bool)
    for side in (positive, ~positive):
        at = np.flatnonzero(side)
        keep[at] = distinct_texts([rows[i] for i in at])
    rows, positive = [r for r, k in zip(rows, keep) if k], positive[keep]
    if not len(rows) or not positive.any() or positive.all():
        return Model(np.zeros(0, np.uint32), np.zeros(0), float(np.log(prior / (1 - prior))))
    in_p, in_u = np.zeros(1 << FEATURE_BITS, np.int32), np.zeros(1 << FEATURE_BITS, np.int32)
    for row, confirmed in zip(rows, positive):
        (in_p if confirmed else in_u)[row] += 1  # a text's features are distinct
    # A telling feature is about as much more frequent here as the prior allows.
    often = np.flatnonzero(in_p >= max(4, LEAST_RATE * positive.sum()))
    rate_p, rate_u = in_p[often] / positive.sum(), (in_u[often] + 1) / ((~positive).sum() + 1)
    gain = np.where(rate_p / rate_u >= 0.4 / prior, rate_p * np.log(rate_p / rate_u), -np.inf)
    best = np.sort(np.argsort(-gain, kind="stable")[:FEATURES])
    best = often[best[gain[best] > 0]]
    x = np.zeros((len(rows), len(best)), np.float32)
    for i, row in enumerate(rows):
        x[i] = np.isin(best, row, assume_unique=True)
    w, b = np.zeros(len(best)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(best) + 1), np.zeros(len(best) + 1)
    for step in range(1, _STEPS + 1):
        _, g = non_negative_risk(x @ w.astype(np.float32) + b, positive, prior)
        g = np.append(x.T @ g.astype(np.float32) + _DECAY * w, g.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        change = _RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - change[:-1], b - change[-1]
    return Model(best.astype(np.uint32), w, b)


def _feature_rows(batches):
    for batch in batches:
        packed = [b""] * batch.num_rows
        for rows, hashes, owners in text_features(batch.column("text")):
            order = np.argsort(owners, kind="stable")
            limits = np.searchsorted(owners[order], np.arange(len(rows) + 1))
            for i, row in enumerate(rows):
                packed[row] = pack(np.unique(hashes[order[limits[i]:limits[i + 1]]]))
        yield {"positive": batch.column("positive"), "features": pa.array(packed, pa.binary())}


def train(docs: DataFrame, labels: DataFrame, held_out: F.Column) -> Model:
    """Fit on a bounded sample, drawn by a hash of the id from rows that are not
    held out: toxic by label, and of unknown label (labels not looked at)."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).filter(~held_out)
    prior = usable.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    prior = min(max(prior or 0.01, 0.001), 0.9)
    drawn = lambda rows, n: rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    positive = drawn(usable.filter("toxic = 1"), MOST_POSITIVE).withColumn("positive", F.lit(True))
    unlabelled = drawn(docs.filter(F.col("doc_id").isNotNull()).filter(~held_out),
                       MOST_UNLABELLED).withColumn("positive", F.lit(False))
    # One text per id drawn, however many rows repeat it.
    sample = (docs.select("doc_id", "text").join(F.broadcast(positive.union(unlabelled)), "doc_id")
              .groupBy("doc_id", "positive").agg(F.min("text").alias("text")))
    table = map_arrow(sample.select("doc_id", "positive", "text"), _feature_rows,
                      "positive boolean, features binary").toArrow()
    rows = [np.frombuffer(x.as_buffer(), np.uint32) for x in table["features"]]
    return fit(rows, table["positive"].to_numpy().astype(bool), prior)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    Labels are learned only where crc32 of the id is not 1 modulo 3; labels,
    language, source and id never enter a score. The model is a bounded number
    of weights and is broadcast; every whole text is scored.

    Null and empty texts get the classifier's score of a text without words. A
    null ``doc_id`` is scored and counts as not held out; labels that are null
    or of unknown ids are not used. Without labels every score is a constant.
    Repeated rows are scored alike; other columns are not read. An empty table
    gives an empty result.
    """
    out = F.coalesce(F.pmod(crc_of_id(), F.lit(3)) == 1, F.lit(False))
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, out))

    def score(batches):
        for batch in batches:
            yield {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                   "score": model.value.scores(batch.column("text"))}

    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(docs.select("doc_id", out.alias("held_out"), "text"), score,
                     f"doc_id {kind}, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; all columns
    pass unchanged and no row is shuffled. Cases as in ``score_toxicity``."""
    out = F.coalesce(F.pmod(crc_of_id(), F.lit(3)) == 1, F.lit(False))
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, out))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.value.scores(texts))

    # Only texts go to Python and only scores come back; the rows stay where they are.
    return docs.filter(score("text") < threshold)
