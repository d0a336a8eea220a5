"""Near-duplicate vectors by cosine, with a subspace pigeonhole join.

Unit vectors with cosine c lie at squared distance 2 - 2c. They are rotated and
split into blocks of a few dimensions; a pair within the whole budget is within
a block's proportional share of it in at least one block. Each block is a range
join over the leaves of a k-d tree, and the union of candidates is verified on
the vectors as given. A pair counts in the first block that finds it, so no
block has to know what the others found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellmend.llm.common import buckets, components, map_arrow, pack, settled

BLOCK_DIMS = 8
#: Rows of one leaf of a block's tree, and of one part of a crowded leaf.
LEAF_ROWS = 2048
#: Vectors from which the splits of the trees are taken; the splits decide
#: where work is done, never what is found.
SPLIT_SAMPLE = 20_000
MAX_DEPTH = 12
_TILE = 1024
_PAIRS = 1 << 15


def rotation(dims: int) -> np.ndarray:
    """The same orthogonal matrix for all vectors of so many dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def blocks_of(dims: int) -> list[slice]:
    return [slice(i, min(dims, i + BLOCK_DIMS)) for i in range(0, dims, BLOCK_DIMS)]


def budgets(dims: int, threshold: float) -> list[float]:
    """Each block's share of the squared distance, a little more for rounding."""
    whole = (2 - 2 * threshold) * (1 + 1e-9) + 1e-12
    return [whole * (b.stop - b.start) / dims for b in blocks_of(dims)]


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rotated unit vectors; row by row, so that a row's result never depends
    on the rows beside it."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]
    return np.round(np.einsum("ij,kj->ik", unit, rotation(vectors.shape[1])), 10)


class Splits:
    """The k-d tree of one block: ``depth`` levels of median splits."""

    def __init__(self, sample: np.ndarray, depth: int):
        dims = sample.shape[1]
        leaves = [sample]
        self.low, self.high = np.full((1, dims), -np.inf), np.full((1, dims), np.inf)
        self.levels = []
        for _ in range(depth):
            axis = np.array([int(np.argmax(x.std(axis=0))) if len(x) else 0 for x in leaves])
            cut = np.array([float(np.median(x[:, a])) if len(x) else 0.0 for x, a in zip(leaves, axis)])
            self.levels.append((axis, cut))
            leaves = [part for x, a, c in zip(leaves, axis, cut)
                      for part in (x[x[:, a] < c], x[x[:, a] >= c])]
            self.low, self.high = np.repeat(self.low, 2, axis=0), np.repeat(self.high, 2, axis=0)
            at = np.arange(len(axis))
            self.high[2 * at, axis], self.low[2 * at + 1, axis] = cut, cut

    def home(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for axis, cut in self.levels:
            node = 2 * node + (x[np.arange(len(x)), axis[node]] >= cut[node])
        return node

    def reached(self, x: np.ndarray, home: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, leaves) for leaves before a row's own that lie within the budget."""
        rows, leaves = [], []
        for leaf in range(len(self.low)):
            gap = np.maximum(np.maximum(self.low[leaf] - x, x - self.high[leaf]), 0)
            hit = np.flatnonzero((leaf < home) & ((gap * gap).sum(axis=1) <= budget))
            rows.append(hit)
            leaves.append(np.full(len(hit), leaf))
        return np.concatenate(rows), np.concatenate(leaves)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, dims)


def _joined(ids, counts, vectors, homes, part, pair, block, threshold):
    """Links found by one part of a leaf: (ids, linked vectors), (a, b)."""
    dims = vectors.shape[1]
    turned, cuts, share = rotated(vectors), blocks_of(dims), budgets(dims, threshold)
    length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    here = turned[:, cuts[block]]
    square = (here * here).sum(axis=1)
    left = np.flatnonzero(part == pair[0])
    right = np.flatnonzero(part == pair[1])
    links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
    found = []

    def distance(a, b, c):
        total = np.zeros(len(a))
        for k in range(cuts[c].start, cuts[c].stop):
            total += (turned[a, k] - turned[b, k]) ** 2
        return total

    for i in range(0, len(left), _TILE):
        rows = left[i:i + _TILE]
        for j in range(0, len(right), _TILE):
            cols = right[j:j + _TILE]
            near = square[rows][:, None] + square[cols][None, :] - 2 * here[rows] @ here[cols].T
            a, b = np.nonzero(near <= share[block] + 1e-8)
            a, b = rows[a], cols[b]
            ok = (homes[a] | homes[b]) & ((a < b) if pair[0] == pair[1] else (a != b))
            a, b = a[ok], b[ok]
            for s in range(0, len(a), _PAIRS):
                x, y = a[s:s + _PAIRS], b[s:s + _PAIRS]
                first = distance(x, y, block) <= share[block]
                for c in range(block):
                    first &= distance(x, y, c) > share[c]
                x, y = x[first], y[first]
                cosine = np.einsum("ij,ij->i", vectors[x], vectors[y]) / (length[x] * length[y])
                x, y = x[cosine >= threshold], y[cosine >= threshold]
                np.add.at(links, x, counts[y])
                np.add.at(links, y, counts[x])
                found.append((x, y))
    if found:  # a spanning forest in place of the pairs
        x, y = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        while True:
            low = np.minimum(label[x], label[y])
            before = label.copy()
            np.minimum.at(label, x, low)
            np.minimum.at(label, y, low)
            label = label[label]
            if (label == before).all():
                break
    return links, label


def _leaf_job(dims: int, threshold: float):
    def work(batch: pa.Table) -> pa.Table:
        key = np.stack([batch[c].to_numpy() for c in ("label", "block", "leaf", "part_a", "part_b")])
        order = np.lexsort((batch["id"].to_numpy(), *key[::-1]))
        key = key[:, order]
        limits = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0), True])
        ids, n, low = [], [], []
        for i, j in zip(limits[:-1], limits[1:]):
            if j - i < 2:
                continue
            part = batch.take(pa.array(order[i:j]))
            own = part["id"].to_numpy()
            v = np.concatenate([np.frombuffer(x.as_buffer(), np.float64) for x in part["vector"]])
            found, label = _joined(
                own, part["copies"].to_numpy(), v.reshape(-1, dims),
                part["home"].to_numpy(zero_copy_only=False), part["part"].to_numpy(),
                (key[3, i], key[4, i]), int(key[1, i]), threshold)
            some = np.flatnonzero(found)
            ids.append(own[some])
            n.append(found[some])
            low.append(own[label[some]])
        join = lambda parts: np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64)
        return pa.table({"id": join(ids), "links": join(n), "low": join(low)})

    return work


def cosine_links(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per vector.

    Vectors of equal, non-null ``label`` and equal length link when their
    cosine is at least ``threshold``. ``n_links`` counts the other vectors that
    a vector links with directly, ``component_id`` is the smallest ``vec_id``
    reachable, and ``kept`` marks the vector of that id.

    Vectors that are null, empty, zero or hold a null or non-finite component,
    and those with a null label, link with nothing and are kept. A null
    ``vec_id`` links with nothing, has a null component and is not kept. Equal
    vectors are joined once and counted as often as they occur. Rows that
    repeat a ``vec_id`` share its component. Other columns are not read.
    """
    spark = vectors.sparkSession
    n_buckets = buckets(spark)
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0), F.lit(False))
    marked = rows.withColumn("usable", usable)
    distinct = settled(
        marked.filter("usable").groupBy("label", "v").agg(
            F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("dims", F.size("v")))
    shapes = distinct.groupBy("label", "dims").agg(F.count(F.lit(1)).alias("n")).groupBy("dims").agg(
        F.max("n").alias("n")).collect()  # one row per length of vector
    links, edges = None, None
    for shape in shapes:
        dims, most = shape["dims"], shape["n"]
        depth = int(min(MAX_DEPTH, max(0, np.ceil(np.log2(max(1, most) / LEAF_ROWS)))))
        of_size = distinct.filter(F.col("dims") == dims)
        sample = of_size.orderBy(F.xxhash64("id")).limit(SPLIT_SAMPLE).select("v").toArrow()
        turned = rotated(_matrix(sample["v"].combine_chunks(), dims))
        cuts, share = blocks_of(dims), budgets(dims, threshold)
        trees = [Splits(turned[:, c], depth) for c in cuts]

        def deal(batches, with_vector=True, dims=dims, cuts=cuts, share=share, trees=trees):
            for batch in batches:
                if not batch.num_rows:
                    continue
                v = _matrix(batch.column("v"), dims)
                turned = rotated(v)
                binary = np.array([pack(x) for x in v] if with_vector else [b""] * len(v), object)
                for block, (cut, tree) in enumerate(zip(cuts, trees)):
                    home = tree.home(turned[:, cut])
                    at, leaf = tree.reached(turned[:, cut], home, share[block] + 1e-8)
                    at, leaf = np.concatenate([np.arange(len(v)), at]), np.concatenate([home, leaf])
                    take = pa.array(at)
                    yield {"label": batch.column("label").take(take), "id": batch.column("id").take(take),
                           "copies": batch.column("copies").take(take),
                           "block": np.full(len(at), block, np.int32), "leaf": leaf,
                           "home": home[at] == leaf, "vector": pa.array(binary[at], pa.binary())}

        schema = "label {0}, id long, copies long, block int, leaf long, home boolean, vector binary".format(
            dict(distinct.dtypes)["label"])
        source = of_size.select("label", "id", "copies", "v")
        crowded = (map_arrow(source, lambda b: deal(b, False), schema)
                   .groupBy("label", "block", "leaf").agg(F.count(F.lit(1)).alias("n"))
                   .filter(F.col("n") > 2 * LEAF_ROWS)
                   .select("label", "block", "leaf", F.ceil(F.col("n") / LEAF_ROWS).alias("parts")))
        parts = F.coalesce("parts", F.lit(1))
        dealt = (
            map_arrow(source, deal, schema).join(settled(crowded), ["label", "block", "leaf"], "left")
            .withColumn("part", F.pmod(F.xxhash64("id"), parts))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
            .withColumn("part_a", F.least("part", "other")).withColumn("part_b", F.greatest("part", "other"))
            .withColumn("bucket", F.pmod(F.xxhash64("label", "block", "leaf", "part_a", "part_b"),
                                         F.lit(n_buckets))))
        found = settled(dealt.groupBy("bucket").applyInArrow(
            _leaf_job(dims, threshold), "id long, links long, low long"))
        links = found if links is None else links.union(found)
    out = marked.select("vec_id", "label", "v", "usable")
    if links is None:
        return out.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                          F.col("vec_id").alias("component_id"),
                          F.col("vec_id").isNotNull().alias("kept"))
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    groups = distinct.join(counted, "id", "left").select(
        "label", "v", "id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    members = marked.filter("usable").join(groups, ["label", "v"])
    # An id that stands for several vectors ties them together.
    twice = members.groupBy("vec_id").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low <> high")
    edges = links.select(F.col("id").alias("a"), F.col("low").alias("b")).union(twice.select("low", "high"))
    comps = components(edges)
    linked = members.join(comps.withColumnRenamed("node", "id"), "id", "left").select(
        "vec_id", "n_links", F.coalesce("component", "id").alias("component_id"))
    alone = out.filter(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
