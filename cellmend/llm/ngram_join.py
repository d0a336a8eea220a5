"""Near-duplicate documents by exact Jaccard similarity of word shingles.

Each document's shingles are hashed into groups; the group counts are a point,
and the sum over groups of the smaller of two counts bounds the overlap of two
documents from above. The bound is used at three levels of one index:

1. The root. In the leading groups (a document's lowest shingle hashes) a
   document has to meet other documents often enough, or no partner exists.
2. The branches. Two linked documents also share one of the rarer leading
   groups of each. Those lead a document to the branches of the most central
   documents that have them, so a group of copies has few branches, not one for
   each of its shingles.
3. The leaves. In each branch a packed R-tree over 512 group counts and the size
   is joined with itself, pruned by the summed minima of its boxes.

Pairs that survive are verified on their whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cellmend.llm import text_arrays as ta
from cellmend.llm.common import buckets, by_bucket, components, map_arrow, pack, settled, unpack
from cellmend.operators.sizing import broadcast_if_small

#: Groups of the count vectors in the leaves.
GROUPS = 512
#: Rows of one leaf job; a larger branch is dealt out in blocks of about so many rows.
BRANCH_ROWS = 4096
FANOUT = 16
_FLUSH_TOKENS = 1 << 20
_BOX_PAIRS = 1 << 10
_SALTS = 32
_UNBOUNDED = 65535  # a document with so great a group count is not bounded


def least_partner(n):
    """Size of the smallest set that can have similarity 0.75 with one of n."""
    return (3 * n + 3) // 4


def extra(n):
    """How many leading shingles two documents share beyond the first one."""
    return n // 10


def leading(n):
    """Lowest shingle hashes of a document of n that are compared at the root.

    Two sets of which the greater part is common share at least
    ``1 + min(extra)`` of these.
    """
    return np.minimum(n, n - least_partner(n) + extra(n) + 1)


def _prefix(at: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, owners) of the first ``lengths[i]`` elements from ``at[i]``."""
    owners = np.repeat(np.arange(len(lengths)), lengths)
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return at[:-1][owners] + np.arange(len(owners)) - first, owners


def _signature(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A second hash of each whole set: with its size it stands for the set."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(ta.mix(tokens), dtype=np.uint64)])
    return ta.mix(total[at[1:]] - total[at[:-1]]).view(np.int64)


class _Root:
    """Gathers leading shingles and sends each to its bucket at most once a flush."""

    def __init__(self, n_buckets: int):
        self.n_buckets = n_buckets
        self.reset()

    def reset(self) -> None:
        self.tokens, self.owners, self.ids, self.sizes, self.signs = [], [], [], [], []
        self.held = 0

    def add(self, ids: np.ndarray, tokens: np.ndarray, at: np.ndarray) -> None:
        sizes = np.diff(at)
        places, owners = _prefix(at, leading(sizes))
        self.tokens.append(tokens[places])
        self.owners.append(owners + sum(map(len, self.ids)))
        self.ids.append(ids)
        self.sizes.append(sizes)
        self.signs.append(_signature(tokens, at))
        self.held += len(places)

    def flush(self) -> dict:
        ids, sizes = np.concatenate(self.ids), np.concatenate(self.sizes)
        signs = np.concatenate(self.signs)
        tokens, owners = np.concatenate(self.tokens), np.concatenate(self.owners)
        order = np.argsort(tokens)
        tokens, owners = tokens[order], owners[order]
        fresh = np.ones(len(tokens), bool)
        fresh[1:] = tokens[1:] != tokens[:-1]
        run = np.cumsum(fresh) - 1
        common = np.bincount(run, minlength=1)[run] > 1 if len(run) else np.zeros(0, bool)
        # Documents that meet here are settled here; their shingle goes on once, unowned.
        met = np.bincount(owners[common], minlength=len(ids))
        single, once = ~common, common & fresh
        single_order, single_at = by_bucket(tokens[single], self.n_buckets)
        once_order, once_at = by_bucket(tokens[once], self.n_buckets)
        id_order, id_at = by_bucket(ta.mix(ids.view(np.uint64)), self.n_buckets)
        t, o, s = tokens[single][single_order], ids[owners[single]][single_order], tokens[once][once_order]
        # Only buckets that anything falls into: a small run does not make a row for each.
        full = np.flatnonzero(np.diff(single_at) + np.diff(once_at) + np.diff(id_at))
        cut = lambda values, limits: [pack(values[limits[b]:limits[b + 1]]) for b in full]
        self.reset()
        return {"bucket": full.astype(np.int32),
                "tokens": cut(t, single_at), "owners": cut(o, single_at), "common": cut(s, once_at),
                "ids": cut(ids[id_order], id_at), "sizes": cut(sizes[id_order].astype(np.int64), id_at),
                "signs": cut(signs[id_order], id_at), "met": cut(met[id_order].astype(np.int64), id_at)}


def _root_counts(batch: pa.Table) -> pa.Table:
    """How many leading shingles of each document other documents have too."""
    tokens, owners = unpack(batch["tokens"], np.uint64), unpack(batch["owners"], np.int64)
    everything = np.concatenate([tokens, unpack(batch["common"], np.uint64)])
    order = np.argsort(everything, kind="stable")
    ordered = everything[order]
    same = np.zeros(len(ordered) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    shared = order[same[1:] | same[:-1]]
    found, met = np.unique(owners[shared[shared < len(tokens)]], return_counts=True)
    ids, none = unpack(batch["ids"], np.int64), np.zeros(len(found), bool)
    known = np.ones(len(ids), bool)
    size, sign = unpack(batch["sizes"], np.int64), unpack(batch["signs"], np.int64)
    mask = ~np.concatenate([known, none])
    wide = lambda x: pa.array(np.concatenate([x, np.zeros(len(found), np.int64)]), mask=mask)
    return pa.table({"doc_id": np.concatenate([ids, found]), "n": wide(size), "sign": wide(sign),
                     "met": np.concatenate([unpack(batch["met"], np.int64), met.astype(np.int64)])})


def _sets_of(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        ids = batch.column("doc_id")
        for words in ta.words_of(batch.column("text"), lower=True):
            tokens, at = ta.shingle_sets(words)
            yield ids.take(pa.array(words.rows)), tokens, at


def profile(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, sign, met, sets)``: size and signature of each set, and how
    many of its leading shingles occur in the lead of another document.

    One pass over the texts. Shingles cross the network packed by bucket, each
    at most once per flush of a task, so a shingle of every document weighs no
    more than any other. Rows that repeat a document fall together.
    """
    n_buckets = buckets(docs.sparkSession)

    def lead(batches):
        root = _Root(n_buckets)
        for ids, tokens, at in _sets_of(batches):
            root.add(ids.to_numpy(), tokens, at)
            if root.held >= _FLUSH_TOKENS or len(root.ids) >= 512:
                yield root.flush()
        if root.ids:
            yield root.flush()

    packed = map_arrow(
        docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text"), lead,
        "bucket int, tokens binary, owners binary, common binary, ids binary, sizes binary, "
        "signs binary, met binary")
    counted = packed.groupBy("bucket").applyInArrow(
        _root_counts, "doc_id long, n long, sign long, met long")
    return counted.groupBy("doc_id").agg(
        F.sum("met").alias("met"),
        F.collect_set(F.when(F.col("n").isNotNull(), F.struct("n", "sign"))).alias("sets")
    ).select("doc_id", "met", F.size("sets").alias("sets"), F.inline("sets"))


def _lead_rows(batches):
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("tokens")]
        ids, n = batch.column("doc_id").to_numpy(), batch.column("n").to_numpy()
        take = leading(n)
        yield {"token": np.concatenate([s[:k] for s, k in zip(sets, take)] or [np.zeros(0, np.uint64)])
               .view(np.int64), "doc_id": np.repeat(ids, take), "n": np.repeat(n, take)}


def _point_rows(batches):
    for batch in batches:
        points = [np.bincount((np.frombuffer(x.as_buffer(), np.uint64) >> np.uint64(55)).astype(np.int64),
                              minlength=GROUPS) for x in batch.column("tokens")]
        points = [np.full(GROUPS, _UNBOUNDED) if p.max() >= _UNBOUNDED else p for p in points]
        yield {"doc_id": batch.column("doc_id"), "point": [pack(p.astype(np.uint16)) for p in points]}


def _set_rows(batches):
    for ids, tokens, at in _sets_of(batches):
        yield {"doc_id": ids, "n": np.diff(at), "sign": _signature(tokens, at),
               "tokens": [pack(tokens[i:j]) for i, j in zip(at[:-1], at[1:])]}


def reaches(overlap, size_a, size_b):
    """100 * overlap >= 75 * union, in whole numbers."""
    return 7 * overlap >= 3 * (size_a + size_b)


class Tree:
    """A packed R-tree over group counts; each box keeps the greatest counts,
    the range of sizes and, if it has only one, its component."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, comps: np.ndarray):
        self.order = np.lexsort((sizes, comps))
        self.points, self.sizes, self.comps = points[self.order], sizes[self.order], comps[self.order]
        level = (self.points, self.sizes, self.sizes, self.comps, self.comps)
        self.levels = [level]
        while len(level[0]) > 1:
            cut = np.arange(0, len(level[0]), FANOUT)
            level = (np.maximum.reduceat(level[0], cut), np.minimum.reduceat(level[1], cut),
                     np.maximum.reduceat(level[2], cut), np.minimum.reduceat(level[3], cut),
                     np.maximum.reduceat(level[4], cut))
            self.levels.append(level)

    def join(self, other: Tree | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of different components whose bound reaches the similarity;
        without ``other`` each pair of this tree once."""
        right = other or self
        depth = max(len(self.levels), len(right.levels)) - 1
        of = lambda tree, d: tree.levels[min(d, len(tree.levels) - 1)]
        found, todo = [], [(depth, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            d, a, b = todo.pop()
            a, b = self._prune(of(self, d), of(right, d), a, b)
            if d == 0:
                found.append((a, b))
                continue
            for i in range(0, len(a), _BOX_PAIRS):  # few boxes at a time: memory stays bounded
                x, y = self._product(self._open(self, a[i:i + _BOX_PAIRS], d - 1),
                                     self._open(right, b[i:i + _BOX_PAIRS], d - 1))
                if other is None:
                    x, y = x[x <= y], y[x <= y]
                todo.append((d - 1, x, y))
        a = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
        b = np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])
        if other is None:
            a, b = a[a != b], b[a != b]
        return self.order[a], right.order[b]

    @staticmethod
    def _open(tree: Tree, boxes: np.ndarray, d: int) -> list[np.ndarray]:
        if d >= len(tree.levels) - 1:
            return [boxes[i:i + 1] for i in range(len(boxes))]
        n = len(tree.levels[d][0])
        return [np.arange(FANOUT * x, min(n, FANOUT * x + FANOUT)) for x in boxes]

    @staticmethod
    def _product(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if not a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return (np.concatenate([np.repeat(x, len(y)) for x, y in zip(a, b)]),
                np.concatenate([np.tile(y, len(x)) for x, y in zip(a, b)]))

    @staticmethod
    def _prune(left: tuple, right: tuple, a: np.ndarray, b: np.ndarray):
        low_a, low_b = left[1][a], right[1][b]
        one = (left[3][a] == left[4][a]) & (right[3][b] == right[4][b]) & (left[3][a] == right[3][b])
        fits = (4 * left[2][a] >= 3 * low_b) & (4 * right[2][b] >= 3 * low_a) & ~one
        a, b = a[fits], b[fits]
        keep = np.zeros(len(a), bool)
        for i in range(0, len(a), 1 << 12):
            s = slice(i, i + (1 << 12))
            bound = np.minimum(left[0][a[s]], right[0][b[s]]).sum(axis=1, dtype=np.int64)
            keep[s] = reaches(bound, left[1][a[s]], right[1][b[s]])
        return a[keep], b[keep]


def _branch_pairs(batch: pa.Table) -> pa.Table:
    """Pairs that survive in the branches of one bucket, with their bound."""
    docs, sizes, comps = (batch[c].to_numpy() for c in ("doc_id", "n", "component"))
    hub, chunk, left, right = (batch[c].to_numpy() for c in ("hub", "chunk", "part_a", "part_b"))
    points = unpack(batch["point"], np.uint16).reshape(-1, GROUPS)
    order = np.lexsort((docs, right, left, hub))
    key = np.stack([hub[order], left[order], right[order]])
    limits = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0), True])
    none = np.zeros(0, np.int64)
    found_a, found_b, score = [none], [none], [np.zeros(0)]
    for i, j in zip(limits[:-1], limits[1:]):
        rows = order[i:j]
        tree = lambda r: Tree(points[r], sizes[r], comps[r])
        if left[rows[0]] == right[rows[0]]:
            a, b = tree(rows).join() if j - i > 1 else (none, none)
            a, b = rows[a], rows[b]
        else:
            one, two = rows[chunk[rows] == left[rows]], rows[chunk[rows] == right[rows]]
            a, b = tree(one).join(tree(two)) if len(one) and len(two) else (none, none)
            a, b = one[a], two[b]
        for s in range(0, len(a), 1 << 12):
            x, y = a[s:s + (1 << 12)], b[s:s + (1 << 12)]
            bound = np.minimum(points[x], points[y]).sum(axis=1, dtype=np.int64)
            score.append(bound / (sizes[x] + sizes[y]))
        found_a.append(docs[a])
        found_b.append(docs[b])
    a, b, score = (np.concatenate(x) for x in (found_a, found_b, score))
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    return pa.table({"a": a[fresh], "b": b[fresh], "score": score[order][fresh]})


def _verified(batches):
    for batch in batches:
        a, b = batch.column("tokens_a"), batch.column("tokens_b")
        ok = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            place = np.minimum(np.searchsorted(y, x), len(y) - 1)
            ok.append(bool(reaches(int((y[place] == x).sum()), len(x), len(y))))
        yield {"a": batch.column("a"), "b": batch.column("b"), "linked": np.array(ok, bool)}


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b, linked)``: the exact test on whole sets."""
    side = lambda name: sets.select(F.col("doc_id").alias(name), F.col("tokens").alias(f"tokens_{name}"))
    return map_arrow(pairs.join(side("a"), "a").join(side("b"), "b"), _verified,
                     "a long, b long, linked boolean")


def _branches(rows: DataFrame) -> DataFrame:
    """``(hub, doc_id, n, k)``: the branches that each document is led to, and
    by how many of its shingles.

    Of its leading shingles, a document's most frequent ones, as many as it must
    share with a partner beyond the first, need not lead anywhere. Each other
    leads to the hub of the documents that have it: the one whose shingles are
    most common among all, hence near the middle of a group of copies.
    """
    crowd = rows.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    own = Window.partitionBy("doc_id")
    led = (rows.join(crowd, "token")
           .withColumn("place", F.row_number().over(own.orderBy(F.desc("k"), "token")))
           .withColumn("central", F.sum("k").over(own) / F.col("n"))
           .filter(F.col("place") > F.floor(F.col("n") / 10))
           .select("token", "doc_id", "n", "central"))
    led = settled(led)
    hubs = led.groupBy("token").agg(
        F.max(F.struct("central", F.xxhash64("doc_id").alias("h"), F.col("doc_id").alias("hub"))).alias("top"),
        F.count(F.lit(1)).alias("k")).filter("k > 1").select("token", "top.hub")
    return led.join(hubs, "token").groupBy("hub", "doc_id", "n").agg(F.count(F.lit(1)).alias("k"))


def _first_pairs(members: DataFrame) -> DataFrame:
    """Each document with the two hubs that most of its shingles lead to, if
    enough do: this joins most groups, whatever their size, without their pairs.
    What it misses is found in the branches."""
    place = Window.partitionBy("doc_id").orderBy(F.desc("k"), "hub")
    return (members.filter((F.col("hub") != F.col("doc_id")) & (F.col("k") > F.floor(F.col("n") / 20)))
            .withColumn("place", F.row_number().over(place)).filter("place <= 2")
            .select(F.least("doc_id", "hub").alias("a"), F.greatest("doc_id", "hub").alias("b")).distinct())


def _branch_candidates(members: DataFrame, sets: DataFrame, comps: DataFrame, n_buckets: int) -> DataFrame:
    """``(a, b, score)``: pairs of different components that survive in a branch.
    A branch that holds one component only is not searched."""
    placed = settled(members.join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                     .withColumn("component", F.coalesce("component", "doc_id")))
    mixed = placed.groupBy("hub").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("rows")
    ).filter("low <> high").select("hub", F.ceil(F.col("rows") / BRANCH_ROWS).alias("parts"))
    points = map_arrow(sets.select("doc_id", "tokens"), _point_rows, "doc_id long, point binary")
    dealt = (
        placed.join(mixed, "hub").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .withColumn("part_a", F.least("chunk", "other")).withColumn("part_b", F.greatest("chunk", "other"))
        .join(points, "doc_id")
        .withColumn("bucket", F.pmod(F.xxhash64("hub", "part_a", "part_b"), F.lit(n_buckets))))
    return (dealt.groupBy("bucket").applyInArrow(_branch_pairs, "a long, b long, score double")
            .groupBy("a", "b").agg(F.max("score").alias("score")))


def _likeliest(pairs: DataFrame, per_document: int = 2) -> DataFrame:
    """The pairs that are among the most promising ones of either document."""
    place = Window.partitionBy("end").orderBy(F.desc("score"), "a", "b")
    return (pairs.withColumn("end", F.explode(F.array("a", "b")))
            .withColumn("place", F.row_number().over(place))
            .filter(F.col("place") <= per_document).select("a", "b").distinct())


def _with_edges(comps: DataFrame, verified: DataFrame) -> DataFrame:
    return comps.select(F.col("node").alias("a"), F.col("component").alias("b")).union(
        verified.filter("linked").select("a", "b"))


def ngram_jaccard_components(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per document.

    Documents link when the Jaccard similarity of their shingle sets (five
    words, A-Z lower-cased) is 0.75 or more; ``component_id`` is the smallest
    ``doc_id`` reachable by links. Every link between different sets counts:
    none is lost to a cap.

    Null and empty texts have no shingles and link with nothing. A null
    ``doc_id`` has a null component. Rows that repeat a ``doc_id`` are one
    document, with a row for each of its different sets. Other columns of
    ``docs`` are not read. An empty table gives an empty result.
    """
    n_buckets = buckets(docs.sparkSession)
    known = settled(profile(docs))
    copies = known.filter("n > 0").groupBy("n", "sign").agg(
        F.min("doc_id").alias("rep"), F.max("met").alias("met"), F.count(F.lit(1)).alias("copies"))
    # A set that a third of all documents have is dealt to many tasks.
    several = copies.filter("copies > 1").select(
        "n", "sign", "rep", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    placed = (known.filter("n > 0").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)).cast("int"))
              .join(several, ["n", "sign", "salt"], "left")
              .select("doc_id", "n", "sets", F.coalesce("rep", "doc_id").alias("rep")))
    n = F.col("n")
    smallest = F.floor((3 * n + 3) / 4)
    survivors = copies.filter(F.col("met") > F.floor(smallest / 10)).select(
        F.col("rep").alias("doc_id"), "n", "sign")
    survivors = settled(survivors)
    # Few documents survive: if their ids are few enough, the texts need no shuffle.
    texts = docs.select("doc_id", "text").join(
        broadcast_if_small(survivors.select("doc_id")), "doc_id", "left_semi")
    sets = settled(map_arrow(texts, _set_rows, "doc_id long, n long, sign long, tokens binary")
                   .join(survivors, ["doc_id", "n", "sign"], "left_semi").dropDuplicates(["doc_id", "n", "sign"]))
    rows = map_arrow(sets.select("doc_id", "n", "tokens"), _lead_rows, "token long, doc_id long, n long")
    members = settled(_branches(rows))

    tried = settled(verify(_first_pairs(members), sets))
    same_id = placed.filter("sets > 1").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    first_edges = tried.filter("linked").select("a", "b").union(same_id)
    comps = settled(components(first_edges))

    pairs = settled(_branch_candidates(members, sets, comps, n_buckets)
                    .join(tried.select("a", "b"), ["a", "b"], "left_anti"))
    # The likeliest pairs first: what they join needs no more of its own pairs.
    edges = settled(verify(_likeliest(pairs), sets))
    comps = settled(components(_with_edges(comps, edges)))
    of = lambda name: comps.select(F.col("node").alias(name), F.col("component").alias(f"of_{name}"))
    apart = (pairs.join(edges.select("a", "b"), ["a", "b"], "left_anti")
             .join(of("a"), "a", "left").join(of("b"), "b", "left")
             .filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b"))
    comps = components(_with_edges(comps, verify(apart, sets)))

    named = (placed.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
             .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")))
    empty = known.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    nameless = map_arrow(
        docs.filter(F.col("doc_id").isNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        _set_rows, "doc_id long, n long, sign long, tokens binary").select(
        "doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return named.unionByName(empty).unionByName(nameless)


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the one of smallest
    ``doc_id``. Documents without shingles or ``doc_id`` stay; of rows that
    repeat a ``doc_id`` one stays. All columns pass unchanged."""
    found = ngram_jaccard_components(docs)
    gone = settled(found.filter("n_shingles > 0 AND doc_id <> component_id").select("doc_id").distinct())
    repeated = settled(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
                       .filter("n > 1 AND doc_id IS NOT NULL").select("doc_id"))
    kept = docs.join(broadcast_if_small(gone), "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return kept
    repeated = broadcast_if_small(repeated)
    return (kept.join(repeated, "doc_id", "left_anti").select(*docs.columns)
            .unionByName(kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
                         .select(*docs.columns)))
