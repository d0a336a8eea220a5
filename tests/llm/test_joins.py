"""Similarity joins against brute force."""

import random

import numpy as np
import pytest

from cellmend.llm import ngram_join, vector_join
from cellmend.llm.common import components
from cellmend.llm.ngram_join import ngram_jaccard_components, one_of_each_group
from cellmend.llm.vector_join import cosine_links
from tests.llm.test_texts import shingles


def smallest_reachable(nodes, pairs):
    low = {n: n for n in nodes}

    def find(n):
        while low[n] != n:
            n = low[n]
        return n
    for a, b in pairs:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(i for i in sets if i is not None)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    low = smallest_reachable(ids, pairs)
    return sorted([(i, len(sets[i]), low[i]) for i in ids])


def corpus(seed, groups, copies, words=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    passage = " ".join(word() for _ in range(30))
    texts = []
    for g in range(groups):
        base = [word() for _ in range(rnd.randint(1, words))]
        if g % 3 == 0:
            base += passage.split()
        for _ in range(rnd.randint(1, copies)):
            own = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 4])):
                own[rnd.randrange(len(own))] = word()
            texts.append(" ".join(own))
    rnd.shuffle(texts)
    return list(enumerate(texts))


def got(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()])


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(200, 200), (300, 299)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = smallest_reachable({n for e in edges for n in e}, edges)
    want.pop(200)
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_components_equal_brute_force(documents):
    rows = corpus(1, 60, 8)
    assert got(ngram_jaccard_components(documents(rows))) == expected(rows)


def test_a_large_group_in_small_blocks(documents, monkeypatch):
    """Branches are cut in blocks of 8 rows, documents in several flushes."""
    monkeypatch.setattr(ngram_join, "BRANCH_ROWS", 8)
    rows = corpus(2, 4, 60, words=40)
    assert got(ngram_jaccard_components(documents(rows))) == expected(rows)


def test_odd_documents(documents):
    long = " ".join(str(i % 5000) for i in range(30_000))
    rows = [(5, "a b"), (3, "A B"), (4, "a b c"), (7, None), (8, " \n"), (9, long), (2, long + " x"), (-1, "a b")]
    assert got(ngram_jaccard_components(documents(rows))) == expected(rows)
    # Rows that repeat an id: identical ones fall together; others share the id's links.
    twice = [(1, "p q r"), (1, "p q r"), (1, "s t"), (6, "s t"), (None, "p q r"), (None, None)]
    found = sorted([tuple(r) for r in ngram_jaccard_components(documents(twice)).collect()], key=repr)
    assert found == sorted([(1, 1, 1), (1, 1, 1), (6, 1, 1), (None, 1, None), (None, 0, None)], key=repr)
    assert ngram_jaccard_components(documents([])).count() == 0


def test_one_of_each_group(documents):
    rows = [(5, "a b"), (3, "A B"), (4, None), (6, ""), (None, "a b"), (3, "A B")]
    kept = one_of_each_group(documents(rows))
    assert sorted([r.doc_id for r in kept.collect()], key=repr) == sorted([3, 4, 6, None], key=repr)
    assert "bucket" in kept.columns


def test_tree_finds_every_pair_within_the_bound():
    rnd = np.random.default_rng(4)
    base = rnd.poisson(2, (12, ngram_join.GROUPS))
    points = np.repeat(base, 9, axis=0) + (rnd.random((108, ngram_join.GROUPS)) < 0.05)
    sizes, comps = points.sum(axis=1), np.arange(108)
    a, b = ngram_join.Tree(points, sizes, comps).join()
    found = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())}
    bound = np.minimum(points[:, None], points[None]).sum(axis=2)
    want = {(i, j) for i in range(108) for j in range(i + 1, 108)
            if ngram_join.reaches(bound[i, j], sizes[i], sizes[j])}
    assert found == want
    left, right = np.arange(50), np.arange(50, 108)
    tree = lambda r: ngram_join.Tree(points[r], sizes[r], comps[r])
    a, b = tree(left).join(tree(right))
    assert {(int(left[i]), int(right[j])) for i, j in zip(a, b)} == {p for p in want if p[0] < 50 <= p[1]}


def brute_links(rows, threshold=0.98):
    ok = {i: np.array(v, float) for i, v, l in rows if i is not None and l is not None and v
          and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    label = {i: l for i, _, l in rows}
    pairs = [(a, b) for a in ok for b in ok if a < b and label[a] == label[b] and len(ok[a]) == len(ok[b])
             and ok[a] @ ok[b] / (np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])) >= threshold]
    low = smallest_reachable([i for i, _, _ in rows], pairs)
    n = {i: sum(i in p for p in pairs) for i in low}
    return sorted([(i, n[i], low[i], low[i] == i) for i in low])


@pytest.mark.parametrize("leaf_rows", [2048, 16])
def test_cosine_links_equal_brute_force(spark, monkeypatch, leaf_rows):
    monkeypatch.setattr(vector_join, "LEAF_ROWS", leaf_rows)
    rnd = np.random.default_rng(leaf_rows)
    rows = []
    for _ in range(25):
        base = rnd.normal(size=20)
        for _ in range(rnd.integers(1, 20)):
            v = base + rnd.normal(size=20) * rnd.choice([0, 0.05, 0.12, 0.2])
            rows.append((len(rows), [float(x) for x in v], int(rnd.integers(0, 2))))
    rows += [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 20, 1), (1003, [float("nan")] * 20, 1),
             (1004, [None] * 20, 1), (1005, rows[0][1], None), (1006, rows[0][1][:8], rows[0][2]),
             (1007, rows[0][1][:8], rows[0][2]), (1008, [float("inf")] * 20, 1)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows],
                                  "vec_id long, embedding array<double>, label int, id int, leaf string")
    assert sorted([tuple(r) for r in cosine_links(table).collect()]) == brute_links(rows)


def test_links_of_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert cosine_links(empty).collect() == []
    one = spark.createDataFrame([(None, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in cosine_links(one).collect()] == [(None, 0, None, False)]
