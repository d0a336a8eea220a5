"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest

from cellmend.llm.hard_negatives import Block, mine_hard_negatives, pack, scan

ROWS = "vec_id long, embedding array<float>, label int, block string, n int, anchors string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], ROWS)


def expected(rows, every, n):
    kept = [(k, i, [math.floor(256 * float(np.float32(x))) for x in e], y) for k, (i, e, y) in enumerate(rows)
            if i is not None and y is not None and e is not None
            and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for k, a, e, y in kept:
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(e, f)), i, z) for m, i, f, z in kept if m != k)
        for s, i, z in [r for r in scored if r[2] == y][:n]:
            fit = [r for r in scored if r[2] != y and 80 * -s <= 100 * -r[0] <= 100 * -s]
            out += [(a, i, rank, j, -s, -t) for rank, (t, j, _) in enumerate(fit[:n], 1)]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score)
                  for r in df.collect())


def test_against_brute_force(spark):
    rnd = random.Random(5)
    centres = [[rnd.gauss(0, 1) for _ in range(11)] for _ in range(4)]
    rows = [(i, [c + rnd.gauss(0, 0.7) for c in rnd.choice(centres)], rnd.randrange(3)) for i in range(400)]
    rows += [(i, [0.5] * 11, 1) for i in range(400, 440)]  # ties
    rnd.shuffle(rows)
    want = expected(rows, 20, 5)
    assert len(want) > 100
    assert got(mine_hard_negatives(frame(spark, rows).repartition(7), every=20)) == want


def test_nulls_repeats_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [0.3, -2.0, 4.0], 2), (1, [1.0, 0.5], 2), (1, [1.0, 0.5], 1),
            (2, [0.9, 0.5], 2), (3, [], 1), (4, [], 2), (5, None, 1), (6, [None, 1.0], 1), (7, [float("nan"), 1.0], 2),
            (8, [float("inf"), 1.0], 2), (None, [1.0, 0.5], 2), (9, [1.0, 0.5], None), (200, [-1.0, -1.0], 1),
            (300, [0.0, 0.0], 5), (301, [0.0, 0.0], 5), (10, [1.0, 0.45, 3.0], 2), (11, [-0.2, 0.1], 1)]
    want = expected(rows, 100, 5)
    assert got(mine_hard_negatives(frame(spark, rows))) == want
    assert any(r[0] == 300 for r in want)  # scores of nought fill a window as well


def test_huge_components_do_not_overflow(spark):
    rows = [(0, [3e38, 1.0], 1), (1, [3e38, 1.0], 1), (2, [3e38, 1.0], 2), (3, [-3e38, 1.0], 2)]
    most = math.floor(2 ** 31 / math.sqrt(2))
    score = most * most + 256 * 256
    assert got(mine_hard_negatives(frame(spark, rows))) == [(0, 1, 1, 2, score, score)]


def test_without_rows_or_anchors(spark):
    assert got(mine_hard_negatives(frame(spark, []))) == []
    assert got(mine_hard_negatives(frame(spark, [(1, [1.0], 1), (2, [1.0], 2)]))) == []
    assert got(mine_hard_negatives(frame(spark, [(0, [1.0], 1), (2, [1.0], 2)]))) == []


@pytest.mark.parametrize("scale", [100, 1 << 28])
def test_scan_keeps_all_that_fits_the_bounds(scale):
    rng = np.random.default_rng(2)
    x = rng.integers(-scale, scale, (24, 500))
    block = Block({"block": 0, "n": 500, "kind": 2, "ids": pack(np.arange(500)), "labels": pack(np.arange(500) % 3),
                   "columns": pack(x.astype(np.int64))})
    q = rng.integers(-scale, scale, 24)
    exact = (q[:, None] * x).sum(axis=0)
    least, most = np.sort(exact)[[300, 450]]
    rows, scores = scan(q, block, np.arange(500), least, most, None)
    assert sorted(rows) == np.flatnonzero((exact >= least) & (exact <= most)).tolist()
    assert (scores == exact[rows]).all()
    rows, _ = scan(q, block, block.of[1], -np.inf, np.inf, 5)
    assert set(np.argsort(-exact[block.of[1]])[:5]) <= {int(np.searchsorted(block.of[1], r)) for r in rows}
