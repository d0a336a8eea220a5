"""The conversation trie against brute force, and running values within keys."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cellmend.llm.conversation_trie import prefix_trie
from cellmend.llm.scans import RANGE, ranged, scanned

TURNS = "conv_id long, turn long, role string, text string, k1 long, depth string, part int, path string"
EMPTY = hashlib.sha256(b"").hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], TURNS)


def rebuilt(rows, opening):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            x = (role or "", text or "")
            tie = hashlib.sha256(f"{len(x[0].encode())}:{x[0]}{x[1]}".encode()).hexdigest()
            own.setdefault(c, []).append(((t is not None, t or 0, int(tie[:15], 16), int(tie[15:30], 16)), x))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    if not opening:
        return own
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def expected(rows, opening=True):
    convs = {c: tuple(v) for c, v in rebuilt(rows, opening).items()}
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for seq in members:
        if seq:
            children[seq[:-1]] = children.get(seq[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for seq, who in members.items():
        bytes_ = len(seq[-1][1].encode()) if seq else 0
        for d in range(len(seq) + 1):
            leaves[seq[:d]] += seq not in children
            saved[seq[:d]] += (len(who) - 1) * bytes_
    out = []
    for seq, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if convs[c] == seq)
        out.append((min(who), len(seq), min(members[seq[:-1]]) if seq else None, len(who), children.get(seq, 0),
                    leaves[seq], saved[seq], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted([(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
                    r.ends_sha256) for r in df.collect()], key=repr)


@pytest.mark.parametrize("opening", [True, False])
def test_trie_against_brute_force(spark, opening):
    rnd = random.Random(3)
    rows = []
    for c in list(range(-12, 60)) + [9999999]:
        for t in range(rnd.choice([0, 1, 2, 3, 9, 12])):
            rows.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(["a", "b", "é", ""])))
    for c in (70, 71, 74, 200):  # one long path with a fork, deeper than two levels of bands
        rows += [(c, t, "user", "w" * (t % 5) + ("!" if c == 71 and t > 90 else "")) for t in range(600)]
    rnd.shuffle(rows)
    assert got(prefix_trie(frame(spark, rows), opening)) == expected(rows, opening)


def test_trie_of_nulls_ties_and_repeats(spark):
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"),
            (1, 0, "assistant", "x"), (2, None, "", ""), (2, 0, "user", "x"), (3, 5, "user", "ab\n,"),
            (10, 1, None, "z" * 300_000), (11, 1, "", "z" * 300_000), (-3, 0, "user", "x")]
    assert got(prefix_trie(frame(spark, rows), False)) == expected(rows, False)
    assert got(prefix_trie(frame(spark, rows))) == expected(rows)


def test_trie_without_conversations(spark):
    assert got(prefix_trie(frame(spark, []))) == []
    assert got(prefix_trie(frame(spark, [(None, 1, "user", "x")]))) == []


def test_lists_of_ids_longer_than_a_part(spark):
    rows = [(c, 0, "user", "same") for c in range(-5000, 9000, 1)]
    top, node = got(prefix_trie(frame(spark, rows), False))
    ids = ",".join(map(str, range(-5000, 9000))).encode()
    assert node[-1] == hashlib.sha256(ids).hexdigest() and node[3] == 14000
    assert top == (-5000, 0, None, 14000, 1, 1, 13999 * 4, EMPTY)


def test_running_values_of_a_key_that_spans_ranges(spark):
    rows = [(1, i) for i in range(30)] + [(2, i) for i in range(5000)] + [(3, 0), (4, 7)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = ranged(spark.createDataFrame(rows, "key long, at long"), "key", [F.col("at")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert df.filter("key = 2").select(RANGE).distinct().count() > 2
    out = scanned(df, "key", [F.col("at")], {"n": (F.lit(1), "sum"), "x": (F.col("at"), "xor")})
    seen = {(r.key, r.at): (r.n, r.x) for r in out.collect()}
    assert len(seen) == len(rows)
    run = {}
    for key, at in rows:
        n, x = run.get(key, (0, 0))
        run[key] = (n + 1, x ^ at)
        assert seen[key, at] == run[key]
