"""Chat windows: exact round trips, masks, budgets and plans."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from cellmend.llm.chat_format import MARKS, format_chats, read_back

TURNS = "conv_id long, turn long, role string, text string, pos int, cost string, conv int, tail string"
TURN = re.compile(r"### ((?:[^\\:#<]|\\.)*): ((?:[^\\#<]|\\.)*)</turn>\n", re.S)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], TURNS)


def plain(text):
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def read(windows):
    """(turns, loss texts) by conversation, in plain Python; each window is whole turns."""
    convs = {}
    for r in sorted(windows, key=lambda r: r.first_turn):
        turns = [(plain(m[1]), plain(m[2])) for m in TURN.finditer(r.text)]
        assert "".join(m[0] for m in TURN.finditer(r.text)) == r.text
        assert len(turns) == r.n_repeated + r.n_turns
        seen, loss = convs.setdefault(r.conv_id, ([], []))
        assert r.first_turn == len(seen) + 1
        repeated = turns[:r.n_repeated]
        if r.first_turn > 1 and seen[0][0] == "system":
            assert repeated[0] == seen[0]
            repeated = repeated[1:]
        else:
            assert r.first_turn > 1 or not repeated
        assert repeated == seen[len(seen) - len(repeated):]
        seen += turns[r.n_repeated:]
        loss += [plain(r.text[s.start:s.start + s.length]) for s in r.loss]
    return convs


def messy(seed, convs, turns):
    rnd = random.Random(seed)
    bits = ["a", "bb c", "\\", "#", "###", "### Assistant: ", "</turn>\n", "<", ":", "\n", "é𝄞", " ", "\\\\#"]
    return [(c, t, rnd.choice(["user", "assistant", "assistant", "ro:le\n"]) if t or c % 3 else "system",
             "".join(rnd.choice(bits) for _ in range(rnd.choice([0, 1, 4, 40]))))
            for c in range(convs) for t in range(rnd.randint(1, turns))]


@pytest.mark.parametrize("long_turns", [10_000, 3])
def test_round_trip_of_messy_texts(spark, long_turns):
    rows = messy(1, 12, 30)
    windows = format_chats(frame(spark, rows).repartition(5), 60, 20, long_turns).collect()
    convs = read(windows)
    for c in {r[0] for r in rows}:
        own = [(role, text) for i, _, role, text in sorted(rows, key=lambda r: r[:2]) if i == c]
        assert convs[c] == (own, [text for role, text in own if role == "assistant"])
    assert len(windows) > 60
    for r in windows:
        words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", plain(m[2]))) + MARKS for m in TURN.finditer(r.text))
        assert r.cost == words and r.over_budget == (words > 60)
        if r.over_budget:  # only what cannot be cut is too long
            assert r.n_turns == 1 or r.first_turn == 1 or r.n_repeated


def test_budget_holds_unless_a_turn_is_too_long(spark):
    rnd = random.Random(2)
    rows = [(c, t, "user" if t % 2 else "assistant", " ".join(["w"] * rnd.randint(0, 30)))
            for c in range(6) for t in range(80)]
    for r in format_chats(frame(spark, rows), 100, 20).collect():
        assert not r.over_budget and r.cost <= 100


def test_long_conversations_are_cut_like_short_ones(spark):
    rows = messy(4, 8, 60)
    one = format_chats(frame(spark, rows), 80, 30)
    two = format_chats(frame(spark, rows).repartition(9), 80, 30, 5)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_digests(spark):
    rows = messy(6, 9, 12)
    got = {r.conv_id: r for r in read_back(format_chats(frame(spark, rows), 50, 20)).collect()}
    for c in {r[0] for r in rows}:
        own = [(role, text) for i, _, role, text in sorted(rows, key=lambda r: r[:2]) if i == c]
        loss = "".join(text for role, text in own if role == "assistant")
        assert got[c].n_turns == len(own) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("long_turns", [10_000, 2])
def test_nulls_ties_repeats_and_long_texts(spark, long_turns):
    long = "#<\\ x" * 60_000
    rows = [(None, 0, "user", "a"), (None, None, None, None), (1, 3, "assistant", long), (1, None, "assistant", "first"),
            (2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (3, 0, None, "")]
    convs = read(format_chats(frame(spark, rows), 64, 16, long_turns).collect())
    assert convs[None] == ([("", ""), ("user", "a")], [])
    assert convs[1] == ([("assistant", "first"), ("assistant", long)], ["first", long])
    assert convs[2][1] == ["same"] * 3
    assert convs[3] == ([("", "")], [])


def test_empty_table(spark):
    assert format_chats(frame(spark, [])).collect() == []
    assert read_back(format_chats(frame(spark, []))).collect() == []


def test_one_shuffle_of_texts_and_no_python(spark):
    rows = frame(spark, messy(7, 5, 8))
    plan = read_back(format_chats(rows))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2  # by conversation, and by its id for the digests
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
