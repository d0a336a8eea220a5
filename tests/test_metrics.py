"""Metrics against a plain Python computation, and their invariants."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellmend.operators import metrics as M
from cellmend.operators.ordering import running_total
from cellmend.operators.tables import exact_quantiles, iqr_outliers, keyed_upsert

NULLISH = {"", "nan", "none", "null", "na", "n/a", "#n/a", "nil", "-", "--"}


def expected(rows):
    """Null, type and entropy metrics of text rows, cell by cell."""
    def squeeze(v):
        return (v or "").strip(" ").lower().replace(",", "").replace(" ", "")

    def kind(v):
        s = squeeze(v)
        if s in NULLISH:
            return "null"
        body = s[1:] if s.startswith("-") else s
        if body.isdigit():
            return "int"
        whole, dot, part = body.partition(".")
        return "float" if dot and whole.isdigit() and part.isdigit() else "string"

    nulls = filled = off = 0
    deltas = []
    for column in zip(*rows):
        kinds = [kind(v) for v in column]
        values = [v.strip(" ").lower() for v, k in zip(column, kinds) if k != "null"]
        nulls += kinds.count("null")
        real = Counter(k for k in kinds if k != "null")
        filled += len(values)
        off += len(values) - (max(real.values()) if real else 0)
        if len(values) >= 2:
            counts = Counter(values).values()
            h = -sum(c / len(values) * math.log2(c / len(values)) for c in counts)
            top = math.log2(len(counts)) if len(counts) > 1 else 1.0
            deltas.append(abs(h / top - 1) * 100)
    cells = len(rows) * len(rows[0])
    return (100 * nulls / cells, 100 * off / filled, sum(deltas) / len(deltas))


def dirty_rows(n=400, seed=5):
    rng = random.Random(seed)
    pool = ["1", "2", "-3", "1,5", "2.5", "x", "X ", "n/a", "", None, "--", "é", "a" * 80,
            "A" * 80, "9" * 70, "," * 70, "b" * 63, "b" * 64]
    return [tuple(rng.choice(pool[: 4 + 5 * c]) for c in range(4)) for _ in range(n)]


def profile(df):
    row = M.profile_tables({"t": df}).first()
    return row.null_pct, row.type_deviation_pct, row.entropy_delta_pct, row.total_rows, row.total_cells


def test_profile_equals_brute_force(spark):
    rows = dirty_rows()
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    got = profile(df)
    assert got[:3] == pytest.approx(expected(rows), abs=6e-4)
    assert got[3:] == (400, 1600)


def test_profile_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(dirty_rows(), "a string, b string, c string, d string")
    assert profile(df) == profile(df.repartition(7)) == profile(df.orderBy(F.rand(3)))


def test_typed_columns_go_by_their_type(spark):
    df = spark.createDataFrame(
        [(1, 1e9, True, [1]), (None, float("nan"), None, None)],
        "i int, d double, b boolean, a array<int>")
    by_name = {r.column_name: r for r in M.profile_columns({"t": df}).collect()}
    assert (by_name["i"].n_int, by_name["i"].null_cells) == (1, 1)
    assert (by_name["d"].n_float, by_name["d"].null_cells) == (1, 1)
    assert (by_name["b"].n_string, by_name["a"].n_string) == (1, 1)


def test_constant_column_scores_100_and_short_ones_nothing(spark):
    df = spark.createDataFrame([("x", "1"), ("x", None)], "a string, b string")
    by_name = {r.column_name: r.entropy_delta_pct for r in M.profile_columns({"t": df}).collect()}
    assert by_name == {"a": 100.0, "b": None}


def test_empty_table_gives_zero(spark):
    df = spark.createDataFrame([], "a string, `b.c` string")
    assert M.null_pct(df).first().null_pct == 0.0
    assert M.type_deviation(df).first()[0] == 0.0
    assert M.entropy_delta_pct(df).first()[0] == 0.0


def test_dotted_names(spark):
    df = spark.createDataFrame([("x",), ("y",)], "`a.b` string")
    assert profile(df) == (0.0, 0.0, 0.0, 2, 2)


def test_summary_leaves_errors_out(spark):
    metrics = spark.createDataFrame(
        [(1, 10.0, ""), (2, 20.0, None), (3, None, "File not found")],
        "serial_number int, null_pct double, error string")
    row = M.summary(metrics).first()
    assert (row.files, row.ok, row.errors, row["mean"], row["max"]) == (3, 2, 1, 15.0, 20.0)
    assert [r.serial_number for r in M.error_files(metrics).collect()] == [3]


def test_attach_replaces_stale_metrics(spark):
    inventory = spark.createDataFrame([(1, 5.0, "old")], "serial_number int, null_pct double, error string")
    fresh = spark.createDataFrame([(1, 7.0)], "serial_number int, null_pct double")
    assert M.attach_metrics(inventory, fresh).first().asDict() == {
        "serial_number": 1, "error": "old", "null_pct": 7.0}


def test_running_total_is_global(spark):
    rng = random.Random(1)
    values = [(i, rng.randint(1, 9)) for i in range(2000)]
    rng.shuffle(values)
    df = spark.createDataFrame(values, "k int, n int").repartition(11)
    got = running_total(df, [F.col("k")], F.col("n"), "t").orderBy("k").collect()
    total = 0
    for row in got:
        total += row.n
        assert row.t == total


def test_quantiles_and_outliers(spark):
    rng = random.Random(2)
    values = [rng.choice([1.0, 2.0, 2.0, 3.0, 1000.0]) + rng.random() for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    ordered = sorted(values)

    def at(q):
        rank = (len(ordered) - 1) * q
        low = math.floor(rank)
        high = math.ceil(rank)
        return ordered[low] + (ordered[high] - ordered[low]) * (rank - low)

    q = exact_quantiles(df, "v", [0.1, 0.25, 0.75]).first()
    assert tuple(q) == pytest.approx((at(0.1), at(0.25), at(0.75)))
    reach = 1.5 * (at(0.75) - at(0.25))
    kept = [v for v in values if at(0.25) - reach <= v <= at(0.75) + reach]
    assert iqr_outliers(df, "v").count() == len(kept)


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, o int")
    once = keyed_upsert(target, batch, order_by=F.col("o"))
    twice = keyed_upsert(once, batch, order_by=F.col("o"))
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "y"), (3, "z")]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
