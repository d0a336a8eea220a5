"""Live drift equals drift over the whole history."""

import random

from pyspark.sql import functions as F

from cellmend.operators import tables as T
from cellmend.operators.deviation import type_ratio_drift
from cellmend.operators.drift_state import DriftState

COLUMNS = ["a", "b"]


def made(spark, days, seed=1):
    rnd = random.Random(seed)
    rows = [(d, rnd.choice(["1", "2", "x", "", "2.5", f"v{d}"]), rnd.choice([None, 1.5, 2.5])) for d in days for _ in range(rnd.randint(1, 60))]
    return spark.createDataFrame(rows, "day int, a string, b double")


def rows(df):
    return sorted((tuple(round(v, 3) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_types_in_runs_of_any_length(spark, tmp_path):
    df = made(spark, range(12)).cache()
    state = DriftState(spark, str(tmp_path / "s"), COLUMNS)
    got = []
    for low, high in ((0, 1), (1, 2), (2, 7), (7, 12)):
        drift, _ = state.update(df.filter(F.col("day").between(low, high - 1)), "day")
        got += rows(drift)
    assert sorted(got, key=repr) == rows(type_ratio_drift(df, "day", COLUMNS))
    whole = DriftState(spark, str(tmp_path / "w"), COLUMNS)
    whole.update(df, "day")
    assert rows(state.entropy_delta()) == rows(whole.entropy_delta())
    df.unpersist()


def test_a_failed_update_can_be_repeated(spark, tmp_path, monkeypatch):
    df = made(spark, range(6), 2).cache()
    first, rest = df.filter("day < 3"), df.filter("day >= 3")
    state = DriftState(spark, str(tmp_path / "s"), COLUMNS)
    state.update(first, "day")
    before = rows(state.entropy_delta())
    real = state.heads.upsert
    monkeypatch.setattr(state.heads, "upsert", lambda *a, **b: 1 / 0)
    try:
        state.update(rest, "day")
        raise AssertionError("it should have failed")
    except ZeroDivisionError:
        pass
    assert rows(state.entropy_delta()) == before
    monkeypatch.setattr(state.heads, "upsert", real)
    drift, entropy = state.update(rest, "day")
    clean = DriftState(spark, str(tmp_path / "c"), COLUMNS)
    clean.update(first, "day")
    want_drift, want_entropy = clean.update(rest, "day")
    assert rows(drift) == rows(want_drift) and rows(entropy) == rows(want_entropy)
    assert rows(state.entropy_delta()) == rows(clean.entropy_delta())
    df.unpersist()


def test_sketches_of_parts_merge(spark):
    df = spark.range(20_000).selectExpr("id % 7 AS part", "CASE WHEN id % 11 = 0 THEN NULL ELSE cast(id AS double) END AS v",
                                        "cast('NaN' AS double) AS w")
    parts = T.quantile_sketches(df, ["v", "w"], ["part"])
    assert parts.count() == 14
    got = {r.column_name: r for r in T.sketched_quantiles(parts, [0.25, 0.5, 0.75]).collect()}
    assert got["w"].n == 0 and got["w"].q0 is None
    for q, x in zip((0.25, 0.5, 0.75), (got["v"].q0, got["v"].q1, got["v"].q2)):
        assert abs(x - 20_000 * q) < 20_000 * 0.01
    live = spark.createDataFrame([(1e6,), (500.0,)], "v double")
    assert [r.v for r in T.iqr_outliers(live, "v", sketches=parts).collect()] == [500.0]
