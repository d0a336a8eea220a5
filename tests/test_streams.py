"""Streams pick up each file once and repeat safely."""

from pyspark.sql import functions as F

from cellmend.operators.tables import latest
from cellmend.streaming import streams as S

SCHEMA = "k int, v string, o int"


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_only_new_files(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    write(spark, src, [(1, "a", 0), (2, "b", 0)])
    run(S.ingest(S.new_files(spark, src, SCHEMA), out, state))
    write(spark, src, [(3, "c", 0)])
    run(S.ingest(S.new_files(spark, src, SCHEMA), out, state))
    run(S.ingest(S.new_files(spark, src, SCHEMA), out, state))
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_upsert_log(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    write(spark, src, [(1, "a", 1), (1, "b", 2), (2, "c", 1)])
    run(S.upsert_stream(S.new_files(spark, src, SCHEMA).drop("_file_source"), ["k"], out, state, F.col("o")))
    write(spark, src, [(2, "d", 0)])
    run(S.upsert_stream(S.new_files(spark, src, SCHEMA).drop("_file_source"), ["k"], out, state, F.col("o")))
    want = [(1, "b", 2), (2, "d", 0)]
    assert sorted(map(tuple, S.read_upserted(spark, out, ["k"]).collect())) == want
    # A batch that runs again replaces itself.
    S.upsert_log(["k"], out, F.col("o"))(spark.createDataFrame([(2, "d", 0)], SCHEMA), 1)
    assert sorted(map(tuple, S.read_upserted(spark, out, ["k"]).collect())) == want
    folded = str(tmp_path / "folded")
    S.compact(spark, out, ["k"], folded)
    assert sorted(map(tuple, S.read_upserted(spark, folded, ["k"]).collect())) == want


def test_latest_is_stable_without_an_order(spark):
    rows = [(1, "a", 0), (1, "c", 0), (1, "b", 0)]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        assert tuple(latest(df, ["k"]).first()) == (1, "c", 0)


def test_open_windows_are_finished_at_the_end(spark, tmp_path):
    src, out, state, end = (str(tmp_path / n) for n in ("src", "out", "state", "end"))
    schema = "ts timestamp, c string"
    def add(*hours):
        spark.createDataFrame([(h, "x") for h in hours], "h int, c string").selectExpr(
            "timestamp'2024-01-01 00:30:00' + make_interval(0, 0, 0, 0, h) AS ts", "c").write.mode("append").parquet(src)
    def go():
        events = S.with_end(S.new_files(spark, src, schema).drop("_file_source"), "ts", end)
        run(S.write_windows(S.windowed_counts(events, "ts", ["c"]), out, state))
        done = S.finish_windows(spark.read.parquet(out), ["c"])
        return sorted((r.window_start.hour, r.cells) for r in done.collect())
    add(0, 0, 1, 5)
    assert go() == [(0, 2), (1, 1)]
    add(6, 6)
    assert go() == [(0, 2), (1, 1), (5, 1)]
    S.mark_end(spark, "ts", end)
    assert go() == [(0, 2), (1, 1), (5, 1), (6, 2)]
    assert go() == [(0, 2), (1, 1), (5, 1), (6, 2)]
