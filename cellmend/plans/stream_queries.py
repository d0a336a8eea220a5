"""Streams over the tables' files, run until nothing is left and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellmend.operators.ordering import scratch_path
from cellmend.plans.catalog import query, table
from cellmend.plans.integrity_queries import type_sql
from cellmend.streaming import streams as S


def _stream(spark, sf_dir, name):
    schema = table(spark, sf_dir, name).schema
    return S.new_files(spark, sf_dir, schema, glob=f"{name}.parquet")


def _finish(run):
    run.awaitTermination()
    if run.exception():
        raise run.exception()


@query("stream_ingest", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def stream_ingest(spark, sf_dir):
    out = scratch_path(spark, "ingest")
    rows = _stream(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    for _ in range(2):  # the second run finds no new file
        _finish(S.ingest(rows, f"{out}/data", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/data")


_COLUMNS = {"event_type": "CASE WHEN event_id % 9 = 0 THEN '' ELSE event_type END",
            "user_id": "CAST(user_id AS STRING)"}
_CELLS = " UNION ALL ".join(
    f"SELECT date_trunc('hour', ts) AS w, '{c}' AS column_name, lower(trim({sql})) AS v, "
    f"{type_sql(sql)} AS t FROM events" for c, sql in _COLUMNS.items())


@query("stream_integrity", f"""
    WITH c AS ({_CELLS}),
    n AS (SELECT w, column_name, v, t, count(*) AS n FROM c GROUP BY ALL),
    s AS (SELECT w, column_name, sum(n) AS cells,
                 coalesce(sum(n) FILTER (WHERE t = 'null'), 0) AS nulls,
                 coalesce(sum(n) FILTER (WHERE t <> 'null'), 0) AS nf,
                 greatest(coalesce(sum(n) FILTER (WHERE t = 'int'), 0),
                          coalesce(sum(n) FILTER (WHERE t = 'float'), 0),
                          coalesce(sum(n) FILTER (WHERE t = 'string'), 0)) AS modal,
                 count(*) FILTER (WHERE t <> 'null') AS d,
                 sum(n * log2(n)) FILTER (WHERE t <> 'null') AS s
          FROM n GROUP BY ALL)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, column_name,
           cells::BIGINT AS cells, round(100.0 * nulls / cells, 3)::DOUBLE AS null_pct,
           coalesce(round(100.0 * (nf - modal) / nullif(nf, 0), 3), 0)::DOUBLE
             AS type_deviation_pct,
           round(CASE WHEN nf >= 2 THEN abs((log2(nf) - s / nf)
             / CASE WHEN d > 1 THEN log2(d) ELSE 1.0 END - 1) * 100 END, 3)::DOUBLE
             AS entropy_delta_pct
    FROM s""")
def stream_integrity(spark, sf_dir):
    """Integrity of every hour, the last ones included."""
    out = scratch_path(spark, "windows")
    events = _stream(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        *[F.expr(sql).alias(c) for c, sql in _COLUMNS.items()])
    counts = S.windowed_counts(S.with_end(events, "ts", f"{out}/end"), "ts", list(_COLUMNS))
    _finish(S.write_windows(counts, f"{out}/data", f"{out}/checkpoint"))
    S.mark_end(spark, "ts", f"{out}/end")  # the events are all: finish the open windows
    _finish(S.write_windows(counts, f"{out}/data", f"{out}/checkpoint"))
    done = S.finish_windows(spark.read.parquet(f"{out}/data"), list(_COLUMNS))
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return done.select(shown("window_start"), shown("window_end"), *done.columns[2:])


@query("stream_upsert", """
    SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id
    FROM events GROUP BY user_id""")
def stream_upsert(spark, sf_dir):
    out = scratch_path(spark, "upsert")
    rows = _stream(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    for _ in range(2):
        _finish(S.upsert_stream(rows, ["user_id"], f"{out}/data", f"{out}/checkpoint",
                                F.col("event_id")))
    return S.read_upserted(spark, f"{out}/data", ["user_id"])


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    out = scratch_path(spark, "dedup")
    events = _stream(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    unique = S.dedup(events, ["user_id", "event_type"], "ts").select("user_id", "event_type")
    _finish(S.ingest(unique, f"{out}/data", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/data")
