"""Table-level cleaning steps and the keyed upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellmend.operators import inventory as I
from cellmend.operators import tables as T
from cellmend.operators.ordering import scratch_path
from cellmend.plans.catalog import query, table
from cellmend.sources.keyed_table import KeyedTable


@query("dedup_exact", "SELECT DISTINCT text, lang, source, n_chars FROM documents")
def dedup_exact(spark, sf_dir):
    return T.dedup_exact(table(spark, sf_dir, "documents").drop("doc_id"))


# Repeated, blank and badly typed rows derived from orders.
_RAW_COLUMNS = (
    "CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE CAST(o_custkey AS STRING) END AS a",
    "CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE concat(' ', o_orderpriority, ' ') END AS b",
    "concat(' ', CAST(o_custkey % 50 AS STRING), '.5 ') AS c",
    "o_orderstatus AS d",
)
_RAW = ", ".join(_RAW_COLUMNS)


def _raw(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*_RAW_COLUMNS)


@query("drop_null_keys", f"SELECT * FROM (SELECT {_RAW} FROM orders) r WHERE a IS NOT NULL")
def drop_null_keys(spark, sf_dir):
    return T.drop_null_keys(_raw(spark, sf_dir))


@query("fill_nulls", f"""
    SELECT coalesce(a, 'UNKNOWN') AS a, coalesce(b, 'UNKNOWN') AS b, c, d
    FROM (SELECT {_RAW} FROM orders) r""")
def fill_nulls(spark, sf_dir):
    return T.fill_nulls(_raw(spark, sf_dir))


@query("convert_types", f"""
    SELECT CAST(a AS DOUBLE) AS a, b, CAST(trim(c) AS DOUBLE) AS c, d
    FROM (SELECT {_RAW} FROM orders) r""")
def convert_types(spark, sf_dir):
    return T.convert_types(_raw(spark, sf_dir))


@query("trim_strings", f"""
    SELECT a, trim(b) AS b, trim(c) AS c, d FROM (SELECT {_RAW} FROM orders) r""")
def trim_strings(spark, sf_dir):
    return T.trim_strings(_raw(spark, sf_dir))


@query("add_lineage", "SELECT *, 'orders.parquet' AS file, true AS dated FROM orders")
def add_lineage(spark, sf_dir):
    traced = T.add_lineage(table(spark, sf_dir, "orders"), F.col("_metadata.file_path"))
    return (traced.withColumn("file", F.regexp_extract("_file_source", r"[^/]+\.parquet", 0))
            .withColumn("dated", F.col("_cleaned_at").isNotNull())
            .drop("_file_source", "_cleaned_at"))


@query("clean_table", f"""
    WITH u AS (SELECT DISTINCT * FROM (SELECT {_RAW} FROM orders) r)
    SELECT CAST(a AS DOUBLE) AS customer, trim(coalesce(b, 'UNKNOWN')) AS priority,
           CAST(trim(c) AS DOUBLE) AS amount, d AS column_0
    FROM u WHERE a IS NOT NULL""")
def clean_table(spark, sf_dir):
    return T.clean_table(_raw(spark, sf_dir), ["customer", "priority", "amount"])


@query("validate_stage", """
    SELECT 'orders' AS stage, count(*)::BIGINT AS rows, 6::INT AS columns, count(*) > 0 AS passed
    FROM orders""")
def validate_stage(spark, sf_dir):
    """Counted by the job that writes the table."""
    path = scratch_path(spark, "stage")
    return T.validate_stage(table(spark, sf_dir, "orders"), "orders", lambda rows: rows.write.parquet(path))


@query("written_counters", f"""
    WITH u AS (SELECT *, count(*) AS n FROM (SELECT {_RAW} FROM orders) r GROUP BY ALL)
    SELECT sum(n)::BIGINT AS rows_in, sum(n - 1)::BIGINT AS duplicates,
           (count(*) FILTER (WHERE a IS NULL))::BIGINT AS null_keys,
           coalesce(sum((b IS NULL)::INT + (c IS NULL)::INT + (d IS NULL)::INT)
                    FILTER (WHERE a IS NOT NULL), 0)::BIGINT AS nulls_filled,
           (count(*) FILTER (WHERE a IS NOT NULL))::BIGINT AS rows_out,
           (count(*) FILTER (WHERE a IS NOT NULL))::BIGINT AS rows_written
    FROM u""")
def written_counters(spark, sf_dir):
    """Counters of a cleaning, from the job that writes it, and what it wrote."""
    path = scratch_path(spark, "counted")
    counters = T.write_cleaned_table(_raw(spark, sf_dir), lambda rows: rows.write.parquet(path), keys=["a"])
    written = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_written"))
    return written.select(*[F.lit(v).cast("bigint").alias(c) for c, v in counters.items()], "rows_written")


@query("iqr_outliers", """
    WITH d AS (SELECT l_orderkey, l_linenumber, l_extendedprice * l_quantity AS v FROM lineitem),
    q AS (SELECT quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.75) AS b FROM d)
    SELECT l_orderkey, l_linenumber, v FROM d, q
    WHERE v BETWEEN a - (b - a) * 1.5 AND b + (b - a) * 1.5""")
def iqr_outliers(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_extendedprice * l_quantity AS v")
    return T.iqr_outliers(df, "v")


@query("exact_quantiles", """
    SELECT quantile_cont(o_totalprice, 0.25) AS q0, quantile_cont(o_totalprice, 0.5) AS q1,
           quantile_cont(o_totalprice, 0.75) AS q2 FROM orders""")
def exact_quantiles(spark, sf_dir):
    return T.exact_quantiles(table(spark, sf_dir, "orders"), "o_totalprice", [0.25, 0.5, 0.75])


@query("sketched_quartiles", """
    SELECT column_name, q, true AS within, n
    FROM (SELECT 'l_tax' AS column_name, count(l_tax)::BIGINT AS n FROM lineitem
          UNION ALL SELECT 'l_extendedprice', count(l_extendedprice) FROM lineitem) c,
         (SELECT unnest([0.25, 0.5, 0.75])::DOUBLE AS q) q""")
def sketched_quartiles(spark, sf_dir):
    """Quartiles from stored sketches, one per return flag; their true ranks are
    within half a percent."""
    names = ["l_tax", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "sketches")
    T.quantile_sketches(lines, names, ["l_returnflag"]).write.parquet(path)
    found = T.sketched_quantiles(spark.read.parquet(path), [0.25, 0.5, 0.75])
    cells = lines.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in names])))
    # A value that many rows share has a range of ranks.
    ranks = cells.join(F.broadcast(found), "column_name").groupBy("column_name").agg(
        F.max("n").alias("n"), *[F.struct((F.count_if(F.col("v") < F.col(f"q{i}")) / F.count("v")).alias("low"),
                                          (F.count_if(F.col("v") <= F.col(f"q{i}")) / F.count("v")).alias("high")).alias(f"r{i}")
                                 for i in range(3)])
    return ranks.select("column_name", "n", F.inline(F.array(*[
        F.struct(F.lit(q).alias("q"), ((F.col(f"r{i}.low") <= q + 0.005) & (F.col(f"r{i}.high") >= q - 0.005)).alias("within"))
        for i, q in enumerate((0.25, 0.5, 0.75))])))


@query("keyed_upsert", """
    WITH t AS (SELECT c_custkey, c_name, c_acctbal FROM customer),
    o AS (SELECT CASE WHEN o_orderstatus = 'P' THEN o_custkey ELSE -o_custkey END AS k, * FROM orders),
    b AS (SELECT k AS c_custkey, o_orderpriority AS c_name, o_totalprice AS c_acctbal,
                 row_number() OVER (PARTITION BY k ORDER BY o_orderkey DESC) AS r
          FROM o)
    SELECT * FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM b)
    UNION ALL SELECT c_custkey, c_name, c_acctbal FROM b WHERE r = 1""")
def keyed_upsert(spark, sf_dir):
    """Known customers are replaced, those with a negative key are new."""
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    batch = table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderstatus = 'P' THEN o_custkey ELSE -o_custkey END AS c_custkey",
        "o_orderpriority AS c_name", "o_totalprice AS c_acctbal", "o_orderkey")
    return T.keyed_upsert(target, batch, order_by=F.col("o_orderkey"))


@query("keyed_upsert_nulls", """
    WITH t AS (SELECT nullif(c_custkey % 40, 7) AS k, max(c_acctbal) AS v FROM customer GROUP BY ALL),
    b AS (SELECT nullif(o_custkey % 30, 7) AS k, o_totalprice AS v,
                 row_number() OVER (PARTITION BY nullif(o_custkey % 30, 7) ORDER BY o_orderkey DESC) AS r
          FROM orders)
    SELECT k, v FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k IS NOT DISTINCT FROM t.k)
    UNION ALL SELECT k, v FROM b WHERE r = 1""")
def keyed_upsert_nulls(spark, sf_dir):
    target = table(spark, sf_dir, "customer").selectExpr(
        "nullif(c_custkey % 40, 7) AS k", "c_acctbal").groupBy("k").agg(F.max("c_acctbal").alias("v"))
    batch = table(spark, sf_dir, "orders").selectExpr(
        "nullif(o_custkey % 30, 7) AS k", "o_totalprice AS v", "o_orderkey")
    once = T.keyed_upsert(target, batch, order_by=F.col("o_orderkey"))
    return T.keyed_upsert(once, batch, order_by=F.col("o_orderkey"))


# Each customer group stands for a file; its rows are dirty orders.
_FILE_ROWS = (f"o_orderpriority AS file_type, o_custkey % 40 AS file, {_RAW}")


@query("clean_counters", f"""
    WITH r AS (SELECT {_FILE_ROWS} FROM orders),
    u AS (SELECT *, count(*) AS n FROM r GROUP BY ALL)
    SELECT file, sum(n)::BIGINT AS rows_in, sum(n - 1)::BIGINT AS duplicates,
           (count(*) FILTER (WHERE a IS NULL))::BIGINT AS null_keys,
           coalesce(sum((b IS NULL)::INT + (c IS NULL)::INT + (d IS NULL)::INT)
                    FILTER (WHERE a IS NOT NULL), 0)::BIGINT AS nulls_filled,
           (count(*) FILTER (WHERE a IS NOT NULL))::BIGINT AS rows_out
    FROM u GROUP BY file""")
def clean_counters(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey % 40 AS file", "o_orderpriority AS file_type", *_RAW_COLUMNS)
    return T.clean_counters(rows, ["file"], ["a"])


@query("execution_report", f"""
    WITH r AS (SELECT {_FILE_ROWS} FROM orders),
    u AS (SELECT *, count(*) AS n FROM r GROUP BY ALL),
    runs AS (
      SELECT file_type, file % 3 = 0 AS has_header, sum(n) AS rows_in,
             count(*) FILTER (WHERE a IS NOT NULL) AS rows_out, sum(n - 1) AS duplicates,
             coalesce(sum((b IS NULL)::INT + (c IS NULL)::INT + (d IS NULL)::INT)
                      FILTER (WHERE a IS NOT NULL), 0) AS nulls_filled
      FROM u GROUP BY file_type, file)
    SELECT coalesce(file_type, 'TOTAL') AS file_type, count(*)::BIGINT AS files,
           (count(*) FILTER (WHERE has_header))::BIGINT AS with_header,
           (count(*) FILTER (WHERE NOT has_header))::BIGINT AS without_header,
           sum(rows_in)::BIGINT AS rows_in, sum(rows_out)::BIGINT AS rows_out,
           sum(duplicates)::BIGINT AS duplicates, sum(nulls_filled)::BIGINT AS nulls_filled
    FROM runs GROUP BY ROLLUP (file_type)""")
def execution_report(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderpriority AS file_type", "o_custkey % 40 AS file", *_RAW_COLUMNS)
    runs = T.clean_counters(rows, ["file_type", "file"], ["a"])
    return I.execution_report(runs.withColumn("has_header", F.col("file") % 3 == 0))


@query("keyed_table", """
    WITH o AS (SELECT CASE WHEN o_orderstatus = 'P' THEN o_custkey ELSE -o_custkey END AS k, * FROM orders),
    b AS (SELECT k AS c_custkey, o_orderpriority AS c_name, o_totalprice AS c_acctbal,
                 row_number() OVER (PARTITION BY k ORDER BY o_orderkey DESC) AS r FROM o)
    SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM b)
    UNION ALL SELECT c_custkey, c_name, c_acctbal FROM b WHERE r = 1""")
def keyed_table(spark, sf_dir):
    """The upsert as a stored table of versions; a second run changes nothing."""
    stored = KeyedTable(spark, scratch_path(spark, "keyed"), ["c_custkey"])
    stored.create(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"))
    batch = table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderstatus = 'P' THEN o_custkey ELSE -o_custkey END AS c_custkey",
        "o_orderpriority AS c_name", "o_totalprice AS c_acctbal", "o_orderkey")
    for _ in range(2):
        stored.upsert(batch, F.col("o_orderkey"))
    return stored.read()
