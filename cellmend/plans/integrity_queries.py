"""Profile and integrity metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellmend.operators import metrics as M
from cellmend.operators.file_profile import profile_records
from cellmend.plans.catalog import (
    TABLES, dirty_mixed, dirty_money, dirty_null, query, table)

# Oracle columns per table: (expression of the text, cell type by data type).
# Typed columns are classified by their type, text columns by their form.
_COLUMNS = {
    "region": ["r_regionkey:int", "r_name:text"],
    "nation": ["n_nationkey:int", "n_name:text", "n_regionkey:int"],
    "customer": ["c_custkey:int", "c_name:text", "c_nationkey:int", "c_acctbal:float",
                 "c_mktsegment:text"],
    "supplier": ["s_suppkey:int", "s_name:text", "s_nationkey:int", "s_acctbal:float"],
    "part": ["p_partkey:int", "p_name:text", "p_brand:text", "p_type:text", "p_size:int",
             "p_retailprice:float"],
    "orders": ["o_orderkey:int", "o_custkey:int", "o_orderstatus:text", "o_totalprice:float",
               "o_orderdate:time", "o_orderpriority:text"],
    "lineitem": ["l_orderkey:int", "l_partkey:int", "l_suppkey:int", "l_linenumber:int",
                 "l_quantity:float", "l_extendedprice:float", "l_discount:float", "l_tax:float",
                 "l_returnflag:text", "l_linestatus:text", "l_shipdate:time"],
    "events": ["event_id:int", "ts:time", "user_id:int", "event_type:text", "value:float",
               "props:text"],
    "documents": ["doc_id:int", "text:text", "lang:text", "source:text", "n_chars:int"],
    "embeddings": ["vec_id:int", "embedding:time", "label:int"],
    "pages": ["page_id:int", "url:text", "html:text"],
    "benchmark": ["item_id:int", "text:text"],
    "labels": ["doc_id:int", "quality:int", "toxic:int"],
    "conversations": ["conv_id:int", "turn:int", "role:text", "text:text"],
}

_NULLISH_SQL = "('', 'nan', 'none', 'null', 'na', 'n/a', '#n/a', 'nil', '-', '--')"


def clean_sql(text: str) -> str:
    return f"replace(replace(lower(trim(coalesce({text}, ''))), ',', ''), ' ', '')"


def type_sql(text: str) -> str:
    clean = clean_sql(text)
    return (f"CASE WHEN {clean} IN {_NULLISH_SQL} THEN 'null' "
            f"WHEN regexp_matches({clean}, '^-?\\d+$') THEN 'int' "
            f"WHEN regexp_matches({clean}, '^-?\\d+(\\.\\d+)?$') THEN 'float' ELSE 'string' END")


def _cells_sql(name: str, columns: list[str]) -> str:
    parts = []
    for i, spec in enumerate(columns):
        column, kind = spec.split(":")
        text = f"CAST({column} AS VARCHAR)"
        if kind == "text":
            kind_sql, value = type_sql(column), f"lower(trim({column}))"
        else:
            shown = {"int": "int", "float": "float", "time": "string"}[kind]
            kind_sql = f"CASE WHEN {column} IS NULL THEN 'null' ELSE '{shown}' END"
            value = text
        parts.append(f"SELECT '{name}' AS table_name, {i} AS col_idx, '{column}' AS column_name, "
                     f"{value} AS v, {kind_sql} AS t FROM {name}")
    return " UNION ALL ".join(parts)


def profile_sql(cells: str, final: str) -> str:
    return f"""
    WITH cells AS ({cells}),
    counts AS (SELECT table_name, col_idx, column_name, v, t, count(*) AS n
               FROM cells GROUP BY ALL),
    cols AS (
      SELECT table_name, col_idx, column_name, sum(n) AS n_cells,
             coalesce(sum(n) FILTER (WHERE t = 'null'), 0) AS n_null,
             coalesce(sum(n) FILTER (WHERE t = 'int'), 0) AS n_int,
             coalesce(sum(n) FILTER (WHERE t = 'float'), 0) AS n_float,
             coalesce(sum(n) FILTER (WHERE t = 'string'), 0) AS n_string,
             count(*) FILTER (WHERE t <> 'null') AS d,
             coalesce(sum(n) FILTER (WHERE t <> 'null'), 0) AS nf,
             sum(n * log2(n)) FILTER (WHERE t <> 'null') AS s
      FROM counts GROUP BY ALL),
    done AS (
      SELECT *, CASE WHEN nf > 0 THEN abs(log2(nf) - s / nf) END AS h,
             CASE WHEN nf >= 2 THEN abs((log2(nf) - s / nf)
               / CASE WHEN d > 1 THEN log2(d) ELSE 1.0 END - 1) * 100 END AS delta
      FROM cols)
    {final}"""


_TABLE_FINAL = """
    SELECT table_name,
           round(100.0 * sum(n_null) / sum(n_cells), 3)::DOUBLE AS null_pct,
           coalesce(round(100.0 * sum(nf - greatest(n_int, n_float, n_string))
             / nullif(sum(nf), 0), 3), 0)::DOUBLE AS type_deviation_pct,
           coalesce(round(avg(delta), 3), 0)::DOUBLE AS entropy_delta_pct,
           max(n_cells)::BIGINT AS total_rows, sum(n_cells)::BIGINT AS total_cells
    FROM done GROUP BY table_name"""

_COLUMN_FINAL = """
    SELECT table_name, column_name, n_cells::BIGINT AS total_cells,
           n_null::BIGINT AS null_cells, n_int::BIGINT AS n_int, n_float::BIGINT AS n_float,
           n_string::BIGINT AS n_string, d::BIGINT AS distinct_values,
           round(h, 3)::DOUBLE AS entropy_bits, round(delta, 3)::DOUBLE AS entropy_delta_pct
    FROM done"""

_ALL_CELLS = " UNION ALL ".join(_cells_sql(t, _COLUMNS[t]) for t in TABLES)


@query("table_profile", profile_sql(_cells_sql("orders", _COLUMNS["orders"]), _TABLE_FINAL))
def table_profile(spark, sf_dir):
    return M.profile_tables({"orders": table(spark, sf_dir, "orders")})


@query("table_profile_lineitem",
       profile_sql(_cells_sql("lineitem", _COLUMNS["lineitem"]), _TABLE_FINAL))
def table_profile_lineitem(spark, sf_dir):
    return M.profile_tables({"lineitem": table(spark, sf_dir, "lineitem")})


@query("table_profile_all", profile_sql(_ALL_CELLS, _TABLE_FINAL))
def table_profile_all(spark, sf_dir):
    return M.profile_tables({t: table(spark, sf_dir, t) for t in TABLES})


@query("column_profile", profile_sql(_ALL_CELLS, _COLUMN_FINAL))
def column_profile(spark, sf_dir):
    return M.profile_columns({t: table(spark, sf_dir, t) for t in TABLES})


# --- The single metrics on dirty text derived from orders ----------------------

_DIRTY = {
    "amount": dirty_money("o_orderkey"),
    "quantity": dirty_mixed("o_orderkey"),
    "status": dirty_null("o_orderkey", "o_orderstatus"),
    "priority": dirty_null("o_custkey", "o_orderpriority"),
}
_DIRTY_SELECT = ", ".join(f"{sql} AS {name}" for name, sql in _DIRTY.items())


def dirty_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        *[f"{sql} AS {name}" for name, sql in _DIRTY.items()])


_DIRTY_CELLS = (f"WITH d AS (SELECT {_DIRTY_SELECT} FROM orders) " + " UNION ALL ".join(
    f"SELECT 'dirty' AS table_name, {i} AS col_idx, '{c}' AS column_name, "
    f"lower(trim({c})) AS v, {type_sql(c)} AS t FROM d" for i, c in enumerate(_DIRTY)))


@query("dirty_profile", profile_sql(_DIRTY_CELLS, _COLUMN_FINAL))
def dirty_profile(spark, sf_dir):
    return M.profile_columns({"dirty": dirty_orders(spark, sf_dir)})


@query("null_pct", f"""
    WITH d AS (SELECT o_orderstatus AS grp, {_DIRTY_SELECT} FROM orders),
    c AS (SELECT grp, unnest([amount, quantity, status, priority]) AS v FROM d)
    SELECT grp, round(100.0 * count(*) FILTER (WHERE {clean_sql('v')} IN {_NULLISH_SQL})
           / count(*), 3)::DOUBLE AS null_pct
    FROM c GROUP BY grp""")
def null_pct(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderstatus AS grp", *[f"{sql} AS {name}" for name, sql in _DIRTY.items()])
    return M.null_pct(df, ["grp"])


@query("type_deviation", profile_sql(_DIRTY_CELLS, """
    SELECT round(100.0 * sum(nf - greatest(n_int, n_float, n_string)) / sum(nf), 3)::DOUBLE
           AS type_deviation_pct FROM done"""))
def type_deviation(spark, sf_dir):
    return M.type_deviation(dirty_orders(spark, sf_dir))


@query("entropy_delta", profile_sql(_DIRTY_CELLS, """
    SELECT round(avg(delta), 3)::DOUBLE AS entropy_delta_pct FROM done"""))
def entropy_delta(spark, sf_dir):
    return M.entropy_delta_pct(dirty_orders(spark, sf_dir))


@query("field_deviation_rows", """
    WITH d AS (SELECT p_brand, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END AS a,
                      CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END AS b, p_retailprice AS c
               FROM part),
    w AS (SELECT p_brand, (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT AS w,
                 count(*) AS n FROM d GROUP BY ALL)
    SELECT p_brand, round(100.0 * (sum(n) - max(n)) / sum(n), 3)::DOUBLE AS field_deviation_pct,
           sum(n)::BIGINT AS n_rows
    FROM w GROUP BY p_brand""")
def field_deviation_rows(spark, sf_dir):
    df = table(spark, sf_dir, "part").selectExpr(
        "p_brand", "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END AS a",
        "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END AS b", "p_retailprice AS c")
    return M.field_deviation(df, M.filled_width(df.drop("p_brand")), ["p_brand"])


_EVENT_JSON = ("CASE event_id % 4 WHEN 0 THEN concat('{\"id\": ', CAST(event_id AS STRING), "
               "', \"p\": ', props, '}') ELSE props END")


@query("field_deviation_json", f"""
    WITH w AS (SELECT event_type, len(json_keys({_EVENT_JSON})) AS w, count(*) AS n
               FROM events GROUP BY ALL)
    SELECT event_type, round(100.0 * (sum(n) - max(n)) / sum(n), 3)::DOUBLE AS field_deviation_pct,
           sum(n)::BIGINT AS n_rows
    FROM w GROUP BY event_type""")
def field_deviation_json(spark, sf_dir):
    df = table(spark, sf_dir, "events").selectExpr("event_type", f"{_EVENT_JSON} AS record")
    return M.field_deviation(df, M.json_key_width(F.col("record")), ["event_type"])


# --- Metrics of many tables joined to an inventory ------------------------------
# One inventory row per supplier, whose order lines stand for its file, and one
# per nation, for which there is no file.

_LINE = {"quantity": dirty_mixed("l_orderkey"), "flag": dirty_null("l_partkey", "l_returnflag"),
         "status": "l_linestatus", "line": "CAST(l_linenumber AS STRING)"}
_LINE_CELLS = (f"WITH d AS (SELECT l_suppkey, " + ", ".join(f"{sql} AS {c}" for c, sql in _LINE.items())
               + " FROM lineitem) " + " UNION ALL ".join(
                   f"SELECT l_suppkey AS table_name, {i} AS col_idx, '{c}' AS column_name, "
                   f"lower(trim({c})) AS v, {type_sql(c)} AS t FROM d" for i, c in enumerate(_LINE)))
_PER_SUPPLIER = profile_sql(_LINE_CELLS, _TABLE_FINAL.replace(
    "SELECT table_name,", "SELECT table_name AS serial_number, 0.0::DOUBLE AS field_deviation_pct,"))
_INVENTORY = """SELECT s_suppkey AS serial_number, concat(s_name, '.csv') AS filename FROM supplier
    UNION ALL SELECT 10000000 + n_nationkey, concat(n_name, '.csv') FROM nation"""
_METRICS = ", ".join(f"m.{c}" for c in M.METRIC_FIELDS)


def _supplier_inventory(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS serial_number", "concat(s_name, '.csv') AS filename")
    nations = table(spark, sf_dir, "nation").selectExpr(
        "CAST(10000000 + n_nationkey AS BIGINT) AS serial_number", "concat(n_name, '.csv') AS filename")
    return suppliers.unionByName(nations)


def _supplier_metrics(spark, sf_dir):
    """All metrics of the lines of each supplier, in one job."""
    records = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS serial_number", "0 AS block", "l_orderkey * 10 + l_linenumber AS line_no",
        f"array({', '.join(_LINE.values())}) AS fields", f"{len(_LINE)} AS width")
    return profile_records(records, "serial_number", False)


def _metrics_with_errors(spark, sf_dir):
    return M.with_errors(
        _supplier_inventory(spark, sf_dir), _supplier_metrics(spark, sf_dir), "serial_number",
        F.concat(F.lit("File not found: "), F.col("filename")))


_WITH_ERRORS_SQL = f"""
    SELECT i.*, {_METRICS},
           CASE WHEN m.serial_number IS NULL THEN concat('File not found: ', filename) ELSE '' END AS error
    FROM ({_INVENTORY}) i LEFT JOIN ({_PER_SUPPLIER}) m ON m.serial_number = i.serial_number"""


@query("metrics_with_errors", _WITH_ERRORS_SQL)
def metrics_with_errors(spark, sf_dir):
    return _metrics_with_errors(spark, sf_dir)


@query("metrics_summary", f"""
    WITH e AS ({_WITH_ERRORS_SQL}),
    c AS (SELECT count(*)::BIGINT AS files, (count(*) FILTER (WHERE error = ''))::BIGINT AS ok,
                 (count(*) FILTER (WHERE error <> ''))::BIGINT AS errors FROM e)
    """ + " UNION ALL ".join(f"""
    SELECT c.*, '{m}' AS metric, round(avg({m}), 2)::DOUBLE AS mean, round(max({m}), 2)::DOUBLE AS max
    FROM c, e WHERE error = '' GROUP BY ALL""" for m in M.METRICS))
def metrics_summary(spark, sf_dir):
    return M.summary(_metrics_with_errors(spark, sf_dir))


@query("error_files", f"SELECT serial_number, filename, error FROM ({_WITH_ERRORS_SQL}) "
                      "WHERE error <> ''")
def error_files(spark, sf_dir):
    return M.error_files(_metrics_with_errors(spark, sf_dir)).select(
        "serial_number", "filename", "error")


@query("attach_metrics", f"""
    SELECT i.*, {_METRICS}
    FROM ({_INVENTORY}) i LEFT JOIN ({_PER_SUPPLIER}) m ON m.serial_number = i.serial_number""")
def attach_metrics(spark, sf_dir):
    stale = _supplier_inventory(spark, sf_dir).withColumn("null_pct", F.lit(-1.0))
    return M.attach_metrics(stale, _supplier_metrics(spark, sf_dir))
