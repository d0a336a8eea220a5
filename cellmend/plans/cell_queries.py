"""Cell classifiers, patterns and semantic types."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellmend.functions import classify as C
from cellmend.functions.semantic import Rule, semantic_type
from cellmend.operators.cells import text_cells
from cellmend.plans.catalog import (
    dirty_date, dirty_email, dirty_mixed, dirty_money, dirty_null, dirty_phone,
    dirty_zip, query, table)
from cellmend.plans.integrity_queries import _NULLISH_SQL, clean_sql, type_sql

STRIP = "trim({}, concat(chr(32), chr(9), chr(10), chr(13), chr(12), chr(11)))"

_DIRTY = {
    "amount": dirty_money("o_orderkey"),
    "quantity": dirty_mixed("o_orderkey"),
    "status": dirty_null("o_orderkey", "o_orderstatus"),
    "ordered": dirty_date("o_custkey"),
}
_LONG_SQL = ("WITH w AS (SELECT o_orderkey AS k, "
             + ", ".join(f"{sql} AS {c}" for c, sql in _DIRTY.items()) + " FROM orders), "
             "d AS (" + " UNION ALL ".join(
                 f"SELECT k, '{c}' AS column_name, {c} AS v FROM w" for c in _DIRTY) + ")")


def dirty_cells(spark, sf_dir) -> DataFrame:
    """(column_name, v): four dirty columns over orders as one long column."""
    wide = table(spark, sf_dir, "orders").selectExpr(
        *[f"{sql} AS {name}" for name, sql in _DIRTY.items()])
    return text_cells(wide).withColumnRenamed("value", "v")


def _tally(cells, label, *by):
    return cells.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))


@query("nullish_counts", f"""{_LONG_SQL}
    SELECT column_name, (count(*) FILTER (WHERE {clean_sql('v')} IN {_NULLISH_SQL}))::BIGINT
           AS nullish, count(*)::BIGINT AS cells FROM d GROUP BY column_name""")
def nullish_counts(spark, sf_dir):
    return dirty_cells(spark, sf_dir).groupBy("column_name").agg(
        F.count_if(C.is_nullish(F.col("v"))).alias("nullish"),
        F.count(F.lit(1)).alias("cells"))


@query("cell_types", f"""{_LONG_SQL}
    SELECT column_name, {type_sql('v')} AS cell_type, count(*)::BIGINT AS n
    FROM d GROUP BY ALL""")
def cell_types(spark, sf_dir):
    return _tally(dirty_cells(spark, sf_dir), C.infer_cell_type(F.col("v")).alias("cell_type"),
                  "column_name")


@query("cell_types_lenient", f"""{_LONG_SQL},
    t AS (SELECT column_name, lower({STRIP.format("coalesce(v, '')")}) AS s FROM d)
    SELECT column_name,
           CASE WHEN s IN {_NULLISH_SQL} THEN 'null'
                WHEN regexp_matches(replace(replace(s, ',', ''), ' ', ''), '^[+-]?[0-9]+$')
                  THEN 'int'
                WHEN try_cast(replace(s, ',', '') AS DOUBLE) IS NOT NULL THEN 'float'
                ELSE 'string' END AS cell_type, count(*)::BIGINT AS n
    FROM t GROUP BY ALL""")
def cell_types_lenient(spark, sf_dir):
    return _tally(dirty_cells(spark, sf_dir),
                  C.infer_cell_type_lenient(F.col("v")).alias("cell_type"), "column_name")


_HEADERISH = ("CASE o_orderkey % 9 WHEN 0 THEN 'TRUE' WHEN 1 THEN concat('+', CAST(o_orderkey AS "
              "STRING)) WHEN 2 THEN concat('.', CAST(o_orderkey AS STRING), 'e5') "
              "WHEN 3 THEN concat(substr(CAST(o_orderdate AS STRING), 1, 10), ' ') "
              "WHEN 4 THEN '1/2/24' WHEN 5 THEN concat('12 Mar ', o_orderpriority) "
              "WHEN 6 THEN 'marching' WHEN 7 THEN ' ' ELSE o_orderpriority END")


@query("header_cell_types", f"""
    WITH t AS (SELECT {STRIP.format(_HEADERISH)} AS s FROM orders)
    SELECT CASE WHEN s IS NULL OR s = '' THEN NULL
                WHEN lower(s) IN ('true', 'false') THEN 'bool'
                WHEN regexp_full_match(s, '[+-]?\\d+') THEN 'int'
                WHEN regexp_full_match(s, '[+-]?\\d*\\.\\d+([eE][+-]?\\d+)?') THEN 'float'
                WHEN regexp_full_match(s, '\\d{{4}}[-/]\\d{{1,2}}[-/]\\d{{1,2}}') THEN 'date'
                WHEN regexp_full_match(s, '\\d{{1,2}}[-/]\\d{{1,2}}[-/]\\d{{2,4}}') THEN 'date'
                WHEN regexp_matches(lower(s),
                  '\\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\\b') THEN 'date'
                ELSE 'string' END AS cell_type, count(*)::BIGINT AS n
    FROM t GROUP BY ALL""")
def header_cell_types(spark, sf_dir):
    cells = table(spark, sf_dir, "orders").selectExpr(f"{_HEADERISH} AS v")
    return _tally(cells, C.header_cell_type(F.col("v")).alias("cell_type"))


@query("data_patterns", f"""
    WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents),
    hits AS (SELECT DISTINCT doc_id FROM w
             WHERE regexp_matches({STRIP.format('word')}, '[\\w.-]+@[\\w.-]+\\.\\w+')
                OR regexp_matches({STRIP.format('word')}, '^\\d{{3,}}$'))
    SELECT source, (count(h.doc_id))::BIGINT AS with_data, count(*)::BIGINT AS documents
    FROM documents LEFT JOIN hits h USING (doc_id) GROUP BY source""")
def data_patterns(spark, sf_dir):
    words = F.split("text", " ")
    return table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count_if(C.has_data_patterns(words)).alias("with_data"),
        F.count(F.lit(1)).alias("documents"))


_PATTERN_COLUMNS = {
    "email": dirty_email("o_orderkey"), "url": "concat('http://a.example/', o_orderpriority)",
    "zip": dirty_zip("o_orderkey"), "phone": dirty_phone("o_orderkey"),
    "currency": dirty_money("o_orderkey"), "date": dirty_date("o_orderkey"),
}
_PATTERN_TEST = {
    "email": "regexp_full_match({}, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+"
             "\\.(com|org|net|edu|in|co\\.uk|gov|de|fr|au)')",
    "url": "regexp_full_match({}, 'https?://[^\\s]+')",
    "zip": "regexp_full_match({}, '\\d{{5}}(-\\d{{4}})?')",
    "phone": "regexp_full_match({}, '(\\+?1[-.\\s]?)?\\(?\\d{{3}}\\)?[-.\\s]?\\d{{3}}"
             "[-.\\s]?\\d{{4}}')",
    "currency": "regexp_full_match({}, '[(]?[+-]?[$€¥£]?\\s*[+-]?(\\d{{1,3}}(,\\d{{3}})+|\\d+)"
                "(\\.\\d+)?[)]?')",
    "date": "(regexp_full_match({0}, '\\d{{4}}[/-]\\d{{2}}[/-]\\d{{2}}') OR "
            "regexp_full_match({0}, '\\d{{2}}[/-]\\d{{1,2}}[/-]\\d{{4}}'))",
}


@query("pattern_registry", " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, (count(*) FILTER (WHERE "
    f"{_PATTERN_TEST[kind].format(STRIP.format(sql))}))::BIGINT AS matching, "
    f"count({sql})::BIGINT AS filled FROM orders" for kind, sql in _PATTERN_COLUMNS.items()))
def pattern_registry(spark, sf_dir):
    wide = table(spark, sf_dir, "orders").selectExpr(
        *[f"{sql} AS {kind}" for kind, sql in _PATTERN_COLUMNS.items()])
    totals = wide.agg(
        *[F.count_if(C.matches_pattern(F.col(k), k)).alias(f"m_{k}") for k in _PATTERN_COLUMNS],
        *[F.count(k).alias(f"f_{k}") for k in _PATTERN_COLUMNS])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(f"m_{k}").alias("matching"),
                 F.col(f"f_{k}").alias("filled")) for k in _PATTERN_COLUMNS])))


# --- Semantic types of column names derived from the part table ----------------

_NAME = ("concat(p_type, CASE p_partkey % 26 WHEN 0 THEN '_Mobile' WHEN 1 THEN '_unitPrice' "
         "WHEN 2 THEN '_created' WHEN 3 THEN '_author' WHEN 4 THEN '_street' "
         "WHEN 5 THEN '_email_address' WHEN 6 THEN '_email' WHEN 7 THEN '_website' "
         "WHEN 8 THEN '_postal' WHEN 9 THEN '_pct' WHEN 10 THEN '_interest_rate_pct' "
         "WHEN 11 THEN '_cancelled' WHEN 12 THEN '_candidate' WHEN 13 THEN '_filename' "
         "WHEN 14 THEN '_contact_email' WHEN 15 THEN '_corporate_id' "
         "ELSE concat('_', p_name) END)")
_SEMANTIC_SQL = """CASE
    WHEN regexp_matches(lower(n), 'phone|tel|mobile|cell|contact') THEN 'phone'
    WHEN regexp_matches(lower(n), 'price|cost|amount|salary|revenue|income|total|rate')
      THEN 'currency'
    WHEN regexp_matches(lower(n), 'date|dob|created|updated|birth') THEN 'date'
    WHEN regexp_matches(lower(n), 'fname|lname|name|author|person') THEN 'name'
    WHEN regexp_matches(lower(n), 'address|street|location|addr') THEN 'address'
    WHEN regexp_matches(lower(n), 'email|mail') THEN 'email'
    WHEN regexp_matches(lower(n), 'url|website|link') THEN 'url'
    WHEN regexp_matches(lower(n), 'zip|postal|zipcode') THEN 'zip'
    WHEN regexp_matches(lower(n), 'percent|pct') THEN 'percentage' END"""
_RULES = [Rule("email", "email"), Rule("standard", "bulk")]


@query("semantic_types", f"""
    WITH c AS (SELECT {_NAME} AS n FROM part)
    SELECT n AS column_name, {_SEMANTIC_SQL} AS semantic_type, count(*)::BIGINT AS columns
    FROM c GROUP BY ALL""")
def semantic_types(spark, sf_dir):
    names = table(spark, sf_dir, "part").selectExpr(f"{_NAME} AS column_name")
    return names.groupBy("column_name").agg(F.count(F.lit(1)).alias("columns")).withColumn(
        "semantic_type", semantic_type(F.col("column_name")))


@query("semantic_types_custom", f"""
    WITH c AS (SELECT {_NAME} AS n FROM part)
    SELECT n AS column_name,
           CASE WHEN lower(n) LIKE '%email%' THEN 'email'
                WHEN lower(n) LIKE '%standard%' THEN 'bulk' ELSE {_SEMANTIC_SQL} END
             AS semantic_type, count(*)::BIGINT AS columns
    FROM c GROUP BY ALL""")
def semantic_types_custom(spark, sf_dir):
    names = table(spark, sf_dir, "part").selectExpr(f"{_NAME} AS column_name")
    return names.groupBy("column_name").agg(F.count(F.lit(1)).alias("columns")).withColumn(
        "semantic_type", semantic_type(F.col("column_name"), _RULES))
