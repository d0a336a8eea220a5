"""Header detection and schemas, on samples derived from orders.

Six consecutive orders make one file of four columns; the first of them gives
a header row of one of ten styles, the other five give data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cellmend.functions import classify as C
from cellmend.operators import headers as H
from cellmend.plans.catalog import dirty_zip, query, table
from cellmend.plans.cell_queries import STRIP, _PATTERN_TEST

_FILE = "CAST(floor(o_orderkey / 6) AS BIGINT)"
_STYLE = f"{_FILE} % 12"
# One header style per line: four cells, then what the ladder should see.
_STYLES = (
    ("order_id", "orderDate", "Amount", "PRIORITY_CODE"),
    ("id", "date", "qty", "email"),
    ("name", "value", "thing", "other"),
    ("Order Number", "Order date", "total amount", "first priority"),
    ("12", "13.5", "-7", ""),
    ("", " ", "", ""),
    ("Unnamed: 0", "date", "amount", "x"),
    ("bob@site.org", "date", "amount", "x"),
    ("12", "date", "amount", "x"),
    ("name", "name", "id", "1-URGENT"),
    ("1-URGENT", "word", "other", "5-LOW"),
    ("9th", "dateOfOrder", "PRICE", "level"),
)
_DATA = ("CAST(o_custkey AS STRING)", "substr(CAST(o_orderdate AS STRING), 1, 10)",
         "CAST(o_totalprice AS STRING)", "o_orderpriority")


def _cell(i):
    header = " ".join(f"WHEN {s} THEN '{cells[i]}'" for s, cells in enumerate(_STYLES))
    return (f"CASE WHEN o_orderkey % 6 = 0 THEN CASE {_STYLE} {header} END "
            f"ELSE {_DATA[i]} END")


_CELLS_SQL = ("cells AS (" + " UNION ALL ".join(
    f"SELECT {_FILE} AS file_id, o_orderkey % 6 AS row_id, {i} AS col_idx, {_cell(i)} AS value "
    f"FROM orders" for i in range(4)) + ")")


def _rows(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        f"{_FILE} AS file_id", "o_orderkey % 6 AS row_id",
        "array(" + ", ".join(_cell(i) for i in range(4)) + ") AS fields")


def _sample(spark, sf_dir):
    return H.sample_cells(_rows(spark, sf_dir), "file_id")


def _type_sql(s):
    return (f"CASE WHEN {s} = '' THEN NULL WHEN lower({s}) IN ('true', 'false') THEN 'bool' "
            f"WHEN regexp_full_match({s}, '[+-]?\\d+') THEN 'int' "
            f"WHEN regexp_full_match({s}, '[+-]?\\d*\\.\\d+([eE][+-]?\\d+)?') THEN 'float' "
            f"WHEN regexp_full_match({s}, '\\d{{4}}[-/]\\d{{1,2}}[-/]\\d{{1,2}}|"
            f"\\d{{1,2}}[-/]\\d{{1,2}}[-/]\\d{{2,4}}') THEN 'date' "
            f"WHEN regexp_matches(lower({s}), "
            f"'\\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\\b') THEN 'date' "
            f"ELSE 'string' END")


def _token_sql(s):
    return (f"CASE WHEN lower({s}) IN ('dob', 'id', 'qty', 'amt', 'url', 'ssn', 'empid', 'fname', "
            f"'lname', 'email', 'phone', 'addr', 'zip', 'city', 'state', 'country', 'date', "
            f"'year', 'month', 'day') THEN 1.0::DOUBLE "
            f"WHEN regexp_full_match({s}, '[a-z]+(_[a-z0-9]+)+|[a-z]+([A-Z][a-z0-9]+)+|"
            f"[A-Z][a-z0-9]+([A-Z][a-z0-9]+)*|[A-Z0-9]+(_[A-Z0-9]+)+') THEN 0.9 "
            f"WHEN regexp_full_match({s}, '[A-Za-z][A-Za-z0-9_ ]{{0,30}}') "
            f"AND contains({s}, ' ') THEN 0.6 ELSE 0.0 END")


_NUM = "regexp_full_match(h, '[+-]?\\d+(\\.\\d+)?')"


def _gap(name):
    return (f"CASE WHEN d_{name} = 0 THEN abs(h_{name} - d_{name}) "
            f"ELSE abs(h_{name} - d_{name}) / d_{name} END")


_SCORES_SQL = f"""
    {_CELLS_SQL},
    s AS (SELECT file_id, row_id, col_idx, {STRIP.format("coalesce(value, '')")} AS v FROM cells),
    m AS (SELECT *, CASE WHEN v <> '' THEN length(v) END AS len,
                 CASE WHEN v <> '' THEN length(regexp_replace(v, '[^0-9]', '', 'g')) / length(v)
                   END AS dig,
                 CASE WHEN v <> '' THEN length(regexp_replace(v, '[^A-Z]', '', 'g')) / length(v)
                   END AS upp,
                 {_type_sql('v')} AS t,
                 max(v) FILTER (WHERE row_id = 0) OVER (PARTITION BY file_id, col_idx) AS h
          FROM s),
    c AS (SELECT file_id, col_idx, h, max(row_id) AS last_row,
                 bool_or(row_id > 0 AND v <> '' AND h <> '' AND lower(v) = lower(h)) AS repeats,
                 count(t) FILTER (WHERE row_id > 0) AS n_t,
                 count(t) FILTER (WHERE row_id > 0 AND t <> 'string') AS n_num,
                 avg(len) FILTER (WHERE row_id > 0) AS d_len, max(len) FILTER (WHERE row_id = 0) AS h_len,
                 avg(dig) FILTER (WHERE row_id > 0) AS d_dig, max(dig) FILTER (WHERE row_id = 0) AS h_dig,
                 avg(upp) FILTER (WHERE row_id > 0) AS d_upp, max(upp) FILTER (WHERE row_id = 0) AS h_upp
          FROM m GROUP BY ALL),
    f AS (SELECT *, {_token_sql('h')} AS token, (h <> '' AND {_NUM}) AS num,
                 lower(h) LIKE 'unnamed%' AS unnamed,
                 (regexp_matches(h, '[\\w.-]+@[\\w.-]+\\.\\w+') OR regexp_full_match(h, '\\d{{3,}}'))
                   AS pat,
                 coalesce({_type_sql('h')} = 'string' AND n_num >= 0.6 * n_t AND n_t > 0, false)
                   AS shift,
                 coalesce(({_gap('len')} + {_gap('dig')} + {_gap('upp')}) / 3, 0) >= 0.35 AS struct_
          FROM c WHERE h IS NOT NULL),
    g AS (SELECT file_id, max(last_row) + 1 AS n_rows, count(*) AS n_cols,
                 count(*) FILTER (WHERE h <> '') AS n_filled, count(*) FILTER (WHERE num) AS n_numbers,
                 bool_or(unnamed) AS any_unnamed, bool_or(pat) AS any_data,
                 sum(token) / count(*) AS token_avg,
                 count(*) FILTER (WHERE repeats) / count(*) AS repeat_ratio,
                 count(*) FILTER (WHERE shift) / count(*) AS shift_ratio,
                 count(*) FILTER (WHERE struct_) / count(*) AS structural_ratio,
                 coalesce(count(DISTINCT CASE WHEN h <> '' THEN lower(h) END)
                   / nullif(count(*) FILTER (WHERE h <> ''), 0), 0) AS unique_ratio
          FROM f GROUP BY file_id),
    scored AS (SELECT *, n_numbers / n_cols AS number_ratio,
                 token_avg * 1.2 + shift_ratio * 2.0 + (1.0 - repeat_ratio) * 0.8
                 + structural_ratio * 0.5 + unique_ratio * 0.2 AS score FROM g),
    looked AS (SELECT *, CASE WHEN score > 1.2 THEN true
                 WHEN repeat_ratio > 0.4 AND token_avg < 0.25 THEN false
                 WHEN shift_ratio > 0.3 THEN true
                 WHEN token_avg > 0.6 AND repeat_ratio < 0.3 THEN true
                 ELSE score >= 0.9 END AS looks FROM scored)"""

_DETECT_SQL = f"""
    WITH {_SCORES_SQL},
    detected AS (
    SELECT file_id,
      CASE WHEN n_rows < 2 THEN true
           WHEN n_filled = 0 OR n_numbers = n_filled OR any_unnamed OR any_data
             OR number_ratio > 0.2 THEN false ELSE looks END AS has_header,
      CASE WHEN n_rows < 2 OR n_filled = 0 OR n_numbers = n_filled THEN 0.95::DOUBLE
           WHEN any_unnamed THEN 0.9 WHEN any_data THEN 0.85 WHEN number_ratio > 0.2 THEN 0.8
           WHEN number_ratio > 0.1 AND NOT looks THEN 0.7 WHEN looks THEN 0.9 ELSE 0.85 END
        AS header_confidence,
      CASE WHEN n_rows < 2 OR n_filled = 0 OR n_numbers = n_filled OR any_unnamed THEN false
           WHEN any_data OR number_ratio > 0.2 THEN true
           ELSE number_ratio > 0.1 AND NOT looks END AS needs_llm_review,
      CASE WHEN n_rows < 2 THEN 'Insufficient rows' WHEN n_filled = 0 THEN 'All blank'
           WHEN n_numbers = n_filled THEN 'All numeric'
           WHEN any_unnamed THEN 'Contains ''unnamed'''
           WHEN any_data THEN 'Contains email/phone/location patterns - flagged for LLM review'
           WHEN number_ratio > 0.2 THEN concat('Contains ', n_numbers, '/', n_cols,
             ' numeric values - likely data, flagged for LLM review')
           WHEN number_ratio > 0.1 AND NOT looks THEN
             'Borderline case with some numbers - flagged for LLM review'
           ELSE 'Normal detection' END AS detection_reason
    FROM looked)"""


@query("header_token_score", f"""
    WITH {_CELLS_SQL}, s AS (SELECT {STRIP.format("coalesce(value, '')")} AS v FROM cells)
    SELECT v AS token, {_token_sql('v')}::DOUBLE AS score, count(*)::BIGINT AS n
    FROM s GROUP BY ALL""")
def header_token_score(spark, sf_dir):
    token = C.strip(F.coalesce("value", F.lit("")))
    return (_sample(spark, sf_dir).groupBy(token.alias("token")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("score", C.header_token_score(F.col("token"))))


@query("row_metrics", f"""
    WITH {_SCORES_SQL}
    SELECT file_id, col_idx, round(d_len, 6)::DOUBLE AS data_length,
           round(d_dig, 6)::DOUBLE AS data_digit_ratio, round(d_upp, 6)::DOUBLE AS data_upper_ratio
    FROM f""")
def row_metrics(spark, sf_dir):
    return H.header_columns(_sample(spark, sf_dir), "file_id").select(
        "file_id", "col_idx",
        *[F.round(m, 6).alias(m) for m in ("data_length", "data_digit_ratio", "data_upper_ratio")])


@query("header_score", f"""
    WITH {_SCORES_SQL}
    SELECT file_id, n_rows::BIGINT AS n_rows, n_cols::BIGINT AS n_cols,
           round(number_ratio, 6)::DOUBLE AS number_ratio, round(token_avg, 6)::DOUBLE AS token_avg,
           round(repeat_ratio, 6)::DOUBLE AS repeat_ratio, round(shift_ratio, 6)::DOUBLE AS shift_ratio,
           round(structural_ratio, 6)::DOUBLE AS structural_ratio,
           round(unique_ratio, 6)::DOUBLE AS unique_ratio, round(score, 6)::DOUBLE AS score
    FROM scored""")
def header_score(spark, sf_dir):
    scored = H.header_scores(_sample(spark, sf_dir), "file_id")
    ratios = ["number_ratio", "token_avg", "repeat_ratio", "shift_ratio", "structural_ratio",
              "unique_ratio", "score"]
    return scored.select("file_id", F.col("n_rows").cast("bigint").alias("n_rows"), "n_cols",
                         *[F.round(r, 6).alias(r) for r in ratios])


@query("header_detect", f"{_DETECT_SQL} SELECT * FROM detected")
def header_detect(spark, sf_dir):
    return H.detect_headers(_sample(spark, sf_dir), "file_id")


@query("header_detect_summary", f"""{_DETECT_SQL}
    SELECT count(*)::BIGINT AS files, (count(*) FILTER (WHERE needs_llm_review))::BIGINT AS flagged
    FROM detected""")
def header_detect_summary(spark, sf_dir):
    return H.review_summary(H.detect_headers(_sample(spark, sf_dir), "file_id"))


@query("header_simple", f"""
    WITH {_CELLS_SQL}
    SELECT file_id, bool_and(NOT regexp_matches(replace(replace(trim(coalesce(value, '')), ',', ''),
             ' ', ''), '^-?\\d+(\\.\\d+)?$')) AS has_header
    FROM cells WHERE row_id = 0 GROUP BY file_id""")
def header_simple(spark, sf_dir):
    return H.simple_headers(_sample(spark, sf_dir), "file_id")


# --- Names for files without a header: 100 customers make a file -------------------

_NOTES = {
    0: "CASE WHEN c_custkey % 10 = 0 THEN 'n/a' ELSE concat('c', CAST(c_custkey AS STRING), "
       "'@mail.org') END",
    1: "c_name",
    2: "concat('555-', lpad(CAST(c_custkey % 900 + 100 AS STRING), 3, '0'), '-0000')",
    3: "CASE c_custkey % 2 WHEN 0 THEN concat('$', CAST(c_custkey AS STRING)) "
       "ELSE concat('1,', lpad(CAST(c_custkey % 1000 AS STRING), 3, '0')) END",
    4: dirty_zip("c_custkey"),
    5: "concat('u', CAST(c_custkey AS STRING), '@x.com')",
    6: "concat('20', lpad(CAST(c_custkey % 30 AS STRING), 2, '0'), '-01-15')",
}
_NOTE_CELLS = ("cells AS (" + " UNION ALL ".join(
    f"SELECT CAST(floor(c_custkey / 100) AS BIGINT) AS file_id, c_custkey % 100 AS row_id, "
    f"{i} AS col_idx, {sql} AS value FROM customer" for i, sql in _NOTES.items()) + ")")


def _note_cells(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "CAST(floor(c_custkey / 100) AS BIGINT) AS file_id", "c_custkey % 100 AS row_id",
        "array(" + ", ".join(_NOTES.values()) + ") AS fields")
    return H.sample_cells(rows, "file_id")


def _rate_sql(kind, test):
    return (f"WHEN count(*) FILTER (WHERE v <> '' AND {test}) >= 0.8 * count(*) "
            f"FILTER (WHERE v <> '') AND count(*) FILTER (WHERE v <> '') > 0 THEN '{kind}'")


_RATES = " ".join(_rate_sql(kind, _PATTERN_TEST[kind].format("v") + (
    " AND regexp_matches(v, '[$€¥£,]')" if kind == "currency" else ""))
    for kind in ("email", "url", "date", "zip", "phone", "currency"))


@query("suggest_headers", f"""
    WITH {_NOTE_CELLS},
    s AS (SELECT file_id, col_idx, {STRIP.format('value')} AS v FROM cells),
    k AS (SELECT file_id, col_idx, CASE {_RATES} END AS kind FROM s GROUP BY ALL),
    n AS (SELECT *, row_number() OVER (PARTITION BY file_id, kind ORDER BY col_idx) AS nth FROM k)
    SELECT file_id, col_idx, CASE WHEN kind IS NULL THEN concat('col_', col_idx)
             WHEN nth > 1 THEN concat(kind, '_', nth) ELSE kind END AS name FROM n""")
def suggest_headers(spark, sf_dir):
    return H.suggest_headers(_note_cells(spark, sf_dir), "file_id")


@query("prompt_rows", f"""
    WITH {_CELLS_SQL},
    r AS (SELECT file_id, row_id, string_agg(coalesce(value, ''), ' | ' ORDER BY col_idx) AS line
          FROM cells GROUP BY ALL)
    SELECT file_id, 4::INT AS width, concat(
      'Below are sample records of a table whose columns have no names. ',
      'Width: 4. Records shown: ', count(*), '. Fields are separated by '' | ''.', chr(10),
      'Name every column by what its values mean, in lower_snake_case. ',
      'Answer with a JSON array of texts and nothing else: one name per column, left to right.',
      chr(10), string_agg(line, chr(10) ORDER BY row_id)) AS prompt
    FROM r GROUP BY file_id""")
def prompt_rows(spark, sf_dir):
    return H.build_prompts(_rows(spark, sf_dir), "file_id")


_RESPONSE = ("CASE c_custkey % 6 WHEN 0 THEN concat('[\"id\", \"', c_mktsegment, '\", \"x\", \"y\"]') "
             "WHEN 1 THEN concat('Sure: [\"', c_name, '\"] as asked.') WHEN 2 THEN 'no idea' "
             "WHEN 3 THEN '[1, 2]' WHEN 4 THEN '[\"open' WHEN 5 THEN '{\"names\": [\"a\", \"b\"]}' END")


@query("parse_suggestions", """
    SELECT c_custkey AS file_id, CASE c_custkey % 6
      WHEN 0 THEN concat('id|', c_mktsegment, '|x') WHEN 1 THEN c_name
      ELSE 'col_0|col_1|col_2' END AS generated_headers FROM customer""")
def parse_suggestions(spark, sf_dir):
    responses = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS file_id", f"{_RESPONSE} AS response", "3 AS width")
    return H.parse_suggestions(responses, "file_id").withColumn(
        "generated_headers", F.array_join("generated_headers", "|"))


@query("apply_headers", """
    SELECT c_custkey AS id, c_name AS "full.name", c_nationkey AS column_0, c_acctbal AS column_1,
           c_mktsegment AS column_2 FROM customer""")
def apply_headers(spark, sf_dir):
    return H.apply_headers(table(spark, sf_dir, "customer"), ["id", "full.name"])


# --- Schemas ---------------------------------------------------------------------

_TYPED = {
    0: "CAST(o_custkey AS STRING)",
    1: "CASE WHEN o_orderkey % 400 = 7 THEN '99999999999' ELSE CAST(o_custkey AS STRING) END",
    2: "CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN '-1.5' ELSE '' END",
    3: "substr(CAST(o_orderdate AS STRING), 1, 10)",
    4: "CASE o_orderkey % 2 WHEN 0 THEN '2024-01-05' ELSE '2024-01-05 10:20:30' END",
    5: "CASE o_orderkey % 2 WHEN 0 THEN 'TRUE' ELSE 'false' END",
    6: "o_orderpriority",
    7: "''",
}
_TYPED_CELLS = ("cells AS (" + " UNION ALL ".join(
    f"SELECT CAST(floor(o_orderkey / 600) AS BIGINT) AS file_id, {i} AS col_idx, {sql} AS value "
    f"FROM orders" for i, sql in _TYPED.items()) + ")")
_SCHEMA_SQL = f"""
    {_TYPED_CELLS},
    v AS (SELECT file_id, col_idx, nullif({STRIP.format('value')}, '') AS v FROM cells),
    t AS (
      SELECT file_id, col_idx, CASE
        WHEN count(v) = 0 THEN 'string'
        WHEN bool_and(try_cast(v AS INTEGER) IS NOT NULL AND regexp_full_match(v, '[+-]?\\d+'))
          FILTER (WHERE v IS NOT NULL) THEN 'int'
        WHEN bool_and(try_cast(v AS BIGINT) IS NOT NULL AND regexp_full_match(v, '[+-]?\\d+'))
          FILTER (WHERE v IS NOT NULL) THEN 'bigint'
        WHEN bool_and(try_cast(v AS DOUBLE) IS NOT NULL) FILTER (WHERE v IS NOT NULL) THEN 'double'
        WHEN bool_and(regexp_full_match(v, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}')
          AND try_cast(v AS DATE) IS NOT NULL) FILTER (WHERE v IS NOT NULL) THEN 'date'
        WHEN bool_and(try_cast(v AS TIMESTAMP) IS NOT NULL) FILTER (WHERE v IS NOT NULL)
          THEN 'timestamp'
        WHEN bool_and(lower(v) IN ('true', 'false')) FILTER (WHERE v IS NOT NULL) THEN 'boolean'
        ELSE 'string' END AS type
      FROM v GROUP BY ALL)"""


@query("infer_schema", f"""
    WITH {_SCHEMA_SQL}
    SELECT file_id, concat('[', string_agg(concat('{{"name":"f', col_idx, '","type":"', type,
             '","nullable":true}}'), ',' ORDER BY col_idx), ']') AS schema
    FROM t GROUP BY file_id""")
def infer_schema(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "CAST(floor(o_orderkey / 600) AS BIGINT) AS file_id", "o_orderkey % 600 AS row_id",
        "array(" + ", ".join(_TYPED.values()) + ") AS fields")
    cells = H.sample_cells(rows, "file_id")
    names = rows.filter("row_id = 0").select(
        "file_id", F.posexplode("fields").alias("col_idx", "value")).select(
        "file_id", "col_idx", F.concat(F.lit("f"), "col_idx").alias("name"))
    return H.infer_schema(cells, names, "file_id").select(
        "file_id", F.to_json("schema").alias("schema"))


@query("schema_type_map", """
    SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'long' WHEN 1 THEN 'integer'
      WHEN 2 THEN 'double' WHEN 3 THEN 'float' WHEN 4 THEN 'string' WHEN 5 THEN 'boolean'
      WHEN 6 THEN 'timestamp' ELSE p_brand END AS type FROM part""")
def schema_type_map(spark, sf_dir):
    dtypes = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "CASE p_partkey % 8 WHEN 0 THEN 'int64' WHEN 1 THEN 'int32' "
        "WHEN 2 THEN 'float64' WHEN 3 THEN 'float32' WHEN 4 THEN 'object' WHEN 5 THEN 'bool' "
        "WHEN 6 THEN 'datetime64[ns]' ELSE p_brand END AS dtype")
    return dtypes.select("p_partkey", H.schema_type(F.col("dtype")).alias("type"))



@query("schema_inventory", f"""{_DETECT_SQL},
    names AS (SELECT file_id, concat('[', string_agg(concat('{{"name":"', v, '","type":"',
                CASE col_idx WHEN 0 THEN 'int' WHEN 1 THEN 'date' WHEN 2 THEN 'double'
                  ELSE 'string' END, '","nullable":true}}'), ',' ORDER BY col_idx), ']') AS schema
              FROM s WHERE row_id = 0 GROUP BY file_id),
    files AS (SELECT DISTINCT {_FILE} AS file_id FROM orders),
    clear AS (SELECT *, has_header AND NOT needs_llm_review AS ok FROM detected)
    SELECT file_id, has_header, header_confidence, needs_llm_review, detection_reason,
           CASE WHEN ok THEN names.schema ELSE '[]' END AS schema,
           NOT ok AS has_suggestions
    FROM files JOIN clear USING (file_id) JOIN names USING (file_id)""")
def schema_inventory(spark, sf_dir):
    cells = _sample(spark, sf_dir)
    inventory = table(spark, sf_dir, "orders").selectExpr(f"{_FILE} AS file_id").distinct()
    return H.schema_inventory(inventory, cells, cells, "file_id").withColumn(
        "has_suggestions", F.col("generated_headers") != "[]").drop("generated_headers")
