"""Files written from the tables and read back: text, JSON, round trips.

Each query writes its files to a fresh path in the session's shared folder, so
the reading side works on data as large as the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cellmend.functions.normalize import quoted
from cellmend.operators.file_profile import profile_json, profile_records
from cellmend.operators.file_stages import clean_files, scan_schemas
from cellmend.operators.integrity_scan import scan_files
from cellmend.operators.metrics import field_deviation
from cellmend.operators.ordering import scratch_path
from cellmend.plans.catalog import dirty_mixed, dirty_money, dirty_null, dirty_phone, query, table
from cellmend.plans.cleaning_queries import name_sql, phone_sql
from cellmend.plans.integrity_queries import _TABLE_FINAL, profile_sql, type_sql
from cellmend.sources import delimited, json as J, sinks
from cellmend.sources.listing import scan_inventory
from cellmend.sources.text import read_lines

# --- Delimited text ------------------------------------------------------------

# Three fields, the second quoted with a comma and doubled quotes inside.
_LINE = ("concat(CAST(p_partkey AS STRING), '{sep}\"', p_name, '{sep} \"\"', p_brand, '\"\"\"{sep}', "
         "p_type, CASE WHEN p_partkey % 9 = 0 THEN '{sep}extra' ELSE '' END)")
_PART_CELLS = """
    SELECT 0 AS col_idx, CAST(p_partkey AS VARCHAR) AS value FROM part
    UNION ALL SELECT 1, concat(p_name, '{sep} "', p_brand, '"') FROM part
    UNION ALL SELECT 2, p_type FROM part
    UNION ALL SELECT 3, 'extra' FROM part WHERE p_partkey % 9 = 0"""


def _write_lines(spark, sf_dir, line, source, label):
    path = scratch_path(spark, label)
    table(spark, sf_dir, source).selectExpr(f"{line} AS value").write.text(path)
    return path


@query("read_csv_cells", _PART_CELLS.format(sep=","))
def read_csv_cells(spark, sf_dir):
    path = _write_lines(spark, sf_dir, _LINE.format(sep=","), "part", "csv")
    rows = delimited.read_delimited_records(spark, path)
    return delimited.record_cells(rows).select("col_idx", "value")


@query("read_tsv_cells", _PART_CELLS.replace("{sep}", "\t"))
def read_tsv_cells(spark, sf_dir):
    path = _write_lines(spark, sf_dir, _LINE.format(sep="\\t"), "part", "tsv")
    return delimited.record_cells(delimited.read_tsv_records(spark, path)).select("col_idx", "value")


@query("read_quoted_newlines", """
    SELECT doc_id, replace(text, chr(13), ' ') AS text, lang, 3::INT AS width FROM documents""")
def read_quoted_newlines(spark, sf_dir):
    """Whole documents as quoted fields: records that span many lines."""
    line = ("concat(CAST(doc_id AS STRING), ',\"', replace(replace(text, '\\r', ' '), '\"', '\"\"'), "
            "'\",', lang)")
    path = _write_lines(spark, sf_dir, line, "documents", "multiline")
    rows = delimited.records(read_lines(spark, path), ",", multiline="auto")
    return rows.select(F.col("fields")[0].cast("bigint").alias("doc_id"),
                       F.col("fields")[1].alias("text"), F.col("fields")[2].alias("lang"), "width")


# One file per part size, in splits of 100 keys; some lines open a quote, which
# the next such line closes, if there is one.
_STRAY = "p_partkey % 37 = 5"


@query("record_problems", f"""
    WITH l AS (SELECT p_size, {_STRAY} AS stray,
                 row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS number FROM part)
    SELECT p_size AS file_path, concat('Unclosed quote from line ', max(number) FILTER (stray)) AS error
    FROM l GROUP BY p_size HAVING count(*) FILTER (stray) % 2 = 1""")
def record_problems(spark, sf_dir):
    """Files that end inside a quote, with the line that opens it."""
    lines = table(spark, sf_dir, "part").selectExpr(
        "p_size AS file_path", "p_partkey - p_partkey % 100 AS block", "p_partkey AS line_no",
        f"CASE WHEN {_STRAY} THEN concat('\"', p_name) ELSE concat(p_name, ',', p_type) END AS line")
    return delimited.record_problems(lines)


@query("sound_records", f"""
    WITH l AS (SELECT *, sum(CAST({_STRAY} AS INT)) OVER (PARTITION BY p_size) AS strays FROM part)
    SELECT p_size AS file_path, p_partkey FROM l WHERE strays % 2 = 0 AND NOT ({_STRAY})
      AND (SELECT count(*) FROM part s WHERE s.p_size = l.p_size AND s.p_partkey % 37 = 5
           AND s.p_partkey < l.p_partkey) % 2 = 0""")
def sound_records(spark, sf_dir):
    """Records outside quoted runs, of the files without problems, written and
    read back. The broken files do not stop the others."""
    path = scratch_path(spark, "strays")
    table(spark, sf_dir, "part").selectExpr(
        "p_size", "p_partkey",
        f"CASE WHEN {_STRAY} THEN concat('\"', p_name) ELSE concat('k', p_partkey, ',', p_type) END AS value"
    ).repartition("p_size").sortWithinPartitions("p_size", "p_partkey").select("p_size", "value").write.partitionBy(
        "p_size").text(path)
    rows, _ = delimited.read_delimited(spark, path, ",")
    key = F.regexp_extract(F.col("fields")[0], r"^k(\d+)$", 1)
    return rows.filter(key != "").select(
        F.regexp_extract("file_path", r"p_size=(\d+)", 1).cast("int").alias("file_path"),
        key.cast("bigint").alias("p_partkey"))


@query("read_delimited_table", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer""")
def read_delimited_table(spark, sf_dir):
    path = scratch_path(spark, "table")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment").write.csv(
        path, sep="|", header=True)
    return delimited.read_delimited_table(spark, path, sep="|")


# Lines of one file per part size, with a separator of its own; every fifth
# size has none at all.
_SEPARATED = ("concat(CAST(p_partkey AS STRING), {sep}, replace(p_name, ' ', {inner}), {sep}, p_type)")
_SEP = ("CASE p_size % 5 WHEN 0 THEN ',' WHEN 1 THEN {tab} WHEN 2 THEN '|' WHEN 3 THEN ';' "
        "ELSE ' ' END")
_INNER = "CASE WHEN p_partkey % 3 = 0 THEN ',' ELSE ' ' END"


@query("detect_delimiter", f"""
    WITH l AS (SELECT p_size AS file_path, p_partkey,
                 {_SEPARATED.format(sep=_SEP.format(tab='chr(9)'), inner=_INNER)} AS line,
                 row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS r FROM part),
    s AS (SELECT unnest([',', chr(9), '|', ';']) AS sep, unnest([0, -1, -2, -3]) AS pref),
    w AS (SELECT file_path, sep, pref, length(line) - length(replace(line, sep, '')) + 1 AS width,
                 count(*) AS n FROM l, s WHERE r <= 20 GROUP BY ALL),
    p AS (SELECT file_path, sep, pref, max(n) / sum(n) AS share,
                 arg_max(width, n * 1000 + width) AS width FROM w GROUP BY ALL),
    best AS (SELECT file_path, sep, row_number() OVER (
               PARTITION BY file_path ORDER BY share DESC, width DESC, pref DESC) AS r
             FROM p WHERE width > 1)
    SELECT DISTINCT l.file_path, coalesce(best.sep, ',') AS sep
    FROM l LEFT JOIN best ON best.file_path = l.file_path AND best.r = 1""")
def detect_delimiter(spark, sf_dir):
    lines = table(spark, sf_dir, "part").selectExpr(
        "p_size AS file_path", "0 AS block", "p_partkey AS line_no",
        f"{_SEPARATED.format(sep=_SEP.format(tab='char(9)'), inner=_INNER)} AS line")
    return delimited.detect_delimiter(lines)


@query("sample_rows", """
    SELECT o_custkey AS file_path, o_orderpriority AS line, r - 1 AS row_id FROM (
      SELECT *, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey))::INT AS r
      FROM orders) t WHERE r <= 6""")
def sample_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS file_path", "0 AS block", "o_orderkey AS line_no", "o_orderpriority AS line")
    return delimited.first_rows(lines, 6).select("file_path", "line", "row_id")


_RAGGED = ("CASE p_partkey % 12 WHEN 0 THEN '' WHEN 1 THEN concat(p_name, ',\"a,b\"') "
           "WHEN 2 THEN concat(p_name, ',x,y') WHEN 3 THEN concat('\"', p_name, '\"\",,\",') "
           "ELSE concat(p_name, ',', p_type) END")


@query("field_deviation_raw", f"""
    WITH l AS (SELECT p_size, CASE p_partkey % 12 WHEN 0 THEN 0 WHEN 2 THEN 3 ELSE 2 END AS w
               FROM part),
    n AS (SELECT p_size, w, count(*) AS n FROM l GROUP BY ALL)
    SELECT p_size AS file_path, round(100.0 * (sum(n) - max(n)) / sum(n), 3)::DOUBLE
             AS field_deviation_pct, sum(n)::BIGINT AS n_rows FROM n GROUP BY p_size""")
def field_deviation_raw(spark, sf_dir):
    lines = table(spark, sf_dir, "part").selectExpr(
        "p_size AS file_path", "0 AS block", "p_partkey AS line_no", f"{_RAGGED} AS line")
    rows = delimited.records(lines, ",", multiline=False)
    return field_deviation(rows, F.col("width"), ["file_path"])


# --- Profiles of files -----------------------------------------------------------

_CSV = {"quantity": dirty_mixed("o_orderkey"), "status": dirty_null("o_orderkey", "o_orderstatus"),
        "priority": "o_orderpriority"}
_CSV_CELLS = (f"WITH d AS (SELECT c_mktsegment AS g, "
              + ", ".join(f"{sql} AS {c}" for c, sql in _CSV.items())
              + " FROM orders JOIN customer ON o_custkey = c_custkey) " + " UNION ALL ".join(
                  f"SELECT g AS table_name, {i} AS col_idx, '{c}' AS column_name, "
                  f"lower(trim({c})) AS v, {type_sql(c)} AS t FROM d" for i, c in enumerate(_CSV)))


def _orders_by_segment(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    segments = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return orders.join(segments, orders.o_custkey == segments.c_custkey).selectExpr(
        "c_mktsegment", *[f"{sql} AS {c}" for c, sql in _CSV.items()])


@query("profile_csv_folders", profile_sql(_CSV_CELLS, _TABLE_FINAL))
def profile_csv_folders(spark, sf_dir):
    """Integrity of header-less CSV files, folder by folder."""
    path = scratch_path(spark, "segments")
    _orders_by_segment(spark, sf_dir).write.partitionBy("c_mktsegment").option(
        "escape", '"').csv(path)
    rows = delimited.read_delimited_records(spark, path, ",", multiline=False)
    folder = F.regexp_extract("file_path", "c_mktsegment=([^/]*)", 1)
    metrics = profile_records(rows.withColumn("table_name", folder), "table_name", False)
    return metrics.drop("field_deviation_pct")


@query("scan_files", f"""
    WITH s AS (SELECT count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey),
    e AS (SELECT count(*) AS n FROM events)
    SELECT 'csv' AS file_type, s.n::BIGINT AS total_rows, (s.n * 3)::BIGINT AS total_cells,
           0.0::DOUBLE AS field_deviation_pct, true AS all_ok FROM s
    UNION ALL SELECT 'json', e.n, e.n * 4, 0.0, true FROM e
    UNION ALL SELECT 'tsv', count(*), count(*) * 2, 0.0, true FROM supplier
    UNION ALL SELECT 'zip', NULL, NULL, NULL, false""")
def scan_all_files(spark, sf_dir):
    """CSV, TSV and JSON files of one folder, scanned from their inventory."""
    root = scratch_path(spark, "scan")
    _orders_by_segment(spark, sf_dir).write.partitionBy("c_mktsegment").option(
        "escape", '"').csv(f"{root}/csv", header=True)
    table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type", "value", "named_struct('k', user_id) AS u").write.json(f"{root}/json")
    table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").write.csv(
        f"{root}/tsv", sep="\t", header=True)
    found = scan_inventory(spark, root).filter("ext IN ('csv', 'json')")
    kind = (F.when(F.col("path").contains("/tsv/"), "tsv").otherwise(F.col("ext")))
    inventory = found.select("filename", kind.alias("file_type"), F.col("path").alias("file_path"))
    lost = inventory.limit(1).select("filename", F.lit("zip").alias("file_type"),
                                     F.lit("/nowhere.zip").alias("file_path"))
    scanned = scan_files(spark, inventory.unionByName(lost), root)
    return scanned.groupBy("file_type").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("total_cells").alias("total_cells"),
        F.max("field_deviation_pct").alias("field_deviation_pct"),
        F.bool_and(F.col("error") == "").alias("all_ok"))


# --- Stages over the files of an inventory -------------------------------------------

_STAGE_PHONE = dirty_phone("c_custkey")
_STAGE_MONEY = dirty_money("c_custkey")


def _stage_files(spark, sf_dir, label):
    """A headed CSV, a headerless TSV and a JSON folder, and their inventory."""
    root = scratch_path(spark, label)
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS full_name", f"{_STAGE_PHONE} AS phone", f"{_STAGE_MONEY} AS price")
    customers.write.option("escape", '"').csv(f"{root}/csv", header=True)
    customers.write.csv(f"{root}/tsv", sep="\t", escape='"')
    customers.selectExpr("id", "phone", "named_struct('k', price) AS n").write.json(f"{root}/json")
    found = scan_inventory(spark, root).filter("ext IN ('csv', 'json') AND length > 0")
    kind = F.when(F.col("path").contains("/tsv/"), "tsv").otherwise(F.col("ext"))
    return root, found.select("filename", kind.alias("file_type"), F.col("path").alias("file_path"))


@query("schema_inventory_files", """
    SELECT 'csv' AS file_type, true AS has_header, false AS needs_llm_review,
      '[{"name":"id","type":"int","nullable":true},{"name":"full_name","type":"string","nullable":true},{"name":"phone","type":"string","nullable":true},{"name":"price","type":"string","nullable":true}]' AS schema,
      '[]' AS generated_headers
    UNION ALL SELECT 'json', true, false,
      '[{"name":"id","type":"int","nullable":true},{"name":"n.k","type":"string","nullable":true},{"name":"phone","type":"string","nullable":true}]', '[]'
    UNION ALL SELECT 'tsv', false, true, '[]', '["col_0","col_1","col_2","col_3"]'
    UNION ALL SELECT 'zip', true, false, '[]', '[]'""")
def schema_inventory_files(spark, sf_dir):
    """Schemas and suggested names of real files, a missing one among them."""
    root, inventory = _stage_files(spark, sf_dir, "schemas")
    lost = inventory.limit(1).select("filename", F.lit("zip").alias("file_type"),
                                     F.lit("/nowhere.zip").alias("file_path"))
    found = scan_schemas(spark, inventory.unionByName(lost), root)
    return found.select("file_type", "has_header", "needs_llm_review", "schema", "generated_headers").distinct()


@query("clean_files", f"""
    WITH p AS (SELECT c_custkey AS id, c_name AS full_name, {_STAGE_PHONE} AS phone,
                      {_STAGE_MONEY} AS price FROM customer)
    SELECT kind, name, count(*)::BIGINT AS n, count(DISTINCT v)::BIGINT AS n_values FROM (
      SELECT 'csv' AS kind, 'id' AS name, CAST(id AS VARCHAR) AS v FROM p
      UNION ALL SELECT 'tsv', 'key', CAST(id AS VARCHAR) FROM p
      UNION ALL SELECT 'json', 'id', CAST(id AS VARCHAR) FROM p
      UNION ALL SELECT 'csv', 'full_name', {name_sql('full_name')} FROM p
      UNION ALL SELECT 'tsv', 'title', full_name FROM p) c
    GROUP BY ALL""")
def clean_files_query(spark, sf_dir):
    """Rows of CSV, TSV and JSON files in one job, named by header or suggestion."""
    root, inventory = _stage_files(spark, sf_dir, "clean")
    stated = inventory.withColumn("has_header", F.when(F.col("file_type") == "tsv", "false").otherwise("true")) \
        .withColumn("generated_headers", F.lit('["key", "title", "phone", "price"]'))
    rows, _ = clean_files(spark, stated, root)
    kind = F.regexp_extract("file_path", "/(csv|tsv|json)/", 1)
    cells = rows.select(kind.alias("kind"), F.inline(F.arrays_zip("names", "values")).alias("name", "v"))
    return (cells.filter("name IN ('id', 'key', 'full_name', 'title')").groupBy("kind", "name")
            .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("v").alias("n_values")))


@query("clean_files_values", f"""
    SELECT id, {phone_sql('phone')} AS phone, 3::BIGINT AS n
    FROM (SELECT c_custkey AS id, {_STAGE_PHONE} AS phone FROM customer) p""")
def clean_files_values(spark, sf_dir):
    root, inventory = _stage_files(spark, sf_dir, "cleaned")
    stated = inventory.withColumn("has_header", F.when(F.col("file_type") == "tsv", "false").otherwise("true")) \
        .withColumn("generated_headers", F.lit('["id", "title", "phone", "price"]'))
    rows, _ = clean_files(spark, stated, root)
    of = lambda name: F.get(F.col("values"), F.array_position("names", name).cast("int") - 1)
    return rows.groupBy(of("id").cast("bigint").alias("id"), of("phone").alias("phone")).agg(
        F.count(F.lit(1)).alias("n"))


# --- JSON --------------------------------------------------------------------------

_NESTED = ("concat('{\"id\": ', CAST(event_id AS STRING), ', \"t\": \"', event_type, '\", \"p\": ', "
           "props, CASE WHEN event_id % 4 = 0 THEN ', \"z\": [1, 2]' ELSE '' END, "
           "CASE WHEN event_id % 3 = 0 THEN ', \"n\": null' ELSE '' END, '}')")


@query("json_flatten", """
    SELECT CAST(event_id AS VARCHAR) AS value, 'id' AS column_name FROM events
    UNION ALL SELECT event_type, 't' FROM events
    UNION ALL SELECT json_extract_string(props, '$.k'), 'p.k' FROM events
    UNION ALL SELECT '[1,2]', 'z' FROM events WHERE event_id % 4 = 0
    UNION ALL SELECT NULL, 'n' FROM events WHERE event_id % 3 = 0""")
def json_flatten(spark, sf_dir):
    records = table(spark, sf_dir, "events").selectExpr("user_id AS file_path", f"{_NESTED} AS record")
    return J.flatten_cells(records).filter("column_name IS NOT NULL").drop("file_path")


_LONG_NUMBER = "123456789012345678901234567890123456789012345"
_DEEP = "'" + '{"a":' * 9 + "{\"v\":', CAST(event_id AS STRING), '" + "}" * 10 + "'"
_ODD_JSON = (
    "CASE event_id % 6 WHEN 0 THEN concat('{\"a\":1,\"a\":', CAST(event_id AS STRING), '}') "
    "WHEN 1 THEN concat('{\"a\":', CAST(event_id AS STRING), '} junk') "
    f"WHEN 2 THEN '{{\"n\":1e10,\"m\":123456789.0,\"k\":{_LONG_NUMBER}}}' "
    f"WHEN 3 THEN concat({_DEEP}) "
    "WHEN 4 THEN '{\"s\":\"{1}\",\"t\":[1,{\"u\":2}]}' ELSE props END")


@query("json_bad_files", f"""
    WITH c AS (
      SELECT event_id % 6 AS file, unnest(CASE event_id % 6
        WHEN 0 THEN [{{'n': 'error', 'v': 'Malformed JSON'}}]
        WHEN 1 THEN [{{'n': 'error', 'v': 'Malformed JSON'}}]
        WHEN 2 THEN [{{'n': 'n', 'v': '10000000000.0'}}, {{'n': 'm', 'v': '123456789.0'}},
                     {{'n': 'k', 'v': '{_LONG_NUMBER}'}}]
        WHEN 3 THEN [{{'n': 'a.a.a.a.a.a.a.a.a.v', 'v': CAST(event_id AS VARCHAR)}}]
        WHEN 4 THEN [{{'n': 's', 'v': '{{1}}'}}, {{'n': 't', 'v': '[1,{{"u":2}}]'}}]
        ELSE [{{'n': 'k', 'v': json_extract_string(props, '$.k')}}] END) AS u FROM events)
    SELECT file, u.n AS column_name, u.v AS value, count(*)::BIGINT AS n FROM c GROUP BY ALL""")
def json_bad_files(spark, sf_dir):
    """Bad lines as errors; integers with all digits, floats as floats; ten levels."""
    lines = table(spark, sf_dir, "events").selectExpr(
        "event_id % 6 AS file_path", "0 AS block", "event_id AS line_no", f"{_ODD_JSON} AS line")
    found = J.line_records(lines)
    errors = found.filter("error IS NOT NULL").select(
        "file_path", F.lit("error").alias("column_name"), F.col("error").alias("value"))
    cells = J.flatten_cells(found).filter("column_name IS NOT NULL").unionByName(errors)
    return cells.groupBy(F.col("file_path").alias("file"), "column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))


@query("json_profile", """
    SELECT event_type AS file_path, count(*)::BIGINT AS total_rows,
           (count(*) * 5)::BIGINT AS total_cells,
           round(100.0 * (count(*) FILTER (WHERE event_id % 4 <> 0) + count(*))
             / (count(*) * 5), 3)::DOUBLE AS null_pct,
           round(100.0 * (count(*) - greatest(
             count(*) FILTER (WHERE event_id % 4 <> 0 AND event_id % 3 <> 0),
             count(*) FILTER (WHERE (event_id % 4 = 0) <> (event_id % 3 = 0)),
             count(*) FILTER (WHERE event_id % 12 = 0))) / count(*), 3)::DOUBLE
             AS field_deviation_pct,
           0.0::DOUBLE AS type_deviation_pct
    FROM events GROUP BY event_type""")
def json_profile(spark, sf_dir):
    records = table(spark, sf_dir, "events").selectExpr(
        "event_type AS file_path", f"{_NESTED} AS record")
    return profile_json(J.flatten_cells(records)).drop("entropy_delta_pct")


@query("json_documents", """
    SELECT user_id AS file_path, CAST(event_id AS VARCHAR) AS value, 'id' AS column_name,
           NULL AS error FROM events WHERE user_id % 4 = 0
    UNION ALL SELECT user_id, event_type, 'value', NULL FROM events WHERE user_id % 4 = 1
    UNION ALL SELECT DISTINCT user_id, NULL, NULL,
      CASE WHEN user_id % 4 = 2 THEN 'Unsupported JSON root type' ELSE 'Malformed JSON' END
    FROM events WHERE user_id % 4 >= 2""")
def json_documents(spark, sf_dir):
    """One document per user, its elements on lines of their own: an array of
    objects, an array of texts, a bare number, or broken text."""
    events = table(spark, sf_dir, "events")
    first = events.groupBy("user_id").agg(F.min("event_id").alias("_first"))
    opening = F.when(F.col("event_id") == F.col("_first"), "[").otherwise(",")
    element = (F.when(F.col("user_id") % 4 == 0,
                      F.concat(opening, F.lit('{"id": '), "event_id", F.lit("}")))
               .when(F.col("user_id") % 4 == 1,
                     F.concat(opening, F.lit('"'), "event_type", F.lit('"')))
               .when(F.col("user_id") % 4 == 2,
                     F.when(F.col("event_id") == F.col("_first"), "7").otherwise(" "))
               .otherwise(F.lit('{"a": ')))
    placed = events.join(first, "user_id").select(
        F.col("user_id").alias("file_path"), F.lit(0).alias("block"),
        F.col("event_id").alias("line_no"), element.alias("line"))
    closing = first.filter("user_id % 4 < 2").select(
        F.col("user_id").alias("file_path"), F.lit(1).alias("block"),
        F.lit(0).cast("bigint").alias("line_no"), F.lit("]").alias("line"))
    found = J.json_records(placed.unionByName(closing))
    errors = found.filter("error IS NOT NULL").select(
        "file_path", F.lit(None).cast("string").alias("column_name"),
        F.lit(None).cast("string").alias("value"), "error")
    cells = J.flatten_cells(found).filter("column_name IS NOT NULL")
    return cells.withColumn("error", F.lit(None).cast("string")).unionByName(errors)


@query("json_array_file", """
    SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           concat('a "b, [', chr(92), '] ', event_type) AS s, CAST(NULL AS VARCHAR) AS error FROM events""")
def json_array_file(spark, sf_dir):
    """All events as the elements of one array, which many tasks cut."""
    events = table(spark, sf_dir, "events").selectExpr(
        "'events' AS file_path", "event_id - event_id % 512 AS block", "event_id AS line_no",
        "concat(',', to_json(named_struct('id', event_id, 't', event_type, 'p', from_json(props, 'k BIGINT'), "
        "'s', concat('a \"b, [', char(92), '] ', event_type)))) AS line")
    # The array opens and closes on lines of their own.
    end = lambda block, line: F.struct(
        F.lit("events").alias("file_path"), block.alias("block"),
        F.lit(0).cast("bigint").alias("line_no"), F.lit(line).alias("line"))
    ends = events.agg(F.min("block").alias("least"), F.max("block").alias("most")).select(F.inline(F.array(
        end(F.col("least") - 512, '[{"id": -1}'), end(F.col("most") + 512, "]"))))
    found = J.document_records(events.unionByName(ends))
    record = F.from_json("record", "id BIGINT, t STRING, p STRUCT<k: BIGINT>, s STRING")
    return found.select(record.alias("r"), "error").filter("r.id <> -1 OR error IS NOT NULL").select(
        F.col("r.id").alias("event_id"), F.col("r.t").alias("event_type"), F.col("r.p.k").alias("k"),
        F.col("r.s").alias("s"), "error")


@query("read_json_table", """
    SELECT event_id, event_type, value, user_id AS "u.id",
           json_extract_string(props, '$.k') AS "u.k" FROM events""")
def read_json_table(spark, sf_dir):
    path = scratch_path(spark, "json")
    table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type", "value",
        "named_struct('id', user_id, 'k', get_json_object(props, '$.k')) AS u").write.json(path)
    flat = J.read_json_table(spark, path, multiline=False)
    return flat.select(*[F.col(quoted(c)) for c in flat.columns])


# --- Round trips ------------------------------------------------------------------

@query("csv_roundtrip", """
    SELECT CAST(event_id AS VARCHAR) AS event_id, props AS schema,
           concat(event_type, ', "x"', chr(10), 'y') AS note FROM events""")
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "quoted")
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id", "props AS schema", "concat(event_type, ', \"x\"', char(10), 'y') AS note")
    sinks.write_quoted_csv(rows, path)
    return sinks.read_inventory_csv(spark, path)


@query("write_cleaned", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def write_cleaned(spark, sf_dir):
    path = scratch_path(spark, "cleaned")
    rows = table(spark, sf_dir, "customer").drop("c_nationkey")
    sinks.write_cleaned(rows, path, partition_by=["c_mktsegment"])
    return spark.read.schema(rows.schema).parquet(path)
