"""Value cleaners, normalisation recipes and rule-driven table cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellmend.functions import clean, normalize
from cellmend.functions.semantic import apply_cleaners, clean_dry_run
from cellmend.plans.catalog import (
    dirty_address, dirty_date, dirty_email, dirty_money, dirty_name, dirty_percent, dirty_phone,
    dirty_zip, padded, query, table)
from cellmend.plans.cell_queries import STRIP

# --- The cleaners once more, in the oracle's SQL -------------------------------


def phone_sql(raw):
    s = STRIP.format(raw)
    run = (f"regexp_extract({s}, '(?:\\+?1[-.\\s]?)?\\(?([0-9]{{3}})\\)?[-.\\s]?([0-9]{{3}})"
           f"[-.\\s]?([0-9]{{4}})'")
    digits = f"regexp_replace({s}, '[^0-9]', '', 'g')"
    return (f"CASE WHEN {run}, 0) <> '' THEN concat({run}, 1), '-', {run}, 2), '-', {run}, 3)) "
            f"WHEN length({digits}) >= 10 THEN concat(substr(right({digits}, 10), 1, 3), '-', "
            f"substr(right({digits}, 10), 4, 3), '-', right({digits}, 4)) END")


def email_sql(raw):
    s = f"lower({STRIP.format(raw)})"
    return (f"CASE WHEN regexp_full_match({s}, '[a-z0-9._%+-]+@[a-z0-9.-]+"
            f"\\.(com|org|net|edu|in|co\\.uk|gov|de|fr|au)') THEN {s} END")


def money_sql(raw, compat=False):
    s = STRIP.format(raw)
    bare = f"regexp_replace({s}, '[$€¥£,\\s()]', '', 'g')"
    if compat:
        negative = f"(contains({s}, '-') OR {s} LIKE '(%')"
        value = f"try_cast({bare} AS DOUBLE)"
    else:
        negative = f"({s} LIKE '(%' OR regexp_matches({s}, '^[^0-9.]*-'))"
        value = f"try_cast(regexp_replace({bare}, '^-', '') AS DOUBLE)"
    return f"CASE WHEN {negative} THEN -{value} ELSE {value} END"


def percent_sql(raw):
    value = f"try_cast(regexp_extract({STRIP.format(raw)}, '[-+]?\\d+\\.?\\d*') AS DOUBLE)"
    return f"CASE WHEN {value} BETWEEN 0 AND 100 THEN abs({value}) END"


def date_sql(raw):
    s = f"replace({STRIP.format(raw)}, '/', '-')"
    tries = [("\\d{4}-\\d{2}-\\d{2}", "%Y-%m-%d"), ("\\d{2}-\\d{2}-\\d{4}", "%m-%d-%Y"),
             ("\\d{2}-\\d{1,2}-\\d{4}", "%d-%m-%Y")]
    parsed = ", ".join(
        f"CASE WHEN regexp_full_match({s}, '{regex}') THEN try_strptime({s}, '{fmt}') END"
        for regex, fmt in tries)
    return f"strftime(coalesce({parsed}), '%Y-%m-%d')"


def name_sql(raw):
    kept = (f"regexp_replace(regexp_replace({STRIP.format(raw)}, '\\s+', ' ', 'g'), "
            f"'[^a-zA-Z\\s\\-'']', '', 'g')")
    words = f"regexp_extract_all({kept}, '[A-Za-z]+|[^A-Za-z]+')"
    return (f"nullif(array_to_string(list_transform({words}, lambda w: "
            f"concat(upper(substr(w, 1, 1)), lower(substr(w, 2)))), ''), '')")


def url_sql(raw):
    s = f"lower({STRIP.format(raw)})"
    return (f"CASE WHEN regexp_full_match({s}, 'https?://[^\\s]+') "
            f"THEN regexp_replace({s}, '/+$', '') END")


def zip_sql(raw):
    s = STRIP.format(raw)
    return f"CASE WHEN regexp_full_match({s}, '\\d{{5}}(-\\d{{4}})?') THEN {s} END"


def address_sql(raw):
    text = STRIP.format(raw)
    for short, word in (("St", "Street"), ("Ave", "Avenue"), ("Blvd", "Boulevard"),
                        ("Rd", "Road"), ("Dr", "Drive"), ("Ln", "Lane"), ("Pl", "Place"),
                        ("Pkwy", "Parkway"), ("Apt", "Apartment"), ("Suite", "Suite"),
                        ("No", "Number")):
        text = f"regexp_replace({text}, '(?i)\\b{short}\\.?\\b', '{word}', 'g')"
    return f"nullif(trim(regexp_replace({text}, '\\s+', ' ', 'g')), '')"


def _register_cleaner(name, cleaner, source, key, dirt, sql):
    oracle = (f"WITH d AS (SELECT {key}, {dirt} AS raw FROM {source}) "
              f"SELECT {key}, raw, {sql('raw')} AS cleaned FROM d")

    @query(name, oracle)
    def run(spark, sf_dir):
        dirty = table(spark, sf_dir, source).selectExpr(key, f"{dirt} AS raw")
        return dirty.withColumn("cleaned", cleaner(F.col("raw")))


_register_cleaner("clean_phone", clean.clean_phone, "customer", "c_custkey",
                  dirty_phone("c_custkey"), phone_sql)
_register_cleaner("clean_email", clean.clean_email, "customer", "c_custkey",
                  dirty_email("c_custkey"), email_sql)
_register_cleaner("clean_currency", clean.clean_currency, "orders", "o_orderkey",
                  dirty_money("o_orderkey"), money_sql)
_register_cleaner("clean_currency_compat", lambda c: clean.clean_currency(c, compat=True),
                  "orders", "o_orderkey", dirty_money("o_orderkey"),
                  lambda raw: money_sql(raw, compat=True))
_register_cleaner("clean_percentage", clean.clean_percentage, "orders", "o_orderkey",
                  dirty_percent("o_orderkey"), percent_sql)
_register_cleaner("clean_date", clean.clean_date, "orders", "o_orderkey",
                  dirty_date("o_orderkey"), date_sql)
_register_cleaner("clean_name", clean.clean_name, "customer", "c_custkey",
                  dirty_name("c_custkey"), name_sql)
_register_cleaner("clean_url", clean.clean_url, "pages", "page_id", "url", url_sql)
_register_cleaner("clean_zip", clean.clean_zip, "customer", "c_custkey",
                  dirty_zip("c_custkey"), zip_sql)
_register_cleaner("clean_address", clean.clean_address, "supplier", "s_suppkey",
                  dirty_address("s_suppkey"), address_sql)


# --- Rules by column name --------------------------------------------------------

@query("clean_orders", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""")
def clean_orders(spark, sf_dir):
    return apply_cleaners(table(spark, sf_dir, "orders"))


_CUSTOMER = {
    "c_custkey": "c_custkey", "c_name": dirty_name("c_custkey"),
    "contact_phone": dirty_phone("c_custkey"), "home_mail": dirty_email("c_custkey"),
    "street": dirty_address("c_custkey"), "zip": dirty_zip("c_custkey"),
    "salary": dirty_money("c_custkey"), "discount_pct": dirty_percent("c_custkey"),
    "birth": dirty_date("c_custkey"), "c_mktsegment": "c_mktsegment",
}
_CUSTOMER_SQL = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in _CUSTOMER.items()) + " FROM customer"
_CLEANED = {
    "c_name": name_sql, "contact_phone": phone_sql, "home_mail": email_sql,
    "street": address_sql, "zip": zip_sql, "salary": money_sql, "discount_pct": percent_sql,
    "birth": date_sql,
}
_CLEAN_CUSTOMER_SQL = "SELECT c_custkey, " + ", ".join(
    f"{sql(c)} AS {c}" for c, sql in _CLEANED.items()) + f", c_mktsegment FROM ({_CUSTOMER_SQL}) d"


def dirty_customer(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(*[f"{v} AS {k}" for k, v in _CUSTOMER.items()])


@query("clean_customer", _CLEAN_CUSTOMER_SQL)
def clean_customer(spark, sf_dir):
    return apply_cleaners(dirty_customer(spark, sf_dir))


@query("clean_dry_run", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count(*)::BIGINT AS rows,
           (count(*) FILTER (WHERE CAST({sql(c)} AS VARCHAR) IS DISTINCT FROM {c}
              AND {sql(c)} IS NOT NULL))::BIGINT AS values_changed,
           (count(*) FILTER (WHERE {c} IS NOT NULL AND {sql(c)} IS NULL))::BIGINT AS values_nulled
    FROM ({_CUSTOMER_SQL}) d""" for c, sql in _CLEANED.items()))
def dry_run(spark, sf_dir):
    return clean_dry_run(dirty_customer(spark, sf_dir))


# --- Normalisation recipes ---------------------------------------------------------

_TITLED = ("CASE c_custkey % 5 WHEN 0 THEN concat('Mr. ', c_name, ' (Architect)') "
           "WHEN 1 THEN concat('Prof.', c_name) WHEN 2 THEN concat('(x) Dr. ', c_name, '(y)') "
           "WHEN 3 THEN c_name END")


def _register_recipe(name, source, key, raw, recipe, sql):
    @query(name, f"WITH d AS (SELECT {key}, {raw} AS raw FROM {source}) "
                 f"SELECT {key}, {sql} AS normalized FROM d")
    def run(spark, sf_dir):
        dirty = table(spark, sf_dir, source).selectExpr(key, f"{raw} AS raw")
        return dirty.select(key, recipe(F.col("raw")).alias("normalized"))


_register_recipe("norm_lower_trim", "customer", "c_custkey",
                 "concat('  ', c_mktsegment, ' ')", normalize.lower_trim, "trim(lower(raw))")
_register_recipe("strip_title", "customer", "c_custkey", _TITLED, normalize.strip_title,
                 "trim(regexp_replace(regexp_replace(raw, '\\(.*?\\)', '', 'g'), "
                 "'^(Mr\\.|Mrs\\.|Ms\\.|Dr\\.|Prof\\.)\\s*', ''))")
_register_recipe("squash_ws", "documents", "doc_id", "text", normalize.squash_whitespace,
                 "regexp_replace(raw, '\\s+', '', 'g')")
_register_recipe("phone_last10", "customer", "c_custkey", dirty_phone("c_custkey"),
                 normalize.phone_last10,
                 "nullif(regexp_extract(regexp_replace(raw, '[^\\d]', '', 'g'), "
                 "'(\\d{10})$', 1), '')")
_register_recipe("norm_upper", "customer", "c_custkey", "lower(c_mktsegment)", normalize.upper,
                 "upper(raw)")
_register_recipe("to_long", "orders", "o_orderkey",
                 "CASE o_orderkey % 3 WHEN 0 THEN 'x' WHEN 1 THEN CAST(o_custkey AS STRING) END",
                 normalize.to_long, "try_cast(raw AS BIGINT)")
_register_recipe("canonical_gender", "customer", "c_custkey",
                 "CASE c_custkey % 6 WHEN 0 THEN 'm' WHEN 1 THEN 'Female' WHEN 2 THEN 'F' "
                 "WHEN 3 THEN 'male' WHEN 4 THEN 'other' END", normalize.canonical_gender,
                 "CASE WHEN upper(raw) IN ('M', 'MALE') THEN 'Male' "
                 "WHEN upper(raw) IN ('F', 'FEMALE') THEN 'Female' END")
_register_recipe("strip_money", "orders", "o_orderkey", dirty_money("o_orderkey"),
                 normalize.strip_money, "regexp_replace(raw, '[$,]', '', 'g')")

_PURCHASED = (
    f"CASE o_orderkey % 5 WHEN 0 THEN concat({padded('1 + o_orderkey % 28', 2)}, '-0', "
    f"CAST(1 + o_orderkey % 9 AS STRING), '-2021 13:', {padded('o_orderkey % 60', 2)}) "
    f"WHEN 1 THEN concat({padded('1 + o_orderkey % 28', 2)}, '-Mar-2022 ', "
    f"CAST(1 + o_orderkey % 12 AS STRING), ':05 PM') "
    f"WHEN 2 THEN concat('2023-11-', {padded('1 + o_orderkey % 30', 2)}, 'T07:08:09Z') "
    f"WHEN 3 THEN 'soon' END")


@query("parse_multi_timestamp", f"""
    WITH d AS (SELECT o_orderkey, {_PURCHASED} AS raw FROM orders)
    SELECT o_orderkey, strftime(coalesce(try_strptime(raw, '%d-%m-%Y %H:%M'),
           try_strptime(raw, '%d-%b-%Y %I:%M %p'), try_strptime(raw, '%Y-%m-%dT%H:%M:%SZ')),
           '%Y-%m-%d %H:%M:%S') AS normalized FROM d""")
def parse_multi_timestamp(spark, sf_dir):
    dirty = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_PURCHASED} AS raw")
    parsed = normalize.parse_timestamp(F.col("raw"))
    return dirty.select("o_orderkey", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("normalized"))


@query("drop_columns", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def drop_columns(spark, sf_dir):
    return normalize.drop_columns(table(spark, sf_dir, "customer"), "c_name", "c_mktsegment")
