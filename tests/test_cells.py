"""Literal cases of the classifiers, cleaners and recipes."""

import pytest
from pyspark.sql import functions as F

from cellmend.functions import classify as C
from cellmend.functions import clean, normalize
from cellmend.functions.semantic import (
    Rule, apply_cleaners, clean_dry_run, semantic_type, semantic_type_of)


def apply(spark, function, values):
    """Map texts through a Column function, keeping their order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


def check(spark, function, cases):
    assert dict(zip(cases, apply(spark, function, list(cases)))) == cases


def test_nullish(spark):
    yes = ["", "nan", "None", " NULL ", "na", "N/A", "#n/a", "nil", "-", "--", None, ",", "n a", "- -"]
    no = ["0", "x", "---", "nanx", "\tNA "]
    assert apply(spark, C.is_nullish, yes) == [True] * len(yes)
    assert apply(spark, C.is_nullish, no) == [False] * len(no)
    assert apply(spark, lambda c: C.is_nullish(c, "unicode"), ["\tNA ", " nil"]) == [True, True]


def test_cell_types(spark):
    check(spark, C.infer_cell_type, {
        "1": "int", "-12": "int", "1,234": "int", "1 2": "int", "1.5": "float", "-0.25": "float",
        "+5": "string", ".5": "string", "5.": "string", "1e5": "string", "abc": "string",
        "n/a": "null", "": "null"})
    check(spark, C.infer_cell_type_lenient, {
        "1": "int", "+5": "int", "1,234": "int", "1 2": "int", ".5": "float", "5.": "float",
        "1e5": "float", "-inf": "float", "1_000": "string", "1d": "string", "abc": "string",
        "n/a": "null"})
    check(spark, C.header_cell_type, {
        "TRUE": "bool", "+5": "int", "1.5": "float", ".5e3": "float", "5.": "string",
        "2024-1-5": "date", "1/2/24": "date", "12 Mar 2024": "date", "marching": "string",
        " ": None, "x": "string"})


def test_data_patterns(spark):
    rows = spark.createDataFrame(
        [(["id", "a@b.co"],), (["id", "123"],), (["id", "12"],), (["x y", None],)], "r array<string>")
    got = [r[0] for r in rows.select(C.has_data_patterns(F.col("r"))).collect()]
    assert got == [True, True, False, False]


def test_header_token_score(spark):
    check(spark, C.header_token_score, {
        "ID": 1.0, "order_id": 0.9, "orderId": 0.9, "OrderId": 0.9, "ORDER_ID": 0.9,
        "Name": 0.9, "name": 0.0, "first name": 0.6, "1st name": 0.0, "": 0.0})


def test_phone(spark):
    check(spark, clean.clean_phone, {
        "(415) 555-2671": "415-555-2671", "+1.415.555.2671": "415-555-2671",
        "+91 9876543210": "987-654-3210", "919876543210": "919-876-5432",
        "4 1 5 5 5 5 2 6 7 1": "415-555-2671", "12345": None, "": None, None: None,
        "x1-415-555-2671 ext 9": "415-555-2671"})


def test_email_url_zip(spark):
    check(spark, clean.clean_email, {
        " User@Example.COM ": "user@example.com", "a@b.co.uk": "a@b.co.uk", "a@b.xyz": None,
        "bad": None, "": None})
    check(spark, clean.clean_url, {
        "HTTP://A.b/C//": "http://a.b/c", "https://x y": None, "ftp://x": None,
        "https://x/y?z=/": "https://x/y?z="})
    check(spark, clean.clean_zip, {
        "12345": "12345", " 12345-6789 ": "12345-6789", "1234": None, "123456": None})


def test_currency(spark):
    check(spark, clean.clean_currency, {
        "$1,234.50": 1234.5, "(5.00)": -5.0, "-5": -5.0, "-$5": -5.0, "$-5": -5.0, "1e-3": 0.001,
        "5-": None, "1-2": None, "abc": None, "": None, "0": 0.0, "1e3": 1000.0, "€9": 9.0,
        "--5": None, "1d": None})
    check(spark, lambda c: clean.clean_currency(c, compat=True), {
        "$1,234.50": 1234.5, "(5.00)": -5.0, "-5": 5.0, "-$5": 5.0, "1-2": None, "abc": None,
        "": None, "0": 0.0, "1e3": 1000.0, "1e-3": -0.001})


def test_percentage(spark):
    check(spark, clean.clean_percentage, {
        "12.5%": 12.5, "about 7 %": 7.0, "101%": None, "-3": None, "abc": None, "0": 0.0,
        "+50": 50.0, "5.": 5.0})


def test_date(spark):
    check(spark, clean.clean_date, {
        "15/01/2024": "2024-01-15", "15/1/2024": "2024-01-15", "15-01-2024": "2024-01-15",
        "01/15/2024": "2024-01-15", "2024-01/15": "2024-01-15", "01/05/2024": "2024-01-05",
        "01/5/2024": "2024-05-01", "02-30-2024": None, "1/05/2024": None, "2023-02-29": None,
        "2024-02-29": "2024-02-29", "0000-01-01": None, "": None, "2024-01-05 10:00": None})


def test_name(spark):
    check(spark, clean.clean_name, {
        "DR.  SMITH jr3": "Dr Smith Jr", "it's": "It'S", "o'brien": "O'Brien",
        "mary-jane": "Mary-Jane", "123": None, " ": None, "# #": " ",
        "--": "--", "a-'b": "A-'B"})


def test_address(spark):
    check(spark, clean.clean_address, {
        "12 Main St.": "12 Main Street.", "5 oak AVE apt 3": "5 oak Avenue Apartment 3",
        "No.5 Elm rd": "Number5 Elm Road", "  1   Pkwy  ": "1 Parkway", " ": None,
        "Stone": "Stone"})


@pytest.mark.parametrize("cleaner", ["clean_phone", "clean_email", "clean_url", "clean_zip", "clean_date"])
def test_cleaners_are_idempotent(spark, cleaner):
    function = getattr(clean, cleaner)
    raw = ["415 555 2671", "a@b.com", "http://x.y/", "12345", "15/01/2024", "junk"]
    once = apply(spark, function, raw)
    assert apply(spark, function, once) == once


def test_recipes(spark):
    check(spark, normalize.strip_title, {
        "Mr. Bob (Architect)": "Bob", "Prof.Ann": "Ann", "Drake": "Drake", None: None})
    check(spark, normalize.phone_last10, {"+91 98765-43210": "9876543210", "12": None, None: None})
    check(spark, normalize.to_long, {"12": 12, "x": None, None: None})
    check(spark, normalize.canonical_gender, {"m": "Male", "FEMALE": "Female", "x": None})
    stamps = apply(spark, lambda c: F.date_format(normalize.parse_timestamp(c), "yyyy-MM-dd HH:mm"),
                   ["05-01-2024 13:45", "05-Jan-2024 1:45 PM", "2024-01-05T13:45:00Z", "soon"])
    assert stamps == ["2024-01-05 13:45"] * 3 + [None]


def test_semantic_types_keep_their_order(spark):
    cases = {
        "email_address": "address", "contact_email": "phone", "cancelled": "phone",
        "candidate": "date", "filename": "name", "corporate_id": "currency",
        "interest_rate_pct": "currency", "postal_address": "address", "Mobile": "phone",
        "e_mail": "email", "site_url": "url", "ZIP": "zip", "pct": "percentage", "id": None}
    assert {n: semantic_type_of(n) for n in cases} == cases
    check(spark, semantic_type, cases)


def test_custom_rule_comes_first(spark):
    df = spark.createDataFrame([("A@B.COM", "x", 1.5)], "contact_email string, code string, price double")
    rules = [Rule("email", "email"), Rule("code", "code", F.upper)]
    assert apply_cleaners(df, rules).first().asDict() == {
        "contact_email": "a@b.com", "code": "X", "price": 1.5}
    assert semantic_type_of("contact_email", rules) == "email"


def test_dotted_columns_are_cleaned(spark):
    df = spark.createDataFrame([(" bob ", "1 main st")], "`name.last` string, `home.address` string")
    assert tuple(apply_cleaners(df).first()) == ("Bob", "1 main Street")
    assert {r.column_name for r in clean_dry_run(df).collect()} == {"name.last", "home.address"}
