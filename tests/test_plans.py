"""What the physical plans must and must not hold."""

import re

from cellmend.operators import metrics as M
from cellmend.operators.file_profile import profile_records
from cellmend.operators.integrity_scan import UNREADABLE
from cellmend.operators import tables as T
from cellmend.operators.sizing import broadcast_if_small
from cellmend.operators.tables import clean_table
from cellmend.plans import queries
from cellmend.sources import delimited
from cellmend.sources.text import read_lines

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_profile_shuffles_values_then_columns_then_tables(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(M.profile_tables({"orders": orders}))
    assert exchanges(text) == 3 and "SortAggregate" not in text
    assert text.count("FileScan") == 1


def test_file_profile_reads_once_without_sorting(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    rows = delimited.records(read_lines(spark, str(tmp_path)), ",", multiline=False)
    text = plan(profile_records(rows))
    assert text.count("FileScan") == 1 and exchanges(text) == 3
    assert "SortAggregate" not in text


def test_first_rows_limit_before_the_shuffle(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    text = plan(delimited.first_rows(read_lines(spark, str(tmp_path)), 6))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_cleaning_is_one_narrow_stage(spark):
    text = plan(queries()["clean_customer"](spark, SF_DIR))
    assert "Exchange" not in text


def test_type_metrics_shuffle_counts_only(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(M.type_deviation(orders))
    first = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert first and all("key_text" not in keys for keys in first)
    assert any("cell_type" in keys for keys in first)


def test_clean_table_deduplicates_once(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").selectExpr(
        "CAST(o_custkey AS STRING) AS a", "o_orderpriority AS b")
    assert exchanges(plan(clean_table(orders))) == 1


def test_broadcasts_are_bound_by_bytes(spark):
    table = spark.createDataFrame([("x" * 1000, [1, 2])] * 100, "s string, a array<int>")
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().logical().toString() or "UnresolvedHint" in (
        df._jdf.queryExecution().logical().toString())
    assert hinted(broadcast_if_small(table)) and not hinted(broadcast_if_small(table, 50_000))


def test_archives_are_not_opened(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a\n")
    (tmp_path / "b.zip").write_bytes(b"PK\n\xff")
    lines = read_lines(spark, str(tmp_path), skip=UNREADABLE)
    assert [r.line for r in lines.collect()] == ["a"]


def test_counters_ride_on_the_job_that_writes(spark, tmp_path):
    rows = [("1", "a"), ("1", "a"), (None, "b"), ("2", None), ("2", None), ("2", None)]
    spark.createDataFrame(rows, "k string, v string").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    plans = []

    def write(out):
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        out.write.parquet(str(tmp_path / "out"))

    counters = T.write_cleaned_table(df, write, numeric=["k"])
    assert counters == {"rows_in": 6, "duplicates": 3, "null_keys": 1, "nulls_filled": 1, "rows_out": 2}
    assert plans[0].count("FileScan") == 1 and plans[0].count("Exchange") == 1
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [(1.0, "a"), (2.0, "UNKNOWN")]
    got = T.validate_stage(df, "s", lambda x: x.write.parquet(str(tmp_path / "v"))).first()
    assert tuple(got) == ("s", 6, 2, True)
