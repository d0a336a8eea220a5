"""Upserts that rewrite only the files they touch."""

import random

import pytest
from pyspark.sql import functions as F

from cellmend.sources.keyed_table import KeyedTable

SCHEMA = "k long, v string, o int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def many_files(spark):
    for name, value in (("spark.sql.adaptive.coalescePartitions.enabled", "false"), ("spark.sql.shuffle.partitions", "16")):
        spark.conf.set(name, value)
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_only_touched_files_are_rewritten(spark, tmp_path, many_files):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    table.create(spark.range(4000).selectExpr("id AS k", "'old' AS v", "0 AS o"))
    before = {r.file for r in table.files().collect()}
    assert len(before) >= 12
    batch = spark.range(100, 140).selectExpr("id AS k", "'new' AS v", "1 AS o")  # 1 % of the keys
    assert table.upsert(batch) == 1
    after = {r.file for r in table.files().collect()}
    assert 1 <= len(before - after) <= 2
    assert table.read().count() == 4000 and table.read().filter("v = 'new'").count() == 40
    assert table.read(0).filter("v = 'new'").count() == 0  # the earlier version is still there


def test_upserts_against_a_dict(spark, tmp_path, many_files):
    rnd = random.Random(8)
    table, want = KeyedTable(spark, str(tmp_path / "t"), ["k"]), {}
    for step in range(4):
        data = [(rnd.choice([None, rnd.randrange(300), rnd.randrange(1000, 1010)]), f"s{step}.{i}", i) for i in range(120)]
        table.upsert(spark.createDataFrame(data, SCHEMA), F.col("o"))
        want |= {k: (k, v, o) for k, v, o in data}
        assert rows(table.read()) == sorted(want.values(), key=repr)
    again = table.upsert(spark.createDataFrame(data, SCHEMA), F.col("o"))
    assert again == 4 and rows(table.read()) == sorted(want.values(), key=repr)
    assert table.upsert(spark.createDataFrame([], SCHEMA)) == 4


def test_a_failed_run_leaves_the_old_version(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    table.create(spark.createDataFrame([(1, "a", 0), (2, "b", 0)], SCHEMA))
    bad = spark.createDataFrame([(2, "c", 0)], SCHEMA).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.upsert(bad)
    assert table.version() == 0 and rows(table.read()) == [(1, "a", 0), (2, "b", 0)]


def test_a_version_is_taken_once(spark, tmp_path):
    one, two = (KeyedTable(spark, str(tmp_path / "t"), ["k"]) for _ in range(2))
    one.create(spark.createDataFrame([(1, "a", 0)], SCHEMA))
    with pytest.raises(Exception, match="(?i)exist"):
        two.create(spark.createDataFrame([(2, "b", 0)], SCHEMA))
    assert rows(two.read()) == [(1, "a", 0)]


def test_several_keys_and_an_empty_table(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k", "v"])
    table.create(spark.createDataFrame([], SCHEMA))
    assert rows(table.read()) == []
    table.upsert(spark.createDataFrame([(1, "a", 0), (1, None, 0), (None, None, 0)], SCHEMA))
    table.upsert(spark.createDataFrame([(1, None, 5), (2, "a", 5)], SCHEMA))
    assert rows(table.read()) == sorted([(1, "a", 0), (1, None, 5), (None, None, 0), (2, "a", 5)], key=repr)
