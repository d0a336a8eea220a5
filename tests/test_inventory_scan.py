"""The listing of tables that are folders of files."""

import os

from pyspark.sql import functions as F

from cellmend.plans import queries
from cellmend.plans.catalog import TABLES

SF_DIR = "/root/testdata/sf0.001"


def test_a_table_may_be_a_folder(spark, tmp_path):
    rows = {name: spark.read.parquet(f"{SF_DIR}/{name}.parquet").count() for name in TABLES}
    for name in TABLES:
        os.symlink(f"{SF_DIR}/{name}.parquet", tmp_path / f"{name}.parquet")
    for name, empty in (("orders", False), ("events", False), ("labels", True)):
        os.unlink(tmp_path / f"{name}.parquet")
        table = spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(3)
        table.filter(F.lit(not empty)).write.parquet(str(tmp_path / f"{name}.parquet"))
        rows[name] = 0 if empty else rows[name]
    got = queries()["inventory_scan"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted((f"{name}.parquet", "parquet", n) for name, n in rows.items())
