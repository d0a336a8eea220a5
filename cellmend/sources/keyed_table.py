"""A table of files that upserts rewrite only where keys match.

``data`` holds Parquet files, and ``manifest/version=<n>`` one small file that
lists the data files of a version with the least and greatest key in each. An
upsert first drops the files whose range of keys does not meet the batch, reads
the keys of the others, rewrites those that hold a key of the batch, and writes
the next manifest. A version exists once its manifest does: a run that fails
before leaves the old one, and of two runs at once the second finds its version
taken.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cellmend.functions.normalize import quoted
from cellmend.operators.sizing import broadcast_if_small, settled
from cellmend.operators.tables import latest
from cellmend.sources.text import plain_path


class KeyedTable:
    """``keys`` are the key columns, null being a key like any other; ranges are
    kept of the first. Rows have one key each."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    # --- versions ---------------------------------------------------------------

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.option("basePath", f"{self.path}/manifest").parquet(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def version(self) -> int:
        """The number of the newest version; -1 before the first."""
        found = self._manifests()
        newest = found.agg(F.max("version")).first()[0] if found is not None else None
        return -1 if newest is None else newest

    def files(self, version: int | None = None) -> DataFrame:
        """``(file, rows, least, most, nulls)`` of a version."""
        version = self.version() if version is None else version
        return self.spark.read.parquet(f"{self.path}/manifest/version={version}").filter("file IS NOT NULL")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest, or of an earlier, version."""
        version = self.version() if version is None else version
        manifest = self.spark.read.parquet(f"{self.path}/manifest/version={version}")
        schema = self.spark.read.parquet(manifest.filter("file IS NULL").first()["folder"]).schema
        names = [r["file"] for r in manifest.filter("file IS NOT NULL").select("file").collect()]
        return self._rows(names, schema)

    def _rows(self, names: list[str], schema) -> DataFrame:
        reader = self.spark.read.schema(schema)
        return reader.parquet(*names) if names else self.spark.createDataFrame([], schema)

    # --- writing ----------------------------------------------------------------

    def _written(self, rows: DataFrame, folder: str) -> DataFrame:
        """Write rows in ranges of keys; what the manifest says of the files."""
        order = [F.col(quoted(k)) for k in self.keys]
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(folder)
        key = F.col(quoted(self.keys[0]))
        return self.spark.read.parquet(folder).groupBy(plain_path(F.col("_metadata.file_path")).alias("file")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(key).alias("least"), F.max(key).alias("most"),
            F.count_if(key.isNull()).alias("nulls"))

    def _commit(self, files: DataFrame, folder: str, version: int) -> int:
        """The manifest of a version, as one file that appears as a whole. Its
        row without a file names a folder that has the table's columns."""
        head = files.sparkSession.range(1).select(F.lit(folder).alias("folder"))
        files.unionByName(head, allowMissingColumns=True).coalesce(1).write.mode("errorifexists").parquet(
            f"{self.path}/manifest/version={version}")
        return version

    def _folder(self) -> str:
        return f"{self.path}/data/{uuid.uuid4().hex}"

    def create(self, rows: DataFrame, order_by: Column | None = None, version: int = 0) -> int:
        """A version of these rows alone: the last row per key."""
        folder = self._folder()
        return self._commit(self._written(latest(rows, self.keys, order_by), folder), folder, version)

    def upsert(self, batch: DataFrame, order_by: Column | None = None, base: int | None = None) -> int:
        """Put the batch's last row per key in place of the table's; new keys are
        added. Returns the new version, or the old one if the batch is empty.
        ``base`` is the version to build on, if it is not the newest: what came
        behind it is left out of the new one."""
        newest = self.version()
        version = newest if base is None else base
        if version < 0:
            return self.create(batch, order_by, newest + 1)
        last = settled(latest(batch, self.keys, order_by))
        files = settled(self.files(version))
        first = F.col(quoted(self.keys[0]))
        # A row per range of the batch: ranges of both sides are few.
        ranges = settled(last.select(first.alias("_key")).repartitionByRange("_key").groupBy(F.spark_partition_id()).agg(
            F.min("_key").alias("_from"), F.max("_key").alias("_to"), F.count_if(F.col("_key").isNull()).alias("_nulls")))
        if ranges.isEmpty():
            return version
        meets = ((F.col("_from") <= F.col("most")) & (F.col("_to") >= F.col("least"))) | (
            (F.col("_nulls") > 0) & (F.col("nulls") > 0))
        near = [r["file"] for r in files.join(broadcast_if_small(ranges), meets, "left_semi").collect()]
        columns = last.select(*[quoted(c) for c in self.read(version).columns])
        keys = last.select(*[F.col(quoted(k)).alias(f"_{k}") for k in self.keys])
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(quoted(k)).eqNullSafe(F.col(quoted(f"_{k}")))
        # Only keys of the files nearby are read to find those that change.
        nearby = self._rows(near, columns.schema)
        hit = settled(nearby.select(*[quoted(k) for k in self.keys], plain_path(F.col("_metadata.file_path")).alias("_file"))
                      .join(keys, same, "left_semi").select("_file").distinct()) if near else None
        changed = [r["_file"] for r in hit.collect()] if near else []
        kept = self._rows(changed, columns.schema).join(keys, same, "left_anti")
        folder = self._folder()
        added = self._written(kept.unionByName(columns), folder)
        rest = files.filter(~F.col("file").isin(changed)) if len(changed) < 1000 else files.join(
            broadcast_if_small(hit.withColumnRenamed("_file", "file")), "file", "left_anti")
        return self._commit(rest.drop("folder").unionByName(added), folder, newest + 1)
