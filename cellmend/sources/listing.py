"""File listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellmend.operators.inventory import extension_of, filename_of
from cellmend.sources.text import plain_path


def scan_inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``(path, filename, ext, length, modified)`` of every file below root.

    The contents are not selected, so no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(root).select(
        plain_path(F.col("_metadata.file_path")).alias("path"), "length",
        F.col("modificationTime").alias("modified"))
    return files.select(
        "path", filename_of(F.col("path")).alias("filename"),
        extension_of(F.col("path")).alias("ext"), "length", "modified")
