"""Writers, and the reader that undoes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_quoted_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Every field quoted, quotes doubled, LF, UTF-8, header per file."""
    (df.write.mode(mode).option("header", True).option("quoteAll", True)
     .option("escape", '"').option("lineSep", "\n").option("encoding", "UTF-8")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def read_inventory_csv(spark: SparkSession, path: str) -> DataFrame:
    """A quoted inventory as text columns with lower-cased names; JSON with
    doubled quotes and values with newlines come back whole."""
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("escape", '"').option("multiLine", True).csv(path))
    return df.toDF(*[c.strip().lower() for c in df.columns])


def write_cleaned(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  file_format: str = "parquet", mode: str = "errorifexists") -> None:
    """A cleaned table, partitioned by what tells its sources apart, so that
    two files of the same name cannot overwrite each other."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if file_format == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(file_format).save(path)
