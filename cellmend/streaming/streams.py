"""Incremental ingestion, windowed integrity, upsert and deduplication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from cellmend.functions.normalize import quoted
from cellmend.operators.cells import KEY_FIELDS, value_counts
from cellmend.operators.metrics import column_stats, finish_columns, pct
from cellmend.operators.tables import latest


def new_files(spark: SparkSession, root: str, schema: T.StructType | str,
              file_format: str = "parquet", glob: str | None = None,
              max_files: int | None = None) -> DataFrame:
    """A stream of the rows of files as they arrive below ``root``, each file
    once per checkpoint, with ``_file_source``."""
    reader = spark.readStream.schema(schema).format(file_format)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(root).withColumn("_file_source", F.col("_metadata.file_path"))


def ingest(stream: DataFrame, path: str, checkpoint: str,
           partition_by: list[str] | None = None) -> StreamingQuery:
    """Append what is new to a Parquet table, then stop. Run again for the
    files that came since."""
    writer = stream.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(path)


def windowed_counts(stream: DataFrame, ts: str, columns: list[str], width: str = "1 hour",
                    delay: str = "10 minutes") -> DataFrame:
    """Value counts per tumbling window and column.

    State is one count per distinct value of an open window; rows later than
    ``delay`` are dropped and closed windows leave the state.
    """
    windowed = stream.withWatermark(ts, delay).select(
        F.window(ts, width).alias("window"), *[F.col(quoted(c)) for c in columns])
    return value_counts(windowed, ["window"], columns)


#: Later than any event, and still a date that every reader takes.
_END = "9999-01-01 00:00:00"


def with_end(stream: DataFrame, ts: str, path: str) -> DataFrame:
    """The stream with the marks below ``path`` that say it has ended.

    A mark is a row whose time lies behind all events and whose other columns
    are null; with it the watermark passes the end of every open window. The
    window of the mark itself never closes, so it gives no row.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], f"{quoted(ts)} timestamp").write.mode("append").parquet(path)
    marks = spark.readStream.schema(f"{quoted(ts)} timestamp").parquet(path)
    return stream.unionByName(marks, allowMissingColumns=True)


def mark_end(spark: SparkSession, ts: str, path: str) -> None:
    """Say that a bounded stream has ended: run it once more, and the windows
    that were open are finished. Whatever comes behind is late."""
    spark.range(1).select(F.lit(_END).cast("timestamp").alias(ts)).write.mode("append").parquet(path)


def finish_windows(counts: DataFrame, columns: list[str]) -> DataFrame:
    """Integrity metrics per window and column from closed window counts."""
    flat = counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "col_idx", "kind", *KEY_FIELDS, "n")
    keys = ["window_start", "window_end", "col_idx"]
    done = finish_columns(column_stats(flat, keys))
    names = F.array(*[F.lit(c) for c in columns])
    return done.select(
        "window_start", "window_end",
        F.element_at(names, F.col("col_idx") + 1).alias("column_name"),
        F.col("n_cells").alias("cells"),
        pct(F.col("n_null"), F.col("n_cells")).alias("null_pct"),
        pct(F.col("n_off_type"), F.col("n_filled")).alias("type_deviation_pct"),
        F.round("delta", 3).alias("entropy_delta_pct"))


def write_windows(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write closed windows' counts once each, then stop."""
    return (counts.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(path))


def upsert_log(keys: list[str], path: str, order_by: Column | None = None,
               ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink: the batch's last row per key goes to the
    table's ``batch_id`` partition.

    Writing costs what the batch costs, never the table; a batch that is run
    again replaces its own partition and nothing else.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (latest(batch, keys, order_by).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
    return write


def upsert_stream(stream: DataFrame, keys: list[str], path: str, checkpoint: str,
                  order_by: Column | None = None) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(upsert_log(keys, path, order_by))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_upserted(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The current rows of an upsert log: the newest batch per key wins."""
    log = spark.read.option("basePath", path).parquet(path)
    columns = [c for c in log.columns if c != "batch_id"]
    newest = log.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(quoted(c)) for c in columns]), "batch_id").alias("_row"))
    return newest.select("_row.*")


def compact(spark: SparkSession, path: str, keys: list[str], out: str) -> None:
    """Fold an upsert log into one batch of a new log."""
    read_upserted(spark, path, keys).write.parquet(f"{out}/batch_id=0")


def dedup(stream: DataFrame, keys: list[str], ts: str, delay: str = "10 minutes") -> DataFrame:
    """First row per key; a key is remembered for ``delay`` of event time."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
