"""What earlier runs have read of each file, split by split.

A ledger row holds a split's number of lines and a digest of them in order. Of a
file that has grown, the old lines still give the old digests, and only what
comes behind them is new; a file whose old lines have changed is read as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cellmend.operators.sizing import broadcast_if_small, settled

SPLIT = ["file_path", "block"]


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with their number within the split, from 0, and a hash of both.
    A line's ``line_no`` grows by one within a split. Texts are hashed where they
    are read, so digests shuffle none."""
    first = F.min("line_no").over(Window.partitionBy(*SPLIT))
    return lines.withColumn("_text", F.xxhash64("line")).withColumn("_at", F.col("line_no") - first).withColumn(
        "_hash", F.xxhash64("_text", "_at")).drop("_text")


def split_ledger(lines: DataFrame) -> DataFrame:
    """``(file_path, block, n, digest)`` of all lines: a row per split."""
    return _numbered(lines).groupBy(*SPLIT).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("_hash").alias("digest"))


def new_lines(lines: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines that no earlier run has read, and ``(file_path, state)`` of the
    files: ``new``, ``same``, ``grown`` or ``rewritten``.

    ``lines`` come from the files that the listing calls new or changed; splits
    have to begin at the same bytes as in the ledger, which holds them as long as
    ``spark.sql.files.maxPartitionBytes`` stays.
    """
    known = settled(ledger.select(*SPLIT, F.col("n").alias("_n"), F.col("digest").alias("_digest")))
    # A row per split on the ledger's side.
    met = _numbered(lines).join(broadcast_if_small(known), SPLIT, "left")
    checked = met.groupBy(*SPLIT).agg(
        F.count(F.lit(1)).alias("n"), F.max("_n").alias("_n"), F.max("_digest").alias("_digest"),
        F.bit_xor(F.when(F.col("_at") < F.col("_n"), F.col("_hash"))).alias("digest"))
    splits = checked.join(known.select(*SPLIT, F.lit(True).alias("_known")), SPLIT, "full")
    gone = F.col("_known").isNotNull() & (F.col("n").isNull() | (F.col("n") < F.col("_n")) | (
        F.col("digest") != F.col("_digest")))
    longer = F.col("n") > F.coalesce("_n", F.lit(0))
    files = splits.groupBy("file_path").agg(
        F.bool_or(F.coalesce(gone, F.lit(False))).alias("rewritten"), F.bool_or(F.coalesce(longer, F.lit(False))).alias("longer"),
        F.bool_or(F.coalesce("_known", F.lit(False))).alias("known"), F.bool_or(F.col("n").isNotNull()).alias("there"),
    ).filter("there")  # files that are not among the lines are not judged
    state = (F.when(~F.col("known"), "new").when(F.col("rewritten"), "rewritten")
             .when(F.col("longer"), "grown").otherwise("same"))
    files = settled(files.select("file_path", state.alias("state")))
    wanted = met.join(broadcast_if_small(files), "file_path").filter(
        F.col("state").isin("new", "rewritten")
        | ((F.col("state") == "grown") & (F.col("_at") >= F.coalesce("_n", F.lit(0)))))
    return wanted.select(*lines.columns), files
