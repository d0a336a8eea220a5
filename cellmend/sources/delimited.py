"""Records of delimited files: separators, quoted newlines, fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cellmend.functions import fixed_values as fv
from cellmend.operators.sizing import broadcast_if_small, settled
from cellmend.sources.text import ends_open, fields_of, read_lines, tokenise


def first_rows(rows: DataFrame, k: int, by: str = "file_path") -> DataFrame:
    """The first k rows of each file, numbered from 0 in ``row_id``.

    The rank filter is pushed below the shuffle, so each task passes on at
    most k rows per file however large the file is.
    """
    place = Window.partitionBy(by).orderBy("block", "line_no")
    return (rows.withColumn("row_id", F.row_number().over(place))
            .filter(F.col("row_id") <= k)
            .withColumn("row_id", F.col("row_id") - 1))


def detect_delimiter(lines: DataFrame, k: int = 20, by: str = "file_path") -> DataFrame:
    """``(file_path, sep)``: the separator that splits a file's first lines
    most evenly into more than one field; the comma when none does."""
    candidates = F.array(*[
        F.struct(F.lit(-i).alias("preference"), F.lit(sep).alias("sep"),
                 F.size(tokenise(F.col("line"), sep)).alias("width"))
        for i, sep in enumerate(fv.SEPARATORS)])
    widths = (first_rows(lines, k, by).filter(F.col("line") != "")
              .select(by, F.inline(candidates))
              .groupBy(by, "preference", "sep", "width").agg(F.count(F.lit(1)).alias("n")))
    per_sep = widths.groupBy(by, "preference", "sep").agg(
        (F.max("n") / F.sum("n")).alias("share"),
        F.max_by("width", F.struct("n", "width")).alias("width"))
    usable = F.when(F.col("width") > 1, F.struct("share", "width", "preference"))
    return per_sep.groupBy(by).agg(
        F.coalesce(F.max_by("sep", usable), F.lit(",")).alias("sep"))


#: A record with more bytes is an error of its file: it would not fit a row.
MAX_RECORD_BYTES = 256 << 20


def _by_state(lines: DataFrame, sep: Column | str) -> DataFrame:
    """Each line as a function of one bit, whether it starts inside quotes."""
    line = F.col("line")
    end_if_open = F.when(line.contains('"'),
                         ends_open(F.concat(F.lit('"'), line), sep).cast("int")).otherwise(1)
    return lines.withColumn("if_closed", ends_open(line, sep).cast("int")).withColumn("if_open", end_if_open)


def _with_heads(lines: DataFrame, by: str) -> DataFrame:
    """Add ``record``, the place of the line that a line's record begins with
    (null: the file's first), ``state``, whether it ends inside quotes, and
    ``number``, its number in the file.

    The functions of a bit compose, hence a window per split settles the lines,
    one row per split carries the state across splits, and no task ever sees a
    whole file.
    """
    place = Window.partitionBy(by, "block").orderBy("line_no")
    so_far = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips = (F.col("if_closed") == 1) & (F.col("if_open") == 0)
    fixed = F.col("if_closed") == F.col("if_open")
    traced = (
        lines.withColumn("flips", F.sum(flips.cast("int")).over(so_far))
        .withColumn("within", F.row_number().over(place))
        .withColumn("base", F.last(
            F.when(fixed, (F.col("if_closed") + F.col("flips")) % 2), ignorenulls=True)
            .over(so_far))
    )
    # One row per split: bounded by file size / split size.
    splits = traced.groupBy(by, "block").agg(
        F.count(F.lit(1)).alias("n"), F.max_by(F.struct("flips", "base"), "line_no").alias("end"))
    split_order = Window.partitionBy(by).orderBy("block").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    previous = Window.partitionBy(by).orderBy("block")
    starts = (
        splits.select(by, "block", "n", F.col("end.flips").alias("f"), F.col("end.base").alias("b"))
        .withColumn("total", F.sum("f").over(split_order))
        .withColumn("anchor", F.last(
            F.when(F.col("b").isNotNull(), (F.col("b") + F.col("f") + F.col("total")) % 2),
            ignorenulls=True).over(split_order))
        .withColumn("state", (F.coalesce("anchor", F.lit(0)) + F.col("total")) % 2)
        .select(by, "block", (F.sum("n").over(split_order) - F.col("n")).alias("lines_before"),
                F.coalesce(F.lag("state").over(previous), F.lit(0)).alias("start"))
    )
    opened = (
        traced.join(starts, [by, "block"])
        .withColumn("state", (F.coalesce("base", "start") + F.col("flips")) % 2)
        .withColumn("number", F.col("lines_before") + F.col("within"))
        .withColumn("inside", F.coalesce(F.lag("state").over(place), F.col("start")))
        .withColumn("head", F.last(
            F.when(F.col("inside") == 0, F.struct("block", "line_no")), ignorenulls=True)
            .over(so_far))
    )
    # A record that runs on from earlier splits: the last head before them.
    heads = opened.groupBy(by, "block").agg(F.max("head").alias("last_head"))
    carried = heads.select(
        by, "block", F.last("last_head", ignorenulls=True).over(
            previous.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    return opened.join(carried, [by, "block"]).withColumn("record", F.coalesce("head", "carried"))


def record_problems(lines: DataFrame, sep: Column | str = ",", by: str = "file_path",
                    max_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """``(file_path, error)`` of files that cannot be cut into records: a quote
    that is never closed, or a record of too many bytes, with the line it begins
    in. Only states and lengths of lines are shuffled, and a record's bytes are
    summed, not gathered."""
    states = _by_state(lines, sep).select(
        by, "block", "line_no", "if_closed", "if_open",
        (F.octet_length("line") + 1).cast("bigint").alias("bytes"))
    found = _with_heads(states, by).groupBy(by, "record").agg(
        F.sum("bytes").alias("bytes"), F.min("number").alias("first"),
        F.max_by("state", F.struct("block", "line_no")).alias("state"))
    # Only a file's last record can end inside quotes.
    first = lambda wanted: F.min(F.when(wanted, F.col("first"))).cast("string")
    opened, large = first(F.col("state") == 1), first(F.col("bytes") > max_bytes)
    return found.groupBy(by).agg(
        F.when(opened.isNotNull(), F.concat(F.lit("Unclosed quote from line "), opened))
        .when(large.isNotNull(), F.concat(F.lit(f"Record of over {max_bytes} bytes from line "), large))
        .alias("error")).filter("error IS NOT NULL")


def stitch_records(lines: DataFrame, sep: Column | str = ",", by: str = "file_path") -> DataFrame:
    """Join lines that a quoted newline split, in files of any size.

    A quote that is never closed runs to the end of the file (without its last
    newline); ``record_problems`` tells of such files beforehand.
    """
    named = _with_heads(_by_state(lines, sep), by)
    extra = [c for c in lines.columns if c not in (by, "block", "line_no", "line")]
    parts = F.sort_array(F.collect_list(F.struct("block", "line_no", "line")))
    return (
        named.groupBy(by, "record")
        .agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("line"),
             *[F.first(c).alias(c) for c in extra])
        .select(by, F.col("record.block").alias("block"),
                F.col("record.line_no").alias("line_no"), "line", *extra)
    )


def sound_lines(lines: DataFrame, sep: Column | str = ",", by: str = "file_path",
                max_bytes: int = MAX_RECORD_BYTES) -> tuple[DataFrame, DataFrame]:
    """The lines of the files that can be cut into records, and the problems of
    the others."""
    problems = settled(record_problems(lines, sep, by, max_bytes))
    return lines.join(broadcast_if_small(problems.select(by)), by, "left_anti"), problems


def records(lines: DataFrame, sep: Column | str = ",", multiline: bool | str = "auto",
            by: str = "file_path") -> DataFrame:
    """Lines as records with ``fields`` and ``width``.

    ``multiline=False`` takes each line as a record and never shuffles.
    ``'auto'`` first looks, in one pass with a row per file, for files in which
    some line ends inside quotes, and stitches only those.
    """
    if multiline == "auto":
        broken = broadcast_if_small(settled(
            lines.groupBy(by).agg(F.bool_or(ends_open(F.col("line"), sep)).alias("broken"))
            .filter("broken").select(by)))
        whole = lines.join(broken, by, "left_anti")
        lines = whole.unionByName(stitch_records(lines.join(broken, by, "left_semi"), sep, by))
    elif multiline:
        lines = stitch_records(lines, sep, by)
    fields = fields_of(F.col("line"), sep)
    return (lines.withColumn("fields", fields)
            .withColumn("width", F.size("fields")).drop("line"))


def read_delimited_records(spark: SparkSession, paths: str | list[str], sep: str | None = None,
                           multiline: bool | str = "auto", glob: str | None = None) -> DataFrame:
    """Records of all delimited files below ``paths``; ``sep=None`` detects
    the separator per file."""
    lines = read_lines(spark, paths, glob)
    if sep is not None:
        return records(lines, sep, multiline)
    seps = settled(detect_delimiter(lines.filter(F.col("block") == 0)))
    detected = lines.join(broadcast_if_small(seps), "file_path")
    return records(detected, F.col("sep"), multiline)


def read_delimited(spark: SparkSession, paths: str | list[str], sep: str | None = None,
                   glob: str | None = None, max_bytes: int = MAX_RECORD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Records of the files that can be cut into records, and ``(file_path,
    error)`` of the others: one bad file does not stop the rest."""
    lines = read_lines(spark, paths, glob)
    if sep is None:
        seps = settled(detect_delimiter(lines.filter(F.col("block") == 0)))
        lines = lines.join(broadcast_if_small(seps), "file_path")
    else:
        lines = lines.withColumn("sep", F.lit(sep))
    sound, problems = sound_lines(lines, F.col("sep"), max_bytes=max_bytes)
    return records(sound, F.col("sep"), "auto"), problems


def read_tsv_records(spark: SparkSession, paths: str | list[str],
                     multiline: bool | str = "auto") -> DataFrame:
    """Tab-separated files: the separator is never guessed."""
    return read_delimited_records(spark, paths, "\t", multiline)


def read_delimited_table(spark: SparkSession, paths: str | list[str], sep: str = ",",
                         header: bool = True, multiline: bool = False) -> DataFrame:
    """Files of one shape as one table of text columns."""
    return (spark.read.option("header", header).option("sep", sep)
            .option("inferSchema", False).option("mode", "PERMISSIVE")
            .option("encoding", "UTF-8").option("multiLine", multiline)
            .option("escape", '"').csv(paths))


def record_cells(rows: DataFrame, by: list[str] = ("file_path",)) -> DataFrame:
    """``(*by, block, line_no, col_idx, value)``: one row per field."""
    keep = [*by, "block", "line_no"] + (["row_id"] if "row_id" in rows.columns else [])
    return rows.select(*keep, F.posexplode("fields").alias("col_idx", "value"))
