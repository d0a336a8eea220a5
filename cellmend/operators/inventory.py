"""File inventories: categories, counts, move plans, numbering, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellmend.functions import fixed_values as fv
from cellmend.operators.ordering import running_total

ERROR_NO_PATH = "file_path is empty"
ERROR_MISSING = "File not found or empty: "  # listings leave out empty files


def filename_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension_of(path: Column) -> Column:
    """Lower-cased text behind the last dot; the whole name without a dot."""
    return F.lower(F.element_at(F.split(filename_of(path), r"\."), -1))


def categorize(files: DataFrame, merge_excel: bool = False) -> DataFrame:
    """Add ``category`` and ``target_dir`` from ``ext``; null for others."""
    target = F.lit(None).cast("string")
    for ext, folder in reversed(fv.CATEGORY_FOLDER):
        if merge_excel and ext == "xls":
            folder = "XLSX"
        target = F.when(F.col("ext") == ext, folder).otherwise(target)
    category = F.when(F.col("ext").isin(*[e for e, _ in fv.CATEGORY_FOLDER]), F.col("ext"))
    return files.withColumn("category", category).withColumn("target_dir", target)


def count_by_type(files: DataFrame) -> DataFrame:
    """Files per main type; zip and rar count as archives; a TOTAL row."""
    kind = F.when(F.col("ext").isin("zip", "rar"), "ARCHIVES").otherwise(F.upper("ext"))
    counted = (files.filter(F.col("ext").isin(*[e for e, _ in fv.CATEGORY_FOLDER]))
               .groupBy(kind.alias("file_type")).agg(F.count(F.lit(1)).alias("files")))
    return counted.rollup("file_type").agg(F.sum("files").alias("files")).select(
        F.coalesce("file_type", F.lit("TOTAL")).alias("file_type"),
        F.coalesce("files", F.lit(0)).alias("files"))


def unexpected_types(files: DataFrame, watch: tuple[str, ...] = fv.WATCHED_EXTENSIONS,
                     shown: int = 3) -> DataFrame:
    """Count per watched extension, its first paths, and how many more.

    The rank filter leaves each task at most ``shown`` rows per extension, so
    a flood of one extension never meets in one task.
    """
    watched = files.filter(F.col("ext").isin(*watch))
    counts = watched.groupBy("ext").agg(F.count(F.lit(1)).alias("files"))
    rank = F.row_number().over(Window.partitionBy("ext").orderBy("path"))
    first = (watched.select("ext", "path", rank.alias("r")).filter(F.col("r") <= shown)
             .groupBy("ext").agg(F.sort_array(F.collect_list("path")).alias("first_paths")))
    return counts.join(first, "ext").select(
        "ext", "files", "first_paths",
        F.greatest(F.col("files") - shown, F.lit(0)).alias("more"))


def organize_plan(files: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """What a move would do: per target and name the first path moves, the
    others are skipped; so is every name that ``existing`` already holds.

    The keepers are found by a partial aggregate and matched back on their
    path, which is unique, so a name shared by a third of the files is no hot
    key.
    """
    planned = files.filter(F.col("target_dir").isNotNull())
    keepers = planned.groupBy("target_dir", "filename").agg(F.min("path").alias("path"))
    if existing is not None:
        keepers = keepers.join(existing.select("target_dir", "filename").distinct(),
                               ["target_dir", "filename"], "left_anti")
    keepers = keepers.select("path", F.lit("move").alias("action"))
    return planned.join(keepers, "path", "left").select(
        "path", "filename", "target_dir",
        F.coalesce("action", F.lit("skip (exists)")).alias("action"))


def number_inventory(files: DataFrame) -> DataFrame:
    """Serial numbers 1..n in folder order, then path order."""
    rank = F.lit(len(fv.FOLDER_ORDER))
    for i, folder in reversed(list(enumerate(fv.FOLDER_ORDER))):
        rank = F.when(F.col("target_dir") == folder, i).otherwise(rank)
    ordered = files.filter(F.col("target_dir").isNotNull()).withColumn("_folder", rank)
    numbered = running_total(ordered, [F.col("_folder"), F.col("path")],
                             F.lit(1).cast("bigint"), "serial_number")
    return numbered.select("serial_number", "filename", F.col("target_dir").alias("file_type"),
                           F.col("path").alias("file_path"))


def append_inventory(old: DataFrame, new: DataFrame, detected: DataFrame | None = None) -> DataFrame:
    """Append ``new`` with serials that go on where ``old`` ends, and attach
    ``has_header`` and ``schema`` from ``detected`` by file name.

    ``new`` carries its own serials from 1; a name detected twice keeps one.
    """
    count = old.agg(F.count(F.lit(1)).alias("_count"))  # a single row
    shifted = (new.crossJoin(F.broadcast(count))
               .withColumn("serial_number", F.col("serial_number") + F.col("_count"))
               .drop("_count"))
    merged = old.unionByName(shifted, allowMissingColumns=True)
    if detected is None:
        return merged
    facts = detected.groupBy("filename").agg(
        F.max(F.struct("has_header", "schema")).alias("_facts"))
    return merged.join(facts, "filename", "left").select(
        *[c for c in merged.columns], F.col("_facts.has_header").alias("has_header"),
        F.col("_facts.schema").alias("schema"))


def truthy(col: Column) -> Column:
    """``true``, ``1``, ``yes``, ``y`` in any case; a missing value is true."""
    text = F.lower(F.trim(F.coalesce(col.cast("string"), F.lit("true"))))
    return text.isin("true", "1", "yes", "y")


def route(inventory: DataFrame, present: DataFrame) -> DataFrame:
    """Add ``reader``, ``headed`` and ``error`` to every inventory row.

    The reader follows the file type, or the path's extension where the type
    is a folder; archives and spreadsheets have no reader here. ``present``
    lists the existing paths in ``path``.
    """
    declared = F.regexp_replace(F.lower(F.trim(F.coalesce("file_type", F.lit("")))), r"^\.+", "")
    kind = F.when(declared.contains("/") | declared.isin("archives", "extracted"),
                  extension_of(F.col("file_path"))).otherwise(declared)
    path = F.trim(F.coalesce("file_path", F.lit("")))
    found = present.select(F.col("path").alias("_path"), F.lit(True).alias("_found")).distinct()
    seen = inventory.withColumn("_trimmed", path).join(
        found, F.col("_trimmed") == F.col("_path"), "left")
    archive = kind.isin("zip", "rar", "xlsx", "xls")
    header = F.col("has_header") if "has_header" in inventory.columns else F.lit(None)
    error = (F.when(path == "", ERROR_NO_PATH)
             .when(F.col("_found").isNull(), F.concat(F.lit(ERROR_MISSING), path))
             .when(archive, F.concat(F.lit("Unsupported file type: "), kind)))
    reader = F.when(kind == "tsv", "tsv").when(kind == "json", "json").otherwise("csv")
    return seen.select(
        *inventory.columns,
        F.when(error.isNull(), reader).alias("reader"), truthy(header).alias("headed"),
        F.coalesce(error, F.lit("")).alias("route_error"))


def limit_files(inventory: DataFrame, n: int) -> DataFrame:
    """The first n files by serial number."""
    return inventory.orderBy("serial_number").limit(n)


def incremental_new(inventory: DataFrame, processed: DataFrame, key: str = "file_path") -> DataFrame:
    """Files that no earlier run has processed."""
    return inventory.join(processed.select(key), key, "left_anti")


def chunk_files(files: DataFrame, limit_bytes: int = 1 << 30, by: str = "file_type") -> DataFrame:
    """Assign files to work units of about ``limit_bytes`` per type.

    A unit takes the files whose bytes before them, in path order and within
    the type, fall into the same multiple of the limit.
    """
    total = running_total(files, [F.col(by), F.col("path")], F.col("length"), "_through")
    before = F.col("_through") - F.col("length")
    start = total.groupBy(by).agg(F.min(before).alias("_start"))
    return total.join(start, by).select(
        *files.columns,
        F.floor((before - F.col("_start")) / limit_bytes).cast("bigint").alias("chunk"))


def execution_report(runs: DataFrame) -> DataFrame:
    """Totals by file type from one row per file, and a TOTAL row.

    ``runs`` has ``file_type, has_header, rows_in, rows_out, duplicates,
    nulls_filled``.
    """
    per_type = runs.groupBy("file_type").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if("has_header").alias("with_header"),
        F.count_if(~F.col("has_header")).alias("without_header"),
        *[F.sum(c).alias(c) for c in ("rows_in", "rows_out", "duplicates", "nulls_filled")])
    names = per_type.columns[1:]
    return per_type.rollup("file_type").agg(*[F.sum(c).alias(c) for c in names]).withColumn(
        "file_type", F.coalesce("file_type", F.lit("TOTAL")))
