"""The stages over many files: from an inventory to schemas, and to cleaned rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cellmend.functions.clean import CLEANERS
from cellmend.functions.normalize import quoted
from cellmend.functions.semantic import semantic_type
from cellmend.operators import headers as H
from cellmend.operators.integrity_scan import OpenFiles, open_files
from cellmend.operators.sizing import broadcast_if_small, settled
from cellmend.sources.delimited import first_rows, record_cells
from cellmend.sources.json import flatten_cells
from cellmend.sources.sinks import write_cleaned

SAMPLE_ROWS = 6
_DECISION = ["has_header", "header_confidence", "needs_llm_review", "detection_reason"]
_DEFAULTS = dict(zip(_DECISION, (True, 0.9, False, "Unknown")))


def _heads(found: DataFrame) -> DataFrame:
    """The first records of each delimited file: a few rows per file."""
    return settled(first_rows(found, SAMPLE_ROWS).select("file_path", "row_id", "block", "line_no", "fields"))


def _without_first(found: DataFrame, heads: DataFrame, wanted: Column | None = None) -> DataFrame:
    """Records without the first one of each file (of the files in ``wanted``).
    Its place is one row per file, so no record needs a number."""
    first = heads.filter("row_id = 0")
    first = first.filter(wanted) if wanted is not None else first
    place = first.select("file_path", F.col("block").alias("_block"), F.col("line_no").alias("_line"))
    is_first = (F.col("block") == F.col("_block")) & (F.col("line_no") == F.col("_line"))
    return (found.join(broadcast_if_small(settled(place)), "file_path", "left")
            .filter(~F.coalesce(is_first, F.lit(False))).drop("_block", "_line"))


def _json_schemas(opened: OpenFiles) -> DataFrame | None:
    """Names and types of each JSON file's leaves, dotted, in order of name."""
    found = opened.json_records()
    if found is None:
        return None
    cells = flatten_cells(found).filter("column_name IS NOT NULL")
    types = H.infer_column_types(cells, ["file_path", "column_name"])
    fields = F.sort_array(F.collect_list(F.struct("column_name", "type")))
    listed = types.groupBy("file_path").agg(F.to_json(F.transform(fields, lambda f: F.struct(
        f["column_name"].alias("name"), f["type"].alias("type"),
        F.lit(True).alias("nullable")))).alias("schema"))
    problems = found.groupBy("file_path").agg(F.max("error").alias("problem"))
    return problems.join(listed, "file_path", "left").select(
        "file_path", *[F.lit(v).alias(c) for c, v in _DEFAULTS.items()],
        F.when(F.col("problem").isNotNull(), F.to_json(F.array(F.struct(F.col("problem").alias("error")))))
        .otherwise(F.coalesce("schema", F.lit("[]"))).alias("schema"),
        F.lit("[]").alias("generated_headers"))


def scan_schemas(spark: SparkSession, inventory: DataFrame, root: str) -> DataFrame:
    """The inventory with header decision, schema and suggested names of every
    file: ``has_header, header_confidence, needs_llm_review, detection_reason,
    schema, generated_headers``.

    Delimited files are decided on their first rows; a clear header gives a
    schema of all the data, any other decision suggested names. JSON files have
    the schema of their leaves, a bad one an ``error`` in its place, as has a
    delimited file that cannot be cut into records. A missing or unreadable file
    keeps the defaults and the reason why.
    """
    opened = open_files(spark, inventory, root)
    parts = []
    found = opened.text_records()
    if found is not None:
        heads = _heads(found)
        sample = H.sample_cells(heads)
        files = heads.select("file_path").distinct()
        detected = settled(H.detect_headers(sample))
        data = record_cells(_without_first(found, heads))
        parts.append(H._with_schemas(files, detected, sample, data, "file_path"))
    json = _json_schemas(opened)
    if json is not None:
        parts.append(json)
    if opened.problems is not None:
        parts.append(opened.problems.select(
            "file_path", *[F.lit(v).alias(c) for c, v in _DEFAULTS.items()],
            F.to_json(F.array(F.struct("error"))).alias("schema"), F.lit("[]").alias("generated_headers")))
    added = [*_DECISION, "schema", "generated_headers"]
    routed = opened.routed.withColumn("_path", F.trim("file_path"))
    if parts:
        known = reduce(DataFrame.unionByName, [p.select("file_path", *added) for p in parts])
        routed = routed.join(known.withColumnRenamed("file_path", "_path").withColumn("_known", F.lit(True)),
                             "_path", "left")
    else:
        routed = routed.select("*", *[F.lit(None).cast("string").alias(c) for c in [*added, "_known"]])
    why = (F.when(F.col("route_error") != "", F.col("route_error"))
           .when(F.col("_known").isNull(), "No columns to parse from file"))
    kept = [c for c in inventory.columns if c not in added]
    return routed.select(
        *[F.col(quoted(c)) for c in kept],
        *[F.coalesce(F.when(why.isNotNull(), why) if c == "detection_reason" else F.lit(None),
                     F.col(c), F.lit(v)).alias(c) for c, v in _DEFAULTS.items()],
        *[F.coalesce(c, F.lit("[]")).alias(c) for c in ("schema", "generated_headers")])


def _cleaned(kind: Column, value: Column) -> Column:
    """A value cleaned by the semantic type of its column's name."""
    out = value
    for known, cleaner in CLEANERS.items():
        out = F.when(kind == known, cleaner(value).cast("string")).otherwise(out)
    return out


def clean_files(spark: SparkSession, inventory: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Clean the rows of all files of an inventory in one job.

    Returns ``(file_path, row, names, values)``, one row per record, and the
    inventory with ``error`` for every file that gave none. ``inventory`` may
    hold ``has_header`` and ``generated_headers`` as ``scan_schemas`` adds them:
    names are those of the first record, or the generated ones, cut to the
    record's width; what has no name is ``column_<i>``. ``row`` orders the
    records of a file. JSON records are cleaned by their top-level keys.
    """
    opened = open_files(spark, inventory, root)
    parts, problems = [], []
    if opened.problems is not None:
        problems.append(opened.problems.withColumnRenamed("error", "problem"))
    found = opened.text_records()
    if found is not None:
        heads = _heads(found)
        named = heads.filter("row_id = 0").select("file_path", F.col("fields").alias("first"))
        given = (F.from_json("generated_headers", "array<string>")
                 if "generated_headers" in inventory.columns else F.lit(None).cast("array<string>"))
        known = opened.routed.select(F.trim("file_path").alias("file_path"), "headed", given.alias("given")
                                     ).dropDuplicates(["file_path"])
        # What a name says is settled once a file, not once a cell.
        names = settled(named.join(known, "file_path").select(
            "file_path", F.col("headed").alias("_headed"),
            F.coalesce(F.when(F.col("headed"), F.col("first")), "given",
                       F.array().cast("array<string>")).alias("_names"))
            .withColumn("_kinds", F.transform("_names", lambda name: semantic_type(name))))
        headed = heads.join(names.filter("_headed").select("file_path"), "file_path", "left_semi")
        rows = _without_first(found, headed).drop("headed").join(broadcast_if_small(names), "file_path")
        numbered = lambda i: F.concat(F.lit("column_"), i.cast("string"))
        padded = F.transform("fields", lambda v, i: F.coalesce(F.get("_names", i), numbered(i)))
        kinds = F.transform("fields", lambda v, i: F.when(F.get("_names", i).isNull(), semantic_type(numbered(i)))
                            .otherwise(F.get("_kinds", i)))
        # Blank lines are no records of a table.
        parts.append(rows.filter("width > 0").select(
            "file_path", F.struct("block", "line_no").alias("row"), padded.alias("names"),
            F.transform(F.arrays_zip("fields", kinds.alias("kinds")),
                        lambda cell: _cleaned(cell["kinds"], cell["fields"])).alias("values")))
    found = opened.json_records()
    if found is not None:
        states = settled(found.groupBy("file_path").agg(F.max("error").alias("problem")))
        problems.append(states)
        fine = found.filter("record IS NOT NULL").join(
            broadcast_if_small(states.filter("problem IS NULL").select("file_path")), "file_path")
        members = F.transform(F.map_entries(F.from_json("record", "map<string,string>")), lambda e: F.struct(
            e["key"].alias("key"), e["value"].alias("value"), semantic_type(e["key"]).alias("kind")))
        parts.append(fine.select("file_path", members.alias("m")).select(
            "file_path", F.struct(F.lit(0).cast("long").alias("block"),
                                  F.monotonically_increasing_id().alias("line_no")).alias("row"),
            F.transform("m", lambda e: e["key"]).alias("names"),
            F.transform("m", lambda e: _cleaned(e["kind"], e["value"])).alias("values")))
    routed = opened.routed.withColumn("_path", F.trim("file_path"))
    if problems:
        found = reduce(DataFrame.unionByName, problems)
        routed = routed.join(found.withColumnRenamed("file_path", "_path"), "_path", "left")
    else:
        routed = routed.withColumn("problem", F.lit(None).cast("string"))
    outcome = routed.select(*[F.col(quoted(c)) for c in inventory.columns],
                            F.when(F.col("route_error") != "", F.col("route_error"))
                            .otherwise(F.coalesce("problem", F.lit(""))).alias("error"))
    if not parts:
        empty = "file_path string, row struct<block:long,line_no:long>, names array<string>, values array<string>"
        return spark.createDataFrame([], empty), outcome
    return reduce(DataFrame.unionByName, parts), outcome


def write_cleaned_files(cleaned: DataFrame, path: str, file_format: str = "parquet",
                        mode: str = "errorifexists") -> None:
    """Cleaned rows below one folder per file: ``file_id`` is a digest of its
    path, so two files of one name stay apart."""
    write_cleaned(cleaned.withColumn("file_id", F.sha2("file_path", 256).substr(1, 16)),
                  path, ["file_id"], file_format, mode)

