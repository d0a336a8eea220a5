"""The whole integrity scan: inventory in, one metrics row per file out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellmend.functions import fixed_values as fv
from cellmend.operators.file_profile import profile_json, profile_records
from cellmend.operators.inventory import route
from cellmend.operators.metrics import METRIC_FIELDS
from cellmend.operators.sizing import broadcast_if_small, settled
from cellmend.sources.delimited import detect_delimiter, records, sound_lines
from cellmend.sources.json import (
    MALFORMED, document_records, flatten_cells, is_json as valid_json, is_object_line, json_text,
    line_records, nesting)
from cellmend.sources.listing import scan_inventory
from cellmend.sources.text import ends_open, read_lines


def file_facts(lines: DataFrame) -> DataFrame:
    """What has to be known of each file before it can be split into records.

    One row per file: its separator, whether a quoted newline breaks a record,
    whether a JSON file has one object per line and, if it does, whether it has
    any, whether a line is bad and how deep objects nest. ``lines`` carries ``reader``.
    The rows are checkpointed: they are few, and every later branch needs them.
    """
    is_json = F.col("reader") == "json"
    text = F.col("text")
    # Each JSON line is parsed once: a valid one needs no second look.
    read = lines.withColumn("text", F.when(is_json, json_text(F.col("line")))).withColumn(
        "valid", F.when(text.startswith("{"), valid_json(text)))
    started = F.when(F.col("valid").isNotNull(), text)
    flags = read.groupBy("file_path", "reader").agg(
        F.bool_and(~is_json | F.coalesce("valid", F.lit(False)) | is_object_line(text)).alias("by_line"),
        F.bool_or(started.isNotNull()).alias("filled"),
        F.bool_or(F.coalesce(~F.col("valid"), F.lit(False))).alias("bad"), F.max(nesting(started)).alias("depth"),
        *[F.bool_or(~is_json & ends_open(F.col("line"), sep)).alias(f"broken_{i}")
          for i, sep in enumerate(fv.SEPARATORS)])
    # The test looks at a file's beginning only, hence at its first split.
    seps = detect_delimiter(lines.filter((F.col("block") == 0) & (F.col("reader") == "csv")))
    sep = F.when(F.col("reader") == "tsv", "\t").otherwise(F.coalesce("sep", F.lit(",")))
    broken = F.lit(False)
    for i, candidate in enumerate(fv.SEPARATORS):
        broken = F.when(F.col("sep") == candidate, F.col(f"broken_{i}")).otherwise(broken)
    return settled(
        flags.join(seps, "file_path", "left").withColumn("sep", sep)
        .select("file_path", "reader", "sep", broken.alias("broken"), "by_line", "filled",
                "bad", "depth"))


UNREADABLE = r"(?i)\.(zip|rar|xlsx|xls)$"
JSON_NAME = r"(?i)\.json$"


@dataclass
class OpenFiles:
    """The files of an inventory, ready to be read.

    ``routed``: the inventory with ``reader``, ``headed`` and ``route_error``;
    ``lines``: the lines of the files that can be read, with their facts;
    ``facts``: what ``file_facts`` found, a row per file;
    ``kinds``: which (reader, broken, by_line) occur;
    ``documents``: of the JSON files that are one document, what lies between
    commas, so that many tasks read a file without line ends;
    ``problems``: files that cannot be cut into records, and why; None if there
    are no quoted newlines at all.
    """
    routed: DataFrame
    lines: DataFrame
    facts: DataFrame
    kinds: set[tuple]
    documents: DataFrame | None = None
    problems: DataFrame | None = None

    def __post_init__(self):
        self._quoted = None
        if any(broken for reader, broken, _ in self.kinds if reader != "json"):
            quoted = self.lines.filter("reader <> 'json' AND broken")
            self._quoted, self.problems = sound_lines(quoted, F.col("sep"))

    def text_records(self) -> DataFrame | None:
        """Records of all delimited files without problems; None if there are none."""
        parts = []
        if any(not broken for reader, broken, _ in self.kinds if reader != "json"):
            parts.append(records(self.lines.filter("reader <> 'json' AND NOT broken"), F.col("sep"), False))
        if self._quoted is not None:
            parts.append(records(self._quoted, F.col("sep"), True))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def has(self, by_line: bool) -> bool:
        return any(kind == by_line for reader, _, kind in self.kinds if reader == "json")

    def object_lines(self) -> DataFrame:
        """The lines of the JSON files with one object each."""
        return self.lines.filter("reader = 'json' AND by_line")

    def json_records(self) -> DataFrame | None:
        """Records and errors of all JSON files; None if there are none."""
        parts = []
        if self.has(by_line=True):
            parts.append(line_records(self.object_lines()))
        if self.has(by_line=False):
            parts.append(document_records(self.documents, ","))
        return reduce(DataFrame.unionByName, parts) if parts else None


def open_files(spark: SparkSession, inventory: DataFrame, root: str) -> OpenFiles:
    """Match the files below ``root`` to the inventory by path; neither their
    names nor their contents pass through the driver."""
    routed = route(inventory, scan_inventory(spark, root))
    wanted = settled(routed.filter("route_error = ''").select(
        F.trim("file_path").alias("file_path"), "reader", "headed").dropDuplicates(["file_path"]))
    # Archives and spreadsheets are not opened, unless the inventory calls one a text.
    told = wanted.filter(F.col("file_path").rlike(UNREADABLE)).isEmpty()
    skip = UNREADABLE if told else None
    lines = read_lines(spark, root, skip=skip).join(broadcast_if_small(wanted), "file_path")
    facts = file_facts(lines)
    kinds = {(r["reader"], r["broken"], r["by_line"])
             for r in facts.select("reader", "broken", "by_line").distinct().collect()}  # 12 at most
    known = lines.drop("reader").join(broadcast_if_small(facts), "file_path")
    documents = None
    if any(reader == "json" and not by_line for reader, _, by_line in kinds):
        files = facts.filter("reader = 'json' AND NOT by_line").select("file_path")
        named = files.filter(~F.col("file_path").rlike(JSON_NAME)).isEmpty()
        documents = read_lines(spark, root, skip=skip, only=JSON_NAME if named else None, line_sep=",").join(
            broadcast_if_small(files), "file_path")
    return OpenFiles(routed, known, facts, kinds, documents)


def _json_outcomes(opened: OpenFiles) -> list[DataFrame]:
    """Metrics and problems of JSON files: of a file with a bad record the
    problem only, of an empty array those of a table without rows."""
    cells, states = [], []
    if opened.has(by_line=True):
        # The facts hold depth and validity, so the lines are read once more only.
        lines = opened.facts.filter("reader = 'json' AND by_line")
        depth = lines.agg(F.max("depth")).first()[0] or 1
        cells.append(flatten_cells(
            opened.object_lines().select("file_path", json_text(F.col("line")).alias("record")).filter("record <> ''"),
            depth=depth))
        states.append(lines.filter("filled").select(
            "file_path", F.when(F.col("bad"), MALFORMED).alias("problem")))
    if opened.has(by_line=False):
        found = document_records(opened.documents, ",")
        cells.append(flatten_cells(found))
        states.append(found.groupBy("file_path").agg(F.max("error").alias("problem")))
    if not cells:
        return []
    metrics = profile_json(reduce(DataFrame.unionByName, cells))
    fine = F.col("problem").isNull()
    return [reduce(DataFrame.unionByName, states).join(metrics, "file_path", "left").select(
        "file_path", *[F.when(fine, F.coalesce(m, F.lit(0).cast(metrics.schema[m].dataType))).alias(m)
                       for m in METRIC_FIELDS],
        F.coalesce("problem", F.lit("")).alias("problem"))]


def scan_files(spark: SparkSession, inventory: DataFrame, root: str) -> DataFrame:
    """Metrics and ``error`` for every inventory row.

    Two scans gather the facts (quotes, separators, JSON). Plain delimited files
    and JSON lines are read once more for the metrics; of files with quoted
    newlines first the states of lines alone. A bad or missing file becomes an
    error row and never stops the run.
    """
    opened = open_files(spark, inventory, root)
    routed = opened.routed
    outcomes = []
    found = opened.text_records()
    if found is not None:
        metrics = profile_records(found, "file_path", F.col("headed"))
        outcomes.append(metrics.withColumn("problem", F.lit("")))
    if opened.problems is not None:
        outcomes.append(opened.problems.select(
            "file_path", *[F.lit(None).cast("double").alias(m) for m in METRIC_FIELDS[:4]],
            *[F.lit(None).cast("bigint").alias(m) for m in METRIC_FIELDS[4:]], F.col("error").alias("problem")))
    outcomes += _json_outcomes(opened)

    by_path = routed.withColumn("_path", F.trim("file_path"))
    if outcomes:
        outcome = reduce(DataFrame.unionByName, outcomes)
        joined = by_path.join(outcome.withColumnRenamed("file_path", "_path"), "_path", "left")
    else:
        joined = by_path.select(
            "*", *[F.lit(None).cast("double").alias(m) for m in METRIC_FIELDS[:4]],
            *[F.lit(None).cast("bigint").alias(m) for m in METRIC_FIELDS[4:]],
            F.lit(None).cast("string").alias("problem"))
    return joined.select(
        *inventory.columns, *METRIC_FIELDS,
        F.when(F.col("route_error") != "", F.col("route_error"))
        .otherwise(F.coalesce("problem", F.lit("No columns to parse from file"))).alias("error"))
