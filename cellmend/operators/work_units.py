"""Files packed into work units of limited size.

Files beyond the limit are cut into byte ranges. What is left is counted by size
class, and best fit fills units from those counts: a plan has as many rows as
classes and kinds of units, whatever the number of files. Files are then
numbered within their class and take the places that the plan has for them.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, functions as F

from cellmend.operators.ordering import running_total
from cellmend.operators.sizing import broadcast_if_small, settled

#: Size classes: a length counts as the next multiple of a so-manieth of the limit.
CLASSES = 512


def best_fit(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(classes of a unit, number of such units): largest first, each into the
    unit with the least room that it fits. Units that hold the same are handled
    as one row, and a class that fits a unit several times goes in at once."""
    open_: dict[int, Counter] = {}  # room -> units by what they hold
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r, units in open_.items() if r >= length and units), default=None)
            if room is None:
                each = size // length
                whole, rest = divmod(left, each)
                for times, units in ((each, whole), (rest, 1 if rest else 0)):
                    if units:
                        open_.setdefault(size - times * length, Counter())[(length,) * times] += units
                break
            held, units = next(iter(open_[room].items()))
            each = min(room // length, left)
            used = min(units, max(1, left // each))
            open_[room][held] -= used
            if not open_[room][held]:
                del open_[room][held]
            open_.setdefault(room - each * length, Counter())[(*held, *(length,) * each)] += used
            left -= used * each
    return [(held, n) for units in open_.values() for held, n in units.items()]


def pack_files(files: DataFrame, limit_bytes: int = 1 << 30, by: str = "file_type") -> DataFrame:
    """``(by, path, start, length, unit)``: byte ranges of files in units of at
    most ``limit_bytes`` per type. A file of no more than that is one range.

    Files of length null or 0 have a place like any other. Ties go by path, and
    rows that repeat a path are ranges of their own.
    """
    length = F.coalesce(F.col("length"), F.lit(0)).cast("bigint")
    ranges = files.select(by, "path", length.alias("whole")).select(
        by, "path", "whole", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.greatest(F.col("whole") - 1, F.lit(0)), F.lit(limit_bytes).cast("bigint"))).alias("start"))
    ranges = ranges.withColumn("length", F.least(F.col("whole") - F.col("start"), F.lit(limit_bytes))).drop("whole")
    size = F.greatest(F.ceil(F.col("length") * CLASSES / limit_bytes), F.lit(1)).cast("int")
    ranges = ranges.withColumn("class", size)
    number = running_total(ranges, [F.asc_nulls_first(by), F.col("class"), F.col("path"), F.col("start")], F.lit(1).cast("bigint"), "number")
    number = settled(number)
    # A row per type and class: bounded by types, whatever the number of files.
    totals = settled(number.groupBy(by, "class").agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("first")))
    rows, unit = [], {}
    counts: dict = {}
    for row in totals.collect():
        counts.setdefault(row[by], {})[row["class"]] = row["n"]
    for kind, own in counts.items():
        taken, at = Counter(), unit.setdefault(kind, 0)
        for held, n in best_fit(own, CLASSES):
            # The k-th of n equal units takes ``each`` ranges of a class, one behind the other's.
            for size_, each in Counter(held).items():
                rows.append((kind, size_, taken[size_], taken[size_] + n * each, each, at))
                taken[size_] += n * each
            at += n
        unit[kind] = at
    kind_type = dict(number.dtypes)[by]
    plan = files.sparkSession.createDataFrame(
        rows, f"_kind {kind_type}, _class int, _from long, _to long, _each long, _unit long")
    placed = number.join(F.broadcast(totals.withColumnRenamed("class", "_c").withColumnRenamed(by, "_by")),
                         F.col(by).eqNullSafe(F.col("_by")) & (F.col("class") == F.col("_c")))
    place = F.col("number") - F.col("first")
    return placed.withColumn("_place", place).join(
        broadcast_if_small(plan), F.col(by).eqNullSafe(F.col("_kind")) & (F.col("class") == F.col("_class"))
        & (F.col("_place") >= F.col("_from")) & (F.col("_place") < F.col("_to"))
    ).select(by, "path", "start", "length",
             (F.col("_unit") + F.floor((F.col("_place") - F.col("_from")) / F.col("_each"))).cast("bigint").alias("unit"))
