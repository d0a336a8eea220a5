"""JSON files: array, object and line-delimited roots, flattened to dotted
columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cellmend.functions.normalize import quoted
from cellmend.operators.sizing import broadcast_if_small, settled, settled_by_column
from cellmend.sources.text import read_lines

UNSUPPORTED = "Unsupported JSON root type"
MALFORMED = "Malformed JSON"
_LEVELS_A_PLAN = 6  # levels opened before the lineage is cut


def json_text(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def is_json(text: Column) -> Column:
    """The text is exactly one JSON value.

    The parser itself takes a value with something behind it. Put into an array
    before its own hash, a text is one value only if it is the first of two
    elements and the hash the second. An object with a key twice is no valid
    value here.
    """
    mark = F.xxhash64(text)
    elements = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]"))),
        "$", "array<variant>")
    # Within an array of one, so that the text is parsed once.
    whole = F.exists(F.array(elements), lambda e: (F.size(e) == 2) & (
        F.try_variant_get(F.get(e, 1), "$", "bigint") == mark))
    return F.coalesce(whole, F.lit(False))


def is_object_line(line: Column) -> Column:
    """The line is blank or starts like a JSON object. Whether it is a valid one
    is settled per record: a bad line is an error row of its own."""
    text = json_text(line)
    return (text == "") | (text.startswith("{") & F.json_object_keys(text).isNotNull())


def line_records(lines: DataFrame) -> DataFrame:
    """Records of files with one object per line; such files stay split. A line
    that is not exactly one object is an error without a record."""
    text = json_text(F.col("line"))
    valid = is_json(text)
    return lines.filter(text != "").select(
        "file_path", F.when(valid, text).alias("record"),
        F.when(~valid, MALFORMED).alias("error"))


_PIECES = 64  # pieces between commas that are looked through as one


def _units(lines: DataFrame, joint: str) -> DataFrame:
    """Lines, the long ones cut at every 64th comma: ``comma`` tells whether one
    stands before."""
    place = ["file_path", "block", "line_no"]
    if joint == ",":
        return lines.select(*place, F.lit(0).alias("part_no"), F.lit(True).alias("comma"), F.col("line").alias("part"))
    commas = F.length("line") - F.length(F.replace("line", F.lit(","), F.lit("")))
    cut = F.expr(f"transform(array(split(line, ',', -1)), p -> transform(sequence(0, (size(p) - 1) div {_PIECES}), "
                 f"i -> array_join(slice(p, i * {_PIECES} + 1, {_PIECES}), ',')))[0]")
    return lines.select(*place, F.posexplode(F.when(commas < _PIECES, F.array("line")).otherwise(cut)).alias(
        "part_no", "part")).withColumn("comma", F.col("part_no") > 0)


def _bare(text: Column) -> Column:
    """A text without escapes and what they escape."""
    return F.when(text.contains("\\"), F.regexp_replace(text, r"(?s)\\.", "")).otherwise(text)


def _quotes(bare: Column) -> Column:
    return (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))).cast("bigint")


def _rise(bare: Column) -> Column:
    """Opened minus closed brackets outside strings."""
    outside = F.regexp_replace(bare, r'"[^"]*+(?:"|\z)', "")
    rise = F.length(F.translate(outside, "]}", "")) - F.length(F.translate(outside, "[{", ""))
    return F.when(bare.rlike(r"[\[\]{}]"), rise).otherwise(0).cast("bigint")


def _heads(pieces: Column) -> Column:
    """Numbers of the pieces that begin an element, of at most ``_PIECES``: a
    comma outside strings at depth 1 stands before them."""
    def step(acc, piece):
        is_head = ((acc["no"] > 0) | F.col("comma")) & ~acc["inside"] & (acc["depth"] == 1)
        rise = _rise(F.when(acc["inside"], F.concat(F.lit('"'), piece)).otherwise(piece))
        return F.struct(
            (acc["no"] + 1).alias("no"), (acc["depth"] + rise).alias("depth"),
            (acc["inside"] != (_quotes(piece) % 2 == 1)).alias("inside"),
            F.when(is_head, F.concat(acc["heads"], F.array(acc["no"]))).otherwise(acc["heads"]).alias("heads"))

    start = F.struct(F.lit(0).alias("no"), F.col("depth_before").alias("depth"), F.col("inside").alias("inside"),
                     F.array().cast("array<int>").alias("heads"))
    none = F.array().cast("array<int>")
    walked = F.aggregate(F.transform(pieces, _bare), start, step, lambda acc: acc["heads"])
    # One or two pieces, as most lines are, need no walk.
    inside, first = F.col("inside"), _bare(F.get(pieces, F.lit(0)))
    rise = _rise(F.when(inside, F.concat(F.lit('"'), first)).otherwise(first))
    second = (F.size(pieces) == 2) & (inside == (_quotes(first) % 2 == 1)) & (F.col("depth_before") + rise == 1)
    few = F.concat(F.when(F.col("comma") & ~inside & (F.col("depth_before") == 1), F.array(F.lit(0))).otherwise(none),
                   F.when(second, F.array(F.lit(1))).otherwise(none))
    return F.when(F.col("root") == "[", F.when(F.size(pieces) > 2, walked).otherwise(few)).otherwise(none)


def _joined(order: Column, text: str) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order.alias("at"), F.col(text).alias("text")))),
                                    lambda p: p["text"]), "")


def _elements(lines: DataFrame, joint: str) -> DataFrame:
    """``(file_path, is_first, is_last, root, ends_well, text, valid)``: the
    elements of array roots, other roots as one element.

    A line maps (inside a string, depth) at its start to the same at its end:
    the quotes in it flip the first, and the second rises by one of two amounts,
    as the line starts outside or inside a string. Both compose, so a window
    per split over these numbers settles a split for either start, and one row
    per split carries the state across splits. With that known the lines are
    shuffled once, by split, and cut into elements there; what runs on over the
    end of a split, at most two rows a split, comes together afterwards, however
    many tasks read the file.
    """
    split = ["file_path", "block"]
    place = Window.partitionBy(*split).orderBy("line_no", "part_no")
    so_far = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = place.rowsBetween(Window.unboundedPreceding, -1)
    bare = F.col("bare")
    counted = _units(lines, joint).withColumn("bare", _bare(F.col("part"))).withColumns({
        "quotes": _quotes(bare), "plain": _rise(bare), "quoted": _rise(F.concat(F.lit('"'), bare))}).drop("bare")
    before = lambda start: (start + F.coalesce(F.sum("quotes").over(earlier), F.lit(0))) % 2 == 1
    own = lambda inside: F.when(inside, F.col("quoted")).otherwise(F.col("plain"))
    char = F.substring(F.ltrim("part", F.lit(" \t\r\n")), 1, 1)
    # One row per split: bounded by file size / split size.
    splits = (
        counted.withColumn("char", char).drop("part", "comma").withColumn("odd", before(F.lit(0)))
        .groupBy(*split).agg(
            F.sum("quotes").alias("q"), F.sum(own(F.col("odd"))).alias("r0"), F.sum(own(~F.col("odd"))).alias("r1"),
            F.min_by(F.when(F.col("char") != "", F.col("char")),
                     F.when(F.col("char") != "", F.struct("line_no", "part_no"))).alias("char")))
    by_split = Window.partitionBy("file_path").orderBy("block")
    until = by_split.rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("file_path")
    start = F.coalesce(F.sum("q").over(until), F.lit(0)) % 2
    starts = settled(
        splits.withColumn("start", start)
        .withColumn("rise", F.when(F.col("start") == 1, F.col("r1")).otherwise(F.col("r0")))
        .select(*split, "start", F.coalesce(F.sum("rise").over(until), F.lit(0)).alias("depth"),
                F.first("char", ignorenulls=True).over(
                    by_split.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("root"),
                ((F.sum("q").over(file) % 2 == 0) & (F.sum("rise").over(file) == 0)).alias("ends_well")))

    pieces = F.col("pieces")
    known = (
        counted.join(broadcast_if_small(starts), split)
        .withColumn("inside", before(F.col("start"))).withColumn("own", own(F.col("inside")))
        .withColumn("depth_after", F.col("depth") + F.sum("own").over(so_far))
        .withColumn("depth_before", F.col("depth_after") - F.col("own"))
        .withColumn("pieces", F.split("part", ",", -1)).withColumn("heads", _heads(pieces)).drop("part")
        # Elements are numbered within a split; 0 is what runs on from earlier ones.
        .withColumn("running", F.coalesce(F.sum(F.size("heads").cast("bigint")).over(earlier), F.lit(0).cast("bigint"))))
    joined = lambda lo, hi: F.array_join(F.slice(pieces, lo + 1, hi - lo), ",")
    text = lambda sep, lo, hi: F.concat(F.when(sep, ",").otherwise("\n"), joined(lo, hi))
    any_head, first = F.size("heads") > 0, F.get("heads", F.lit(0))
    segment = lambda element, text, depth: F.struct(
        element.alias("element"), text.alias("text"), depth.cast("bigint").alias("depth_after"))
    whole = segment(F.col("running"), F.concat(F.when(F.col("comma"), ",").otherwise("\n"), F.array_join(pieces, ",")), F.col("depth_after"))
    lead = segment(F.col("running"), text(F.col("comma"), F.lit(0), first), F.lit(1))
    # Blanks that end an element are trimmed anyway.
    no_lead = (first == 0) | (~F.col("comma") & (F.trim(joined(F.lit(0), first), F.lit(" \t\r")) == ""))
    following = F.transform("heads", lambda head, i: segment(
        F.col("running") + i + 1, text(F.lit(True), head, F.coalesce(F.get("heads", i + 1), F.size(pieces))),
        F.when(i + 1 < F.size("heads"), 1).otherwise(F.col("depth_after"))))
    segments = (F.when(~any_head, F.array(whole)).when(no_lead, following).otherwise(F.concat(F.array(lead), following)))
    order = F.struct("line_no", "part_no")
    cut = (
        known.select(*split, "line_no", "part_no", "root", "ends_well", F.inline(segments))
        .groupBy(*split, "element").agg(
            _joined(order, "text").alias("text"), F.first("root").alias("root"), F.first("ends_well").alias("ends_well"),
            F.max_by("depth_after", order).alias("depth_after")))
    # Each element is cut and parsed once; what follows reads this.
    space = F.lit(" \t\r\n")
    bare_text = lambda: F.substring("text", 2, 2_147_483_647)
    cut = settled_by_column(cut.withColumn("valid", F.when(F.col("element") > 0, is_json(F.trim(bare_text(), space)))))

    # An element that runs on from earlier splits: the last head before them.
    last = cut.groupBy(*split).agg(F.max("element").alias("last"))
    carried = F.last(F.when(F.col("last") > 0, F.struct("block", "last")), ignorenulls=True).over(until)
    ends = broadcast_if_small(settled(last.withColumn("carried", carried)))
    placed = cut.join(ends, split)
    open_ended = (F.col("element") == 0) | (F.col("element") == F.col("last"))
    key = F.when(F.col("element") == 0, F.col("carried")).otherwise(F.struct("block", F.col("element").alias("last")))
    tied = (
        placed.filter(open_ended).withColumn("key", key).groupBy("file_path", "key").agg(
            _joined(F.col("block"), "text").alias("text"), F.first("root").alias("root"),
            F.first("ends_well").alias("ends_well"), (F.max_by("depth_after", "block") <= 0).alias("is_last"))
        .select("file_path", F.col("key").isNull().alias("is_first"), "is_last", "root", "ends_well", bare_text().alias("text")))
    text, is_array = F.trim("text", space), F.col("root") == "["
    text = F.when(is_array & F.col("is_first"), F.substring(text, 2, 2_147_483_647)).otherwise(text)
    closed = F.when(text.endswith("]"), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise("]")
    tied = tied.withColumn("text", F.trim(F.when(is_array & F.col("is_last"), closed).otherwise(text), space))
    tied = settled_by_column(tied.withColumn("valid", is_json(F.col("text"))))
    return placed.filter(~open_ended).select(
        "file_path", F.lit(False).alias("is_first"), F.lit(False).alias("is_last"), "root", "ends_well",
        F.trim(bare_text(), space).alias("text"), "valid").unionByName(tied)


def document_records(lines: DataFrame, joint: str = "\n") -> DataFrame:
    """``(file_path, record, error)`` of files that are one JSON document each.

    An array of objects gives its elements, any other array one
    ``{"value": ...}`` per element, an empty array a row without record,
    another root an error. An element that is no JSON value is an error of its
    own; a file that ends inside a string or with brackets open has one.

    The unit of work is an element, not the file: ``lines`` may be lines
    (``joint`` a line end) or, of files that have few of those, what lies
    between commas (``read_lines`` with ``line_sep=","`` and ``joint=","``).
    """
    is_array = F.col("root") == "["
    found = _elements(lines, joint)
    kinds = found.filter(is_array & (F.col("text") != "")).groupBy("file_path").agg(
        F.bool_and(F.col("text").startswith("{")).alias("all_objects"))
    found = found.join(broadcast_if_small(settled(kinds)), "file_path", "left")
    nothing = is_array & F.col("is_first") & F.col("is_last") & (F.col("text") == "")
    valid = F.col("valid")
    value = (F.when(F.col("text").startswith('"'), F.concat(F.lit('{"value":'), "text", F.lit("}")))
             .when(F.col("text") == "null", "{}").otherwise(F.to_json(F.struct(F.col("text").alias("value")))))
    record = (F.when(nothing | ~valid, F.lit(None))
              .when(is_array, F.when(F.col("all_objects"), F.col("text")).otherwise(value))
              .when(F.col("root") == "{", F.col("text")))
    error = (F.when(F.col("is_first") & ~F.col("ends_well"), MALFORMED)
             .when(nothing, F.lit(None)).when(~valid, MALFORMED)
             .when(~is_array & (F.col("root") != "{"), UNSUPPORTED))
    return found.select("file_path", record.alias("record"), error.alias("error")).withColumn(
        "record", F.when(F.col("error").isNull(), F.col("record")))


def json_records(lines: DataFrame) -> DataFrame:
    """``(file_path, record, error)``: one row per JSON object of each file,
    whether it is line-delimited or a document."""
    kinds = lines.groupBy("file_path").agg(
        F.bool_and(is_object_line(F.col("line"))).alias("by_line"))
    kinds = settled(kinds)
    found = {r[0] for r in kinds.select("by_line").distinct().collect()}  # two at most
    if len(found) < 2:  # files of one kind need not be told apart
        return document_records(lines) if found == {False} else line_records(lines)
    known = lines.join(broadcast_if_small(kinds), "file_path")
    return line_records(known.filter("by_line")).unionByName(
        document_records(known.filter("NOT by_line")))


def nesting(record: Column) -> Column:
    """How deep the objects of a JSON text nest, at the most: objects within
    arrays count too. Texts are taken out first, without backtracking."""
    plain = F.replace(F.replace(record, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    braces = F.regexp_replace(F.regexp_replace(plain, '"[^"]*+"', ""), "[^{}]++", "")
    walked = lambda braces: F.aggregate(
        F.split(braces, ""), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda acc, c: F.struct(
            (acc["now"] + F.when(c == "{", 1).when(c == "}", -1).otherwise(0)).alias("now"),
            F.greatest(acc["most"], acc["now"] + F.when(c == "{", 1).otherwise(0)).alias("most")),
        lambda acc: acc["most"])
    # One or two levels, as most objects have, need no walk.
    inner = lambda b: F.replace(b, F.lit("{}"), F.lit(""))
    deep = F.transform(F.array(braces), lambda b: F.when(F.length(b) <= 2, F.lit(1)).when(
        inner(b) == "{}", 2).when(inner(inner(b)) == "{}", 3).otherwise(walked(b)))
    return F.when(record.isNotNull(), F.get(deep, F.lit(0)))


def flatten_cells(records: DataFrame, key: str = "file_path", depth: int | None = None) -> DataFrame:
    """``(key, column_name, value)`` per leaf, plus one row per record with a
    null name and the number of its top-level keys.

    Objects become dotted names, however deep they nest; arrays stay JSON text.
    Integers keep all their digits and floats stay floats. ``depth`` is the greatest depth
    if it is known; else one aggregate over the records finds it.
    """
    known = records.filter(F.col("record").isNotNull())
    if depth is None:
        depth = known.agg(F.max(nesting(F.col("record")))).first()[0] or 1

    def members(prefix: str) -> Column:
        """The members of an object, in SQL; null for any other node. The two
        readings of the object are zipped, so each is made once."""
        return F.expr(
            "transform(map_entries(map_zip_with(try_variant_get(node, '$', 'map<string,variant>'), "
            "coalesce(from_json(source, 'map<string,string>'), map()), "
            "(k, n, s) -> named_struct('node', n, 'source', s))), e -> "
            f"named_struct('name', concat({prefix}, e.key), 'node', e.value.node, 'source', e.value.source))")

    here = F.array(F.struct("name", "node", "source"))
    n_keys = F.size(F.map_keys(F.expr("try_variant_get(node, '$', 'map<string,variant>')"))).cast("string")
    width = F.array(F.struct(F.lit(None).cast("string").alias("name"),
                             F.parse_json(n_keys).alias("node"), n_keys.alias("source")))
    level = (
        known.select(key, F.try_parse_json("record").alias("node"), F.col("record").alias("source"))
        .select(key, F.inline(F.concat(width, members("''")))))
    for i in range(1, depth):
        if i % _LEVELS_A_PLAN == 0:  # very deep objects: keep the plan small
            level = settled(level.select(key, "name", F.to_json("node").alias("text"), "source")).select(
                key, "name", F.parse_json("text").alias("node"), "source")
        opened = F.when(F.col("name").isNotNull(), members("name, '.'"))
        level = level.select(key, F.inline(F.coalesce(opened, here)))
    # A null, a text and an array print as the parsed value, an integer with all
    # its digits, a float in full unless it is very large or small.
    real = F.col("source").try_cast("double")
    in_full = F.regexp_replace(F.regexp_replace(
        real.try_cast("decimal(38,20)").cast("string"), "0+$", ""), r"\.$", ".0")
    a_float = F.col("source").rlike("[.eE]")
    number = F.schema_of_variant("node").rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return level.select(
        key, F.col("name").alias("column_name"),
        F.when(number & a_float & ((real == 0) | F.abs(real).between(1e-4, 1e16)), in_full)
        .when(number, F.lower("source"))
        .otherwise(F.col("node").cast("string")).alias("value"))


def read_json_cells(spark: SparkSession, paths: str | list[str],
                    glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Cells of all JSON files, and the files that could not be read."""
    found = json_records(read_lines(spark, paths, glob))
    errors = found.filter(F.col("error").isNotNull()).select("file_path", "error")
    return flatten_cells(found), errors


def flatten_struct(df: DataFrame) -> DataFrame:
    """A table of nested structs as one of dotted columns."""
    def leaves(struct: T.StructType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
        found = []
        for field in struct.fields:
            here = (*path, field.name)
            found += leaves(field.dataType, here) if isinstance(field.dataType, T.StructType) else [here]
        return found

    return df.select(*[
        F.col(".".join(quoted(p) for p in path)).alias(".".join(path))
        for path in leaves(df.schema, ())])


def read_json_table(spark: SparkSession, paths: str | list[str],
                    multiline: bool = True) -> DataFrame:
    """JSON files of one shape as one flat table."""
    return flatten_struct(spark.read.option("multiLine", multiline).json(paths))
