"""Lines of many text files, with their place in the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cellmend.functions import fixed_values as fv

PLACE = ["file_path", "block", "line_no"]


def plain_path(uri: Column) -> Column:
    """A file URI as an ordinary path: no ``file:`` scheme, no escapes."""
    bare = F.regexp_replace(uri, r"^file:/+", "/")
    return F.url_decode(F.replace(bare, F.lit("+"), F.lit("%2B")))


def read_lines(spark: SparkSession, paths: str | list[str], glob: str | None = None,
               skip: str | None = None, only: str | None = None,
               line_sep: str | None = None) -> DataFrame:
    """``(file_path, block, line_no, line)`` for all files below ``paths``.

    Files are split as usual, so one large file spreads over many tasks.
    ``block`` is the split's byte offset and ``line_no`` grows within a split:
    together they give the order of lines in a file without any shuffle. Files
    whose name matches ``skip``, or does not match ``only``, are never opened:
    the filter is on a constant of the file, so it prunes the listing. ``line_sep`` is another mark between
    "lines", where files have few line ends.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    files = reader.text(paths)
    if skip:
        files = files.filter(~F.col("_metadata.file_name").rlike(skip))
    if only:
        files = files.filter(F.col("_metadata.file_name").rlike(only))
    return files.select(
        plain_path(F.col("_metadata.file_path")).alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
    )


def _class_without(sep: str) -> str:
    return "[^" + ("\\" + sep if sep in "|^\\]-" else sep) + "]"


def tokenise(line: Column, sep: str) -> Column:
    """Fields of one record, still quoted. A record may span lines.

    A field is a quoted run with whatever follows up to the separator, or a
    plain run. An unclosed quote takes the rest of the record. All quantifiers
    over quoted text are possessive: no backtracking, whatever the length.
    """
    literal = "\\|" if sep == "|" else sep
    plain = _class_without(sep)
    field = literal + r'("[^"]*+(?:""[^"]*+)*+(?:"' + plain + r"*+|\z)|" + plain + "*+)"
    return F.when(line == "", F.array().cast("array<string>")).otherwise(
        F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(field), F.lit(1)))


def unquote(token: Column) -> Column:
    """The value of a field: outer quotes gone, doubled quotes single."""
    body = F.regexp_extract(token, r'^"([^"]*+(?:""[^"]*+)*+)', 1)
    rest = F.substr(token, F.length(body) + 3)
    return F.when(token.startswith('"'),
                  F.concat(F.replace(body, F.lit('""'), F.lit('"')), rest)).otherwise(token)


def fields_of(line: Column, sep: Column | str) -> Column:
    """Unquoted fields; ``sep`` is a separator or a column of separators."""
    if isinstance(sep, str):
        return F.transform(tokenise(line, sep), unquote)
    tokens = tokenise(line, fv.SEPARATORS[0])
    for candidate in fv.SEPARATORS[1:]:
        tokens = F.when(sep == candidate, tokenise(line, candidate)).otherwise(tokens)
    return F.transform(tokens, unquote)


def ends_open(line: Column, sep: Column | str) -> Column:
    """The last field of the text opens a quote and does not close it."""
    def check(candidate: str) -> Column:
        last = F.element_at(tokenise(line, candidate), -1)
        return last.rlike(r'^"[^"]*+(?:""[^"]*+)*+\z')
    if isinstance(sep, str):
        opened = check(sep)
    else:
        opened = check(fv.SEPARATORS[0])
        for candidate in fv.SEPARATORS[1:]:
            opened = F.when(sep == candidate, check(candidate)).otherwise(opened)
    return line.contains('"') & F.coalesce(opened, F.lit(False))
