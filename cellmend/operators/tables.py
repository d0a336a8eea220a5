"""Table-level cleaning steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from cellmend.functions.normalize import quoted
from cellmend.operators.headers import apply_headers
from cellmend.operators.ordering import running_total

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def dedup_exact(df: DataFrame) -> DataFrame:
    """Each distinct row once."""
    return df.dropDuplicates()


def drop_null_keys(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Drop rows whose key is null; the key is the first column by default."""
    keys = keys or df.columns[:1]
    filled = F.lit(True)
    for key in keys:
        filled = filled & F.col(quoted(key)).isNotNull()
    return df.filter(filled)


def fill_nulls(df: DataFrame, value: str = "UNKNOWN") -> DataFrame:
    """Fill nulls of text columns."""
    texts = set(_text_columns(df))
    return df.select(*[
        F.coalesce(F.col(quoted(c)), F.lit(value)).alias(c) if c in texts else F.col(quoted(c))
        for c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    """Text columns in which every non-null value is a number.

    One aggregate over one pass; a single row of flags reaches the driver.
    """
    texts = _text_columns(df)
    if not texts:
        return []
    flags = df.agg(*[
        F.coalesce(F.bool_and(F.col(quoted(c)).rlike(_NUMBER)), F.lit(False)).alias(f"c{i}")
        for i, c in enumerate(texts)]).first()
    return [c for i, c in enumerate(texts) if flags[i]]


def convert_types(df: DataFrame, numeric: list[str] | None = None) -> DataFrame:
    """Make wholly numeric text columns double; keep the others as text."""
    numeric = set(numeric_columns(df) if numeric is None else numeric)
    return df.select(*[
        F.trim(F.col(quoted(c))).try_cast("double").alias(c) if c in numeric else F.col(quoted(c))
        for c in df.columns])


def trim_strings(df: DataFrame) -> DataFrame:
    texts = set(_text_columns(df))
    return df.select(*[
        F.trim(F.col(quoted(c))).alias(c) if c in texts else F.col(quoted(c)) for c in df.columns])


def add_lineage(df: DataFrame, source: Column | str) -> DataFrame:
    """Add ``_file_source`` and ``_cleaned_at``. Pass
    ``F.col("_metadata.file_path")`` for a table just read from files."""
    source = F.lit(source) if isinstance(source, str) else source
    return df.withColumn("_file_source", source).withColumn("_cleaned_at", F.current_timestamp())


def clean_table(df: DataFrame, names: list[str] | None = None, keys: list[str] | None = None,
                fill: str = "UNKNOWN", source: Column | str | None = None) -> DataFrame:
    """Rename, deduplicate, drop null keys, fill nulls, convert types, trim,
    and add lineage when a source is given, in that order.

    Which columns are numeric does not depend on repeated rows, so that is
    found before the deduplication and its shuffle runs once.
    """
    if names is not None:
        df = apply_headers(df, names)
    numeric = numeric_columns(fill_nulls(drop_null_keys(df, keys), fill))
    df = fill_nulls(drop_null_keys(dedup_exact(df), keys), fill)
    df = trim_strings(convert_types(df, numeric))
    return add_lineage(df, source) if source is not None else df


def clean_counters(df: DataFrame, by: list[str] = (), keys: list[str] | None = None) -> DataFrame:
    """What :func:`clean_table` does to each table of ``by``: ``rows_in``,
    ``duplicates``, ``null_keys``, ``nulls_filled``, ``rows_out``.

    ``df`` holds the rows of many tables told apart by the columns ``by``. The
    rows are counted by content with a map-side combine, once for all numbers.
    """
    columns = [c for c in df.columns if c not in by]
    keys = keys or columns[:1]
    texts = [c for c in _text_columns(df) if c in columns]
    distinct = df.groupBy(*[F.col(quoted(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(quoted(key)).isNotNull()
    gaps = F.lit(0)
    for c in texts:
        gaps = gaps + F.col(quoted(c)).isNull().cast("bigint")
    return distinct.groupBy(*[F.col(quoted(c)) for c in by]).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
        F.count_if(~keyed).alias("null_keys"),
        F.coalesce(F.sum(F.when(keyed, gaps)), F.lit(0)).alias("nulls_filled"),
        F.count_if(keyed).alias("rows_out"))


def watched(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """The rows with a counter on them, which fills while they are written.

    The counter belongs behind the last shuffle of what is written: there each
    row is counted once, even if tasks run again.
    """
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns")), seen


def stage_report(spark: SparkSession, seen: dict[str, Observation]) -> DataFrame:
    """One row per stage that was written: row and column counts, whether both
    are positive. Reads no data."""
    rows = [(stage, o.get["rows"], o.get["columns"], o.get["rows"] > 0 and o.get["columns"] > 0)
            for stage, o in seen.items()]
    return spark.createDataFrame(rows, "stage string, rows long, columns int, passed boolean")


def validate_stage(df: DataFrame, stage: str,
                   write: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """One row: stage, row and column counts, whether both are positive.

    With ``write`` the rows are counted by the job that writes them; without
    it, one aggregate counts them.
    """
    if write is not None:
        rows, seen = watched(df, stage)
        write(rows)
        return stage_report(df.sparkSession, {stage: seen})
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(stage).alias("stage"), "rows", F.lit(len(df.columns)).alias("columns"),
        ((F.col("rows") > 0) & F.lit(len(df.columns) > 0)).alias("passed"))


COUNTERS = ("rows_in", "duplicates", "null_keys", "nulls_filled", "rows_out")


def write_cleaned_table(df: DataFrame, write: Callable[[DataFrame], None], names: list[str] | None = None,
                        keys: list[str] | None = None, fill: str = "UNKNOWN",
                        numeric: list[str] | None = None) -> dict[str, int]:
    """Write what :func:`clean_table` gives and return its counters, from the
    same job: one scan and one shuffle if ``numeric`` names the numeric columns.

    Distinct rows are grouped with their numbers of copies; all counters are
    taken behind that shuffle, in the stage that writes, whose tasks count once.
    """
    if names is not None:
        df = apply_headers(df, names)
    keys = keys or df.columns[:1]
    if numeric is None:
        numeric = numeric_columns(fill_nulls(drop_null_keys(df, keys), fill))
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(quoted(key)).isNotNull()
    gaps = F.lit(0).cast("bigint")
    for c in _text_columns(df):
        gaps = gaps + F.col(quoted(c)).isNull().cast("bigint")
    seen = Observation("cleaned table")
    distinct = df.groupBy(*[F.col(quoted(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies")).observe(
        seen, F.sum("_copies").alias("rows_in"), F.sum(F.col("_copies") - 1).alias("duplicates"),
        F.count_if(~keyed).alias("null_keys"), F.sum(F.when(keyed, gaps)).alias("nulls_filled"),
        F.count_if(keyed).alias("rows_out"))
    kept = fill_nulls(drop_null_keys(distinct, keys).drop("_copies"), fill)
    write(trim_strings(convert_types(kept, numeric)))
    return {c: seen.get[c] or 0 for c in COUNTERS}


def exact_quantiles(df: DataFrame, column: str, quantiles: list[float]) -> DataFrame:
    """One row ``q0, q1, ..``: interpolated quantiles of any size of table.

    Equal values are counted first; the running count over the distinct
    values is range-partitioned, so no task holds all of them.
    """
    counts = (df.select(F.col(quoted(column)).cast("double").alias("v"))
              .filter(F.col("v").isNotNull() & ~F.isnan("v"))
              .groupBy("v").agg(F.count(F.lit(1)).alias("n")))
    through = running_total(counts, [F.col("v")], F.col("n"), "through")
    total = through.agg(F.max("through").alias("total"))  # a single row
    placed = through.crossJoin(F.broadcast(total))
    picks = []
    for i, q in enumerate(quantiles):
        rank = (F.col("total") - 1) * F.lit(q)
        picks += [F.min(F.when(F.col("through") > F.floor(rank), F.col("v"))).alias(f"lo{i}"),
                  F.min(F.when(F.col("through") > F.ceil(rank), F.col("v"))).alias(f"hi{i}"),
                  F.max(rank - F.floor(rank)).alias(f"part{i}")]
    return placed.agg(*picks).select(*[
        (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"part{i}")).alias(f"q{i}")
        for i in range(len(quantiles))])


#: Size of a quantile sketch: ranks are off by at most some 0.2 percent of the
#: rows (99 of 100 times), and a sketch takes some 20 KB.
SKETCH_SIZE = 2000


def quantile_sketches(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """``(*by, column_name, sketch)``: a KLL sketch of each column of each part
    of a table (a file, a day). Sketches of parts merge, so those of new parts
    are appended to a stored table and old parts are not read again."""
    sketches = df.groupBy(*[F.col(quoted(b)) for b in by]).agg(*[
        F.kll_sketch_agg_double(F.when(~F.isnan(c), c), SKETCH_SIZE).alias(f"s{i}")
        for i, c in enumerate(F.col(quoted(name)).cast("double") for name in columns)])
    return sketches.select(*[F.col(quoted(b)) for b in by], F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"s{i}").alias("sketch"))
        for i, name in enumerate(columns)])))


def sketched_quantiles(sketches: DataFrame, quantiles: list[float]) -> DataFrame:
    """``(column_name, n, q0, q1, ..)`` of all parts together."""
    merged = sketches.groupBy("column_name").agg(F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("s"))
    n = F.kll_sketch_get_n_double("s")
    return merged.select("column_name", n.alias("n"), *[
        F.when(n > 0, F.kll_sketch_get_quantile_double("s", F.lit(float(q)))).alias(f"q{i}")
        for i, q in enumerate(quantiles)])


def iqr_outliers(df: DataFrame, column: str, factor: float = 1.5, exact: bool = True,
                 sketches: DataFrame | None = None) -> DataFrame:
    """Keep rows within ``factor`` interquartile ranges of the quartiles.

    With ``sketches`` the quartiles are those of the stored sketches of the
    column, and only ``df`` is read: the new part of a growing table. Else
    ``exact=False`` takes Spark's sketched percentiles: one pass, and quartiles
    off by at most 1/10000 of the rows' rank.
    """
    col = F.col(quoted(column))
    if sketches is not None:
        bounds = sketched_quantiles(sketches.filter(F.col("column_name") == column), [0.25, 0.75]).select("q0", "q1")
    elif exact:
        bounds = exact_quantiles(df, column, [0.25, 0.75])
    else:
        bounds = df.agg(F.percentile_approx(col, [0.25, 0.75], 10000).alias("p")).select(
            F.col("p")[0].alias("q0"), F.col("p")[1].alias("q1"))
    reach = (F.col("q1") - F.col("q0")) * factor
    limits = bounds.select((F.col("q0") - reach).alias("_low"), (F.col("q1") + reach).alias("_high"))
    # A single row of bounds joins every row.
    return (df.crossJoin(F.broadcast(limits)).filter(col.between(F.col("_low"), F.col("_high")))
            .drop("_low", "_high"))


def keyed_upsert(target: DataFrame, batch: DataFrame, key: str | None = None,
                 order_by: Column | None = None) -> DataFrame:
    """The target with the batch applied: the last row per key wins.

    The batch's last rows come from a partial aggregate, so a key that fills
    the batch costs one row per task; running it twice changes nothing. A null
    key is a key like any other.
    """
    key = key or target.columns[0]
    last = latest(batch, [key], order_by)
    touched = last.select(F.col(quoted(key)).alias("_touched"))
    kept = target.join(touched, target[quoted(key)].eqNullSafe(touched["_touched"]), "left_anti")
    return kept.unionByName(last.select(*target.columns))


def latest(batch: DataFrame, keys: list[str], order_by: Column | None = None) -> DataFrame:
    """The last row per key in the order of ``order_by``; without one, the
    greatest row, which is the same on every run."""
    rest = F.struct(*[F.col(quoted(c)) for c in batch.columns])
    order = F.struct(order_by.alias("o"), rest.alias("r")) if order_by is not None else rest
    newest = batch.groupBy(*keys).agg(F.max_by(rest, order).alias("_row"))
    return newest.select("_row.*")
