"""Drift of live batches against what is kept of all earlier ones.

Nothing of the history is read again. Of each column's type shares the state
keeps number, mean and sum of squared deviations, which merge; of each value its
count, so that a batch changes the sum of n * log2 n only at the values that it
holds; of each column the last batch's entropy. The counts of values lie in a
``KeyedTable``, of which an update rewrites only the files it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cellmend.functions.normalize import quoted
from cellmend.operators.cells import KEY_FIELDS, value_counts, with_cell_type
from cellmend.operators.metrics import entropy_bits, entropy_delta, n_log_n
from cellmend.operators.sizing import broadcast_if_small, settled
from cellmend.sources.keyed_table import KeyedTable

_TYPES = ("null", "int", "float", "string")
_MOMENTS = "col_idx int, cell_type string, batches long, mean double, squares double"
_STEPS = "col_idx int, last double, total long, spread double, distinct_values long"


class DriftState:
    """The state of some columns of a stream of batches, kept below ``path``.

    ``version=<n>`` folders hold the small tables and name the version of the
    value counts they belong to. They are written last: a run that fails before
    leaves the state as it was, and can be repeated.
    """

    def __init__(self, spark: SparkSession, path: str, columns: list[str]):
        self.spark, self.path, self.columns = spark, path.rstrip("/"), columns
        self.values = KeyedTable(spark, f"{self.path}/values", ["value_id"])
        self.steps_log = KeyedTable(spark, f"{self.path}/steps", ["col_idx"])
        self.moments_log = KeyedTable(spark, f"{self.path}/moments", ["id"])
        self.heads = KeyedTable(spark, f"{self.path}/heads", ["head"])

    def _head(self) -> dict:
        """The versions that belong together; -1 where there is none."""
        if self.heads.version() < 0:
            return {"moments": -1, "steps": -1, "counts": -1}
        return self.heads.read().first().asDict()

    def _kept(self, table: KeyedTable, version: int, schema: str) -> DataFrame:
        if version < 0:
            return self.spark.createDataFrame([], schema)
        names = [field.split()[0] for field in schema.split(", ")]
        return table.read(version).select(*names)

    def _name(self) -> Column:
        return F.element_at(F.array(*[F.lit(c) for c in self.columns]), F.col("col_idx") + 1)

    def _shares(self, counts: DataFrame, batch: str) -> DataFrame:
        per_batch = counts.groupBy(batch, "col_idx").agg(
            F.sum("n").alias("n"),
            *[F.sum(F.when(F.col("cell_type") == t, F.col("n")).otherwise(0)).alias(t) for t in _TYPES])
        return per_batch.select(batch, "col_idx", F.inline(F.array(*[
            F.struct(F.lit(t).alias("cell_type"), (F.col(t) / F.col("n")).alias("share")) for t in _TYPES])))

    @staticmethod
    def _merged(n: Column, mean: Column, squares: Column) -> dict[str, Column]:
        """Moments of the kept shares and n more with this mean and these squares."""
        n, old = F.coalesce(n, F.lit(0)), F.coalesce("batches", F.lit(0).cast("bigint"))
        mean, before = F.coalesce(mean, F.lit(0.0)), F.coalesce("mean", F.lit(0.0))
        both = old + n
        apart = mean - before
        return {"batches": both, "mean": before + F.coalesce(F.try_divide(apart * n, both), F.lit(0.0)),
                "squares": F.coalesce(squares, F.lit(0.0)) + F.coalesce("squares", F.lit(0.0))
                + F.coalesce(F.try_divide(apart * apart * old * n, both), F.lit(0.0))}

    def update(self, df: DataFrame, batch: str) -> tuple[DataFrame, DataFrame]:
        """Take in new batches, told apart and ordered by the column ``batch``.

        Returns the type drift of each (batch, column, type), as
        ``type_ratio_drift`` has it, and the entropy drift of each (batch,
        column), in percent of the largest entropy that the values seen up to
        that batch allow.
        """
        head = self._head()
        counts = settled(with_cell_type(value_counts(df, [batch], self.columns)))
        drift = self._type_drift(counts, batch, head)
        entropy, touched, steps = self._entropy(counts, batch, head)
        shares = self._shares(counts, batch).groupBy("col_idx", "cell_type").agg(
            F.count(F.lit(1)).alias("n1"), F.avg("share").alias("m1"),
            (F.var_pop("share") * F.count(F.lit(1))).alias("s1"))
        kept = self._kept(self.moments_log, head["moments"], _MOMENTS)
        merged = shares.join(kept, ["col_idx", "cell_type"], "full").select(
            F.concat_ws("/", "col_idx", "cell_type").alias("id"), "col_idx", "cell_type",
            *[c.alias(n) for n, c in self._merged(F.col("n1"), F.col("m1"), F.col("s1")).items()])
        versions = {"moments": self.moments_log.upsert(merged, base=head["moments"]),
                    "steps": self.steps_log.upsert(steps, base=head["steps"]),
                    "counts": self.values.upsert(touched, base=head["counts"])}
        self.heads.upsert(self.spark.createDataFrame([(0, *versions.values())], "head int, moments int, steps int, counts int"))
        return drift, entropy

    def _type_drift(self, counts: DataFrame, batch: str, head: dict) -> DataFrame:
        shares = self._shares(counts, batch)
        kept = self._kept(self.moments_log, head["moments"], _MOMENTS)
        earlier = Window.partitionBy("col_idx", "cell_type").orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
        known = shares.withColumns({
            "n1": F.count("share").over(earlier), "m1": F.avg("share").over(earlier),
            "s1": F.var_pop("share").over(earlier) * F.count("share").over(earlier),
        }).join(broadcast_if_small(kept), ["col_idx", "cell_type"], "left")
        moments = self._merged(F.col("n1"), F.col("m1"), F.col("s1"))
        sd = F.when(moments["batches"] > 1, F.sqrt(moments["squares"] / (moments["batches"] - 1)))
        scored = settled(known.withColumn("z", F.when(sd > 1e-9, (F.col("share") - moments["mean"]) / sd)))
        largest = F.max(F.abs("z")).over(Window.partitionBy(batch))
        return scored.select(
            F.col(quoted(batch)), self._name().alias("column_name"), "cell_type",
            F.round("share", 6).alias("share"), F.round("z", 4).alias("z"),
            F.coalesce(F.abs("z") > 2, F.lit(False)).alias("drifted"),
            F.round(F.try_divide(F.abs("z"), largest) * 100, 3).alias("deviation_pct"))

    def _entropy(self, counts: DataFrame, batch: str, head: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
        filled = counts.filter("cell_type <> 'null'")
        kept = broadcast_if_small(self._kept(self.steps_log, head["steps"], _STEPS))
        value_id = F.substring(F.sha2(F.to_json(F.struct("col_idx", *KEY_FIELDS)), 256), 1, 32)
        # Each value of the new batches once, with its first batch and its count before.
        new = filled.withColumn("value_id", value_id).groupBy("col_idx", "value_id").agg(
            F.sum("n").alias("more"), F.min(batch).alias("first"))
        before = self._kept(self.values, head["counts"], "value_id string, n long").withColumnRenamed("n", "old")
        touched = settled(new.join(before, "value_id", "left").withColumn("n", F.coalesce("old", F.lit(0)) + F.col("more")))
        old = F.when(F.col("old") > 0, n_log_n(F.col("old"))).otherwise(0.0)
        changed = touched.groupBy("col_idx").agg(
            F.sum("more").alias("more"), F.sum(n_log_n(F.col("n")) - old).alias("grown"),
            F.count_if(F.col("old").isNull()).alias("added"))
        firsts = touched.filter("old IS NULL").groupBy("col_idx", F.col("first").alias(batch)).agg(
            F.count(F.lit(1)).alias("fresh"))
        per_batch = filled.groupBy("col_idx", batch).agg(F.sum("n").alias("n"), F.sum(n_log_n(F.col("n"))).alias("s"))
        order = Window.partitionBy("col_idx").orderBy(batch)
        known = F.coalesce("distinct_values", F.lit(0)) + F.sum(F.coalesce("fresh", F.lit(0))).over(order)
        top = F.when(known > 1, F.log2(known)).otherwise(1.0)
        steps = settled(per_batch.join(firsts, ["col_idx", batch], "left").join(kept, "col_idx", "left").withColumn(
            "h", entropy_bits(F.col("n"), F.col("s"))).withColumns(
            {"previous": F.coalesce(F.lag("h").over(order), F.col("last")), "top": top}))
        entropy = steps.select(
            F.col(quoted(batch)), self._name().alias("column_name"), F.round("h", 6).alias("entropy_bits"),
            F.round(F.abs(F.col("h") - F.col("previous")) / F.col("top") * 100, 4).alias("entropy_drift_pct"))
        newest = steps.groupBy("col_idx").agg(F.max_by("h", batch).alias("h"))
        plus = lambda name, more: (F.coalesce(name, F.lit(0)) + F.coalesce(more, F.lit(0))).alias(name)
        state = changed.join(newest, "col_idx").join(kept, "col_idx", "left").select(
            "col_idx", F.col("h").alias("last"), plus("total", "more"), plus("spread", "grown"),
            plus("distinct_values", "added"))
        return entropy, touched.select("value_id", "n"), state

    def entropy_delta(self) -> DataFrame:
        """Entropy and its distance from a uniform distribution of each column
        over all batches so far, from the state alone."""
        kept = self._kept(self.steps_log, self._head()["steps"], _STEPS)
        return kept.select(
            self._name().alias("column_name"), F.col("total").alias("filled"), "distinct_values",
            F.round(F.abs(entropy_bits(F.col("total"), F.col("spread"))), 3).alias("entropy_bits"),
            F.round(entropy_delta(F.col("total"), F.col("spread"), F.col("distinct_values")), 3).alias("entropy_delta_pct"))
