"""A profile over weeks from one mergeable state per week, kept instead of rescanned.

A week's state is a row per column: rows, missing values, smallest, largest
and sum of a number, a HyperLogLog sketch of a text's values and a KLL sketch
of a number's. Columns of few levels also keep their exact value counts. The
state of all weeks merges into the profile of the whole table: counts, bounds
and means are exact, distinct counts are exact where every week kept the
levels; else they and the median are estimates.

Errors of the estimates: a distinct count has a relative standard error of
about 1.04 / sqrt(2^HLL_LOG_K) (1.6 %); a median's rank is off by at most
about 1.33 % (KLL with ``KLL_K`` = 200, 99 of 100 times).

One scan makes a week's state, a second counts the levels of columns whose
sketch says that they have few. A week that is added again replaces its state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from ..functions.predicates import is_missing
from ..functions.schema import col
from ..session import path_exists

HLL_LOG_K = 12
KLL_K = 200
LEVELS = 50
STATE = ("column string, position int, kind string, rows long, n_missing long, low double, high double, total double, "
         "hll binary, kll binary, n_levels long, week string")
COUNTS = "column string, value string, n long, week string"


class WeeklyProfile:
    """States of a table's weeks under ``path``; at most ``levels`` values of a column are kept exactly."""

    def __init__(self, spark: SparkSession, path: str, levels: int = LEVELS):
        self.spark, self.path, self.levels = spark, path.rstrip("/"), levels

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.path}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def weeks(self) -> list[str]:
        """Names of the weeks with a state; one row per week comes to the driver."""
        return [r["week"] for r in self._read("state", STATE).select("week").distinct().orderBy("week").collect()]

    def add(self, df: DataFrame, week: str) -> None:
        """Keep the state of ``week``. It counts, levels and all, once its state is written."""
        fields = df.schema.fields
        aggs = [F.count(F.lit(1)).alias("rows")]
        for i, f in enumerate(fields):
            c = col(f.name)
            aggs.append(F.count_if(is_missing(c, f.dataType)).alias(f"m{i}"))
            if isinstance(f.dataType, NumericType):
                v = F.when(~is_missing(c, f.dataType), c.cast("double"))
                aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.sum(v).alias(f"t{i}"),
                         F.kll_sketch_agg_double(v, KLL_K).alias(f"k{i}")]
            elif isinstance(f.dataType, (StringType, BooleanType)):
                aggs.append(F.hll_sketch_agg(c.cast("string"), HLL_LOG_K).alias(f"h{i}"))
        none, nothing = F.lit(None).cast("double"), F.lit(None).cast("binary")
        entries = []
        for i, f in enumerate(fields):
            number, text = isinstance(f.dataType, NumericType), isinstance(f.dataType, (StringType, BooleanType))
            entries.append(F.struct(
                F.lit(f.name).alias("column"), F.lit(i).alias("position"),
                F.lit("number" if number else "text" if text else "other").alias("kind"), F.col("rows"),
                F.col(f"m{i}").alias("n_missing"),
                *[(F.col(f"{a}{i}") if number else none).alias(n) for a, n in (("lo", "low"), ("hi", "high"), ("t", "total"))],
                (F.col(f"h{i}") if text else nothing).alias("hll"), (F.col(f"k{i}") if number else nothing).alias("kll")))
        state = self.spark.createDataFrame(
            df.agg(*aggs).select(F.inline(F.array(*entries))).collect(), STATE.split(", n_levels")[0])  # a row per column
        few = [r["column"] for r in state.where("kind = 'text'").select("column", F.hll_sketch_estimate("hll").alias("d")).collect()
               if r["d"] <= 1.5 * self.levels]
        counts = self.spark.createDataFrame([], "column string, value string, n long")
        if few:
            pairs = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in few])
            counts = (df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("column", "value")
                      .agg(F.count(F.lit(1)).alias("n")))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/levels/week={week}")
        counts = self._read("levels", COUNTS).where(F.col("week") == week)
        levels = counts.groupBy("column").agg(F.count(F.lit(1)).alias("n_levels"))
        empty = F.when(F.col("kind") == "text", F.when(F.col("column").isin(few), 0)).cast("long") if few else F.lit(None)
        state = (state.join(F.broadcast(levels), "column", "left")
                 .withColumn("n_levels", F.coalesce("n_levels", empty.cast("long"))))
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/state/week={week}")

    def merged(self) -> DataFrame:
        """(column, rows, n_missing, low, high, mean, median, n_distinct, distinct_exact), by the order of the columns.

        ``rows`` are those of the weeks that have the column; ``median`` is an estimate;
        ``n_distinct`` is null for columns that are no text.
        """
        state = self._read("state", STATE)
        few = F.min(F.coalesce(F.col("n_levels") <= self.levels, F.lit(False)))
        by = state.groupBy("column").agg(
            F.min("position").alias("position"), F.sum("rows").alias("rows"), F.sum("n_missing").alias("n_missing"),
            F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"), F.min("kind").alias("kind"),
            F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("estimate"), F.kll_merge_agg_double("kll").alias("kll"),
            few.alias("few"))
        levels = (self._read("levels", COUNTS).join(F.broadcast(state.select("week").distinct()), "week", "left_semi")
                  .select("column", "value").distinct().groupBy("column").agg(F.count(F.lit(1)).alias("exact")))
        text = F.col("kind") == "text"
        present = F.col("rows") - F.col("n_missing")
        return (by.join(F.broadcast(levels), "column", "left").orderBy("position", "column").select(
            "column", "rows", "n_missing", "low", "high",
            F.try_divide("total", present.cast("double")).alias("mean"),
            F.when((F.col("kind") == "number") & (present > 0),
                   F.kll_sketch_get_quantile_double("kll", F.lit(0.5))).alias("median"),
            F.when(text, F.when(F.col("few"), F.coalesce("exact", F.lit(0).cast("long"))).otherwise(F.col("estimate")))
            .alias("n_distinct"),
            F.when(text, F.col("few")).alias("distinct_exact")))

    def value_counts(self) -> DataFrame:
        """(column, value, n) over all weeks, of the columns whose levels every week kept."""
        state = self._read("state", STATE)
        few = (state.where("kind = 'text'").groupBy("column")
               .agg(F.min(F.coalesce(F.col("n_levels") <= self.levels, F.lit(False))).alias("few")).where("few"))
        return (self._read("levels", COUNTS).join(F.broadcast(state.select("week").distinct()), "week", "left_semi")
                .join(F.broadcast(few.select("column")), "column").groupBy("column", "value").agg(F.sum("n").alias("n")))
