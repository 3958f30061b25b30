"""Keys of past weeks, kept bucketed so that a new week meets them without moving them.

The history is a table of ``(kh, k0, k1, ..., n, batch)``: a key's 64-bit hash,
the key itself, its rows in a batch, and the batch. It is bucketed and
sorted by the hash. Looking up a week's keys shuffles that week's keys
alone, to the buckets; the history is read bucket by bucket where it lies.
Hashes only place rows; keys are compared in full, so counts are exact. A
batch that is added again replaces nothing and counts once.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import col
from ..session import path_exists
from .keys import key_hash

BUCKETS = 256


class KeyHistory:
    """History of the key columns ``keys`` (name and type) at ``path``, in ``buckets`` buckets.

    ``path`` must lie where every executor reaches it. Null parts of keys are equal to each other,
    as in the duplicate audit. A batch without rows leaves no trace.
    """

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], buckets: int = BUCKETS):
        if taken := {"n", "n_before"} & set(keys):
            raise ValueError(f"results have columns of their own named {sorted(taken)}")
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), dict(keys), buckets
        self.table = "key_history_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]

    def _attached(self) -> bool:
        """Make the folder a table of this session; False if nothing is there yet."""
        if not path_exists(self.spark, self.path):
            return False
        names = "".join(f"k{i} {t}, " for i, t in enumerate(self.keys.values()))
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (kh bigint, {names}n bigint, batch string) USING parquet "
                       f"CLUSTERED BY (kh) SORTED BY (kh) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        self.spark.catalog.refreshTable(self.table)
        return True

    @property
    def _names(self) -> list[str]:
        return [f"k{i}" for i in range(len(self.keys))]

    def _counted(self, df: DataFrame) -> DataFrame:
        src = df.select(*[col(k).cast(t).alias(n) for n, (k, t) in zip(self._names, self.keys.items())])
        return (src.select(key_hash(src, self._names).alias("kh"), *self._names)
                .groupBy("kh", *self._names).agg(F.count(F.lit(1)).alias("n")))

    def batches(self) -> list[str]:
        """Names of the batches, oldest first; one row per batch comes to the driver."""
        if not self._attached():
            return []
        return [r["batch"] for r in self.spark.table(self.table).select("batch").distinct().orderBy("batch").collect()]

    def add(self, df: DataFrame, batch: str) -> bool:
        """Add the keys of a batch; False if the history has that batch. The write shows whole or not at all."""
        if batch in self.batches():
            return False
        rows = self._counted(df).withColumn("batch", F.lit(batch)).repartition(self.buckets, "kh")
        (rows.write.mode("append").format("parquet").bucketBy(self.buckets, "kh").sortBy("kh")
         .option("path", self.path).saveAsTable(self.table))
        return True

    def lookup(self, df: DataFrame) -> DataFrame:
        """Every key of ``df`` with ``n`` (its rows in ``df``) and ``n_before`` (its rows in the history)."""
        names = self._names
        week = self._counted(df)
        own = [F.col(n).alias(k) for n, k in zip(names, self.keys)]
        if not self._attached():
            return week.select(*own, "n", F.lit(0).cast("long").alias("n_before"))
        past = self.spark.table(self.table).groupBy("kh", *names).agg(F.sum("n").alias("n_before"))
        past = past.select(F.col("kh").alias("p_kh"), F.struct(*names).alias("p_key"), "n_before")
        # the keys are compared where the hashes meet; as join keys they would ask for another partitioning
        differ = F.array_except(F.array(F.struct(*names)), F.array("p_key"))
        # a merge by bucket: neither side is broadcast, the history does not move
        found = week.join(past.hint("merge"), (F.col("kh") == F.col("p_kh")) & (F.size(differ) == 0), "left")
        return found.select(*own, "n", F.coalesce("n_before", F.lit(0).cast("long")).alias("n_before"))

    def summary(self, df: DataFrame) -> DataFrame:
        """One row: ``rows``, ``keys``, ``repeated`` (keys with several rows), ``known`` (keys seen before),
        ``surplus`` (rows beyond the first of their key, counting the history)."""
        known = F.col("n_before") > 0
        return self.lookup(df).agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"), F.count(F.lit(1)).alias("keys"),
            F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(known).alias("known"),
            F.coalesce(F.sum(F.col("n") - F.when(known, 0).otherwise(1)), F.lit(0)).cast("long").alias("surplus"))
