"""Replay-safe publication: stage under a batch, then commit the batch in a manifest.

A published table is a folder of ``batch=<id>/entry=<name>`` partitions and a
manifest ``_manifest`` beside them (Spark's readers skip names that start
with an underscore). The manifest has one row per entry: its name, bytes,
digest and batch. A batch's rows are written first, replacing what an
earlier try of the same batch left; they count only once the manifest names
the batch, and a manifest append is one small file that Spark's committer
moves into place. So a failure between two steps leaves all of a batch
visible or nothing, and running again with the same entries finds them in
the manifest and writes nothing. An entry that comes again with other
contents (another digest) replaces its earlier rows.

Any number of tables may follow one manifest: rows that did not survive and
the column log are written under the same batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.schema import col
from ..session import path_exists

BATCH, ENTRY = "batch", "entry"
MANIFEST = "entry string, bytes long, digest string, batch string, seq long"


def manifest_path(table: str) -> str:
    return f"{table.rstrip('/')}/_manifest"


def read_manifest(spark: SparkSession, table: str) -> DataFrame:
    """Committed entries ``(entry, bytes, digest, batch, seq)``; none if nothing was published yet."""
    path = manifest_path(table)
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def live_entries(manifest: DataFrame) -> DataFrame:
    """``(entry, batch, digest)``: the last committed version of each entry."""
    last = F.max(F.struct("seq", "batch", "digest")).alias("last")
    return manifest.groupBy("entry").agg(last).select("entry", "last.batch", "last.digest")


def unpublished(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """The rows of ``entries`` (``entry``, ``bytes``, ``digest``) whose contents the table does not hold."""
    live = live_entries(manifest).select(F.col("entry").alias("l_entry"), F.col("digest").alias("l_digest"))
    same = (F.col("entry") == F.col("l_entry")) & F.col("digest").eqNullSafe(F.col("l_digest"))
    return entries.join(live, same, "left_anti")


def batch_id(entries: DataFrame) -> str:
    """The name of a batch of entries: a digest of their names and contents."""
    rows = entries.select(F.sha2(F.to_json(F.struct("entry", "digest")), 256).alias("h")).orderBy("h").collect()
    return "b" + hashlib.sha256("".join(r["h"] for r in rows).encode()).hexdigest()[:24]


def stage(rows: DataFrame, table: str, batch: str, entry_col: str | None = None) -> None:
    """Write the rows of a batch, in place of those of an earlier try. They do not count before :func:`commit`."""
    target = f"{table.rstrip('/')}/{BATCH}={batch}"
    if entry_col is None:
        rows.write.mode("overwrite").parquet(target)
        return
    named = rows.withColumn(ENTRY, col(entry_col).cast("string"))
    if entry_col != ENTRY:
        named = named.drop(entry_col)
    named.write.mode("overwrite").partitionBy(ENTRY).parquet(target)


def commit(spark: SparkSession, table: str, batch: str, entries: DataFrame) -> None:
    """Make a staged batch count. ``entries`` has ``entry``, ``bytes``, ``digest``.

    ``seq`` grows with every commit, so that the last version of an entry is known; committing a
    batch twice changes nothing.
    """
    known = read_manifest(spark, table).agg(F.max("seq").alias("seq"), F.max((F.col("batch") == batch).cast("int"))
                                            .alias("done")).first()
    if known["done"]:
        return
    rows = entries.select("entry", F.col("bytes").cast("long").alias("bytes"), "digest", F.lit(batch).alias("batch"),
                          F.lit((known["seq"] or 0) + 1).cast("long").alias("seq"))
    rows.coalesce(1).write.mode("append").parquet(manifest_path(table))


def read_published(spark: SparkSession, table: str, schema: StructType, *, manifest_of: str | None = None,
                   keep_entry: bool = False) -> DataFrame:
    """The committed rows of a table: those of each entry's last version.

    ``manifest_of`` names the table whose manifest decides, for tables that follow another's.
    ``keep_entry`` adds the column ``entry``. The join with the manifest prunes partitions.
    """
    live = live_entries(read_manifest(spark, manifest_of or table))
    if not path_exists(spark, table):
        extra = [StructField(ENTRY, StringType())] if keep_entry else []
        return spark.createDataFrame([], StructType(schema.fields + extra))
    whole = StructType(schema.fields + [StructField(BATCH, StringType()), StructField(ENTRY, StringType())])
    rows = spark.read.schema(whole).parquet(table)
    live = live.select(F.col("entry").alias("_live_entry"), F.col("batch").alias("_live_batch"))
    rows = rows.join(live, (F.col(BATCH) == F.col("_live_batch")) & (F.col(ENTRY) == F.col("_live_entry")), "left_semi")
    return rows.select(*[col(f.name) for f in schema.fields], *([ENTRY] if keep_entry else []))
