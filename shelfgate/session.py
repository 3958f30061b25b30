"""Session helpers: a local session for tests and bench, and the shared folder.

Library code never builds its own session; callers pass one in. The shared
folder is the one the cluster names in ``spark.checkpoint.dir``. Only when
that setting is missing *and* Spark runs in local mode (tests, bench) do we
pick a scratch folder under /tmp ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shelfgate") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
               partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings for a cluster run over ``input_bytes`` of listing data.

    Scan splits and shuffle partitions target ``partition_bytes`` each, so a
    task's input fits comfortably in executor memory; AQE coalesces small
    shuffle partitions and splits skewed ones at run time. The explicit
    broadcasts in this package have a fixed or checked size, so the
    automatic threshold stays moderate.
    """
    slots = max(1, executors * cores_per_executor)
    shuffle_parts = max(slots * 2, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes * 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide shared folder (``spark.checkpoint.dir``).

    Read from the session; set our own only when unset and running locally.
    """
    sc = spark.sparkContext
    d = sc.getConf().get(_CKPT_KEY, None)
    if not d:
        try:
            d = spark.conf.get(_CKPT_KEY)
        except Exception:  # noqa: BLE001 - unset conf raises on some versions
            d = None
    if not d:
        opt = sc._jsc.sc().getCheckpointDir()
        d = opt.get() if opt.isDefined() else None
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every "
                "executor can reach (HDFS, S3, ...)"
            )
        d = tempfile.mkdtemp(prefix="shelfgate-shared-", dir="/tmp")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder (never reused, never cleared)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there. Other failures (permissions, an unknown scheme) raise."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def drop_scratch(spark: SparkSession, older_than_hours: float = 24 * 7) -> list[str]:
    """Delete helper tables of finished runs from the shared folder; returns their paths.

    Only what :func:`scratch_path` named and nothing wrote to for ``older_than_hours``: results of
    running jobs may still read younger ones. Never called by the library itself.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    limit = (time.time() - older_than_hours * 3600) * 1000
    gone = []
    for status in fs.listStatus(root):
        path = status.getPath()
        if re.fullmatch(r"[a-z][a-z0-9-]*-[0-9a-f]{12}", path.getName()) and status.getModificationTime() < limit:
            fs.delete(path, True)
            gone.append(path.toString())
    return sorted(gone)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Compute ``df`` once into a parquet table in the shared folder and read it back.

    Used only for small derived tables (per-file facts, repeated keys) that
    feed later joins: the large input is not scanned again for them, the
    lineage is cut (a lost executor does not rerun the upstream
    aggregation), and the read-back relation carries its real size for
    Spark's join planning. A reliable ``checkpoint()`` would compute the
    plan twice (once for the action, once to write the checkpoint); one
    write computes it once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: reading it back needs no footer-inference job
    return spark.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (from file sizes; no job)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no estimate: treat as large
        return 1 << 62


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
