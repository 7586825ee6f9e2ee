"""Session construction and shared-folder helpers.

The library never creates its own session inside a query: every operator
takes the caller's ``SparkSession``.  ``build_session`` is for tests, the
bench and command-line runs.  Scratch output (checkpoints, written tables)
always goes under the folder the cluster names in ``spark.checkpoint.dir``;
only when that is unset (local tests) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


#: Rows that one task of a step with a given number of tasks has to hold, about.
ROWS_PER_TASK = 500_000


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "starling", extra: dict | None = None) -> SparkSession:
    """A local session configured the way the library expects.

    On a cluster, pass the cluster master and leave partition sizing to AQE:
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` decides the post-shuffle
    partition size, ``shuffle_partitions`` is only the upper bound it coalesces from.
    """
    master = master or os.environ.get("STARLING_MASTER", "local[8]")
    b = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("STARLING_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session, set up on first use.

    Order: an already-set checkpoint dir, then ``spark.checkpoint.dir`` from the
    session conf.  Only in local mode (one machine, nothing to share) is a fresh
    temporary folder chosen when neither exists; on a cluster a missing setting is
    an error, as a machine-local folder would not be seen by the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="starling-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, on whatever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release_scratch(spark: SparkSession) -> None:
    """Delete every scratch table written under this session's checkpoint root.

    For use between batches, once their results are written: a frame that still
    reads one of the tables cannot be read any more.
    """
    delete_path(spark, f"{checkpoint_root(spark).rstrip('/')}/tables")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path (not created) under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tables/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tasks_for(rows, per_task: int = ROWS_PER_TASK) -> int:
    """Tasks to deal ``rows`` over, so that what one holds does not grow with them; ``rows`` is a scan (its
    files know their rows).  Never fewer than the session's partitions."""
    return max(shuffle_partitions(rows.sparkSession), -(-rows.count() // per_task))


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint root and read it back.

    For a frame consumed more than once (e.g. deduplicated lines feeding both the
    per-order totals and the lines they are joined back to): the consumers read a
    compact columnar copy instead of each recomputing the scan and the shuffle
    below it, and the lineage is cut, so a lost executor re-reads files rather
    than recomputing stages.  Runs one job now.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
