"""Session helpers: a local session for tests/bench and the shared work folder.

On a cluster the session comes from the launcher; library code only reads
its settings.  ``work_dir`` resolves the shared folder named by
``spark.checkpoint.dir``; only a session with a local master may leave it
unset (tests), and then gets a fresh local folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "condmon", extra_conf: dict | None = None
) -> SparkSession:
    """Local session used by tests and bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", os.environ.get("CONDMON_SESSION_TZ", "UTC"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("CONDMON_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
        # state of the unbounded per-snapshot aggregation lives on local disk,
        # not on the JVM heap; commits write a changelog, not a full snapshot
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    # tests only: a fresh local checkpoint folder (clusters name a shared one)
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="condmon-ckpt-"))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  When
    neither is set, a session with a local master gets a fresh local folder,
    registered so that later calls reuse it; on a cluster, where a local path
    differs per machine, it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote client: the server owns the checkpoint dir
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="condmon-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
    elif sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared checkpoint folder."""
    return f"{_checkpoint_root(spark)}/condmon/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable; returns the folder."""
    return _checkpoint_root(spark)


def materialize(df, eager: bool = True):
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used for small derived tables that feed more than one branch of a plan
    (so the input is not re-read per branch) and survive executor loss.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stage(df, name: str):
    """Write ``df`` once to the shared folder as Parquet and read it back: for
    large intermediate rows that several passes must see alike."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Settings for a large cluster (pass with ``--conf`` to spark-submit).  The
# library reads, and never sets, the session's configuration.
CLUSTER_CONF = {
    # re-plan at run time: coalesce small shuffle partitions, split skewed
    # ones in joins, turn a small measured side into a broadcast
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # the sample shuffles are pre-aggregated; start wide and let AQE coalesce
    "spark.sql.shuffle.partitions": "8000",
    # parquet splits of ~256 MB keep one scan task's working set small
    "spark.sql.files.maxPartitionBytes": "256m",
    # explicit broadcasts are size-checked; keep the automatic bound modest
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # per-snapshot stream state lives on local disk, commits write changelogs
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # checkpoints and intermediate tables: a shared, durable folder
    "spark.checkpoint.dir": "<shared durable folder, e.g. an object-store prefix>",
}
