"""Session construction and the lineage-cutting helpers the iterative jobs use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job expects; a cluster session may override the sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state (dedupe keys, join buffers, per-account totals, hold timers) on local
    # disk-backed RocksDB instead of the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Suggested settings for the 100 TB / ~1000-executor deployment (merged into the cluster's
# own session config; the checkpoint folder must be shared storage).
CLUSTER_CONF = {
    # Many initial shuffle partitions, AQE coalesces them to ~256 MB each at runtime.
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Skewed join partitions are split at runtime.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # Broadcast only small sides, by measured size.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Keep shuffle files of lost executors recoverable.
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "tallybook",
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session (``spark.checkpoint.dir``).

    On a cluster it must be set to shared storage; without it only a local session (tests, a
    laptop) gets a scratch folder of its own, any other one is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tallybook-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet under the cluster's shared folder (``spark.checkpoint.dir``)
    and read it back: cuts lineage, computes expensive columns once, and survives the loss of
    any executor because no executor's own disk holds it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tb_path = path
    return out


ROWS_PER_TASK = 1_000_000     # rows that one task sorts or keeps in a hash table
BROADCAST_ROWS = 200_000      # rows of a few narrow columns that every task may hold


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Partitions that give a task at most ``ROWS_PER_TASK`` rows. Sizes in bytes do not: ids compress so well in
    a shuffle that adaptive execution makes one task of tens of millions of them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def unstage(df: DataFrame | None) -> None:
    """Remove a staged table that nothing reads any more (no-op for other frames)."""
    path = getattr(df, "_tb_path", None)
    if path is None:
        return
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
