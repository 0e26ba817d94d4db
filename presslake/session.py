"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library assumes.  UTC keeps timestamp text identical to the
# oracle; AQE re-plans joins and coalesces small shuffle partitions at run time
# and splits skewed join partitions (hosts and sources are skewed keys).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows of the node shred carry whole pages: keep Arrow batches small, by
    # records and by bytes (whichever is reached first).
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # Streaming state (dedup keys, per-URL status) off-heap in RocksDB, with
    # changelog checkpointing: large state does not pressure the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "presslake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    if master and master.startswith("local"):
        b = b.config("spark.driver.memory", os.environ.get("PRESSLAKE_DRIVER_MEM", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the folder comes from the session's configuration and its
    absence is an error: a machine-local folder would be lost with its machine.
    Only a local session (tests) gets a private scratch folder when unset."""
    sc = spark.sparkContext
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if cur:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(cur)
        return cur
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    cur = tempfile.mkdtemp(prefix="presslake-ckpt-")
    sc.setCheckpointDir(cur)
    return cur


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage of
    an iteration with files that survive a lost executor."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_conf(total_cores: int, input_bytes: int | None = None) -> dict:
    """Starting settings for a cluster run (pass to ``get_spark(extra=...)``).

    Shuffle partitions start at 3× the cores (AQE coalesces small ones to the
    advisory size and splits skewed ones); scan splits stay at 128 MB so a
    split of pages fits an executor task together with its node rows.
    """
    parts = 3 * total_cores
    if input_bytes:
        parts = max(parts, input_bytes // (128 << 20))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    }
