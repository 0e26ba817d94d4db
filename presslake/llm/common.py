"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows that :func:`bounded_broadcast` lets a join side have.
BROADCAST_ROWS = 50_000


def importable(spark: SparkSession) -> None:
    """Let Python workers that share this file system import this package (on
    a cluster it is shipped or installed like any other).  Modules are not
    pickled: what workers remember between tasks lives in them."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


_STORE: dict = {}


def worker_store(owner: str) -> dict:
    """What this Python worker remembers for an operator between tasks.  A
    worker remembers for one operator at a time: asking for another's store
    drops what was there, so stages of one job don't add up their memory."""
    if _STORE.get("owner") != owner:
        _STORE.clear()
        _STORE["owner"] = owner
    return _STORE


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors
    share.  Only a local session without that setting (tests) gets a temporary
    folder; a cluster without it is an error."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="presslake-shared-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under :func:`shared_dir` and read it back.

    Cuts lineage durably: a lost executor re-reads files instead of
    recomputing what came before, and iterations keep short plans."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a staged side for broadcast if it has at most ``rows`` rows; beyond
    that the caller's join shuffles (AQE splits skewed partitions)."""
    return F.broadcast(df) if df.count() <= rows else df


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column (nulls: empty), as one array,
    and the offsets of its values (one more than values).  No copy if the
    column has no nulls."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = column.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def blocks(off: np.ndarray, size: int):
    """Cut values with byte offsets ``off`` into runs ``(i, j)`` of whole values
    holding about ``size`` bytes (a longer value is a run of its own)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j
