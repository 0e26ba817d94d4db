"""Sinks (O-K1..O-K5, O-K9 persisted, O-K10).

Every writer is a distributed ``DataFrameWriter`` call: no collect, no
``coalesce(1)``.  A re-run replaces its output (``mode("overwrite")``), which
is what makes a retried job idempotent.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.operators.urls import MAX_URL_LEN, latest
from presslake.session import stage


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """O-K1: one JSON object per line; NULL fields are omitted (absent keys)."""
    df.write.mode(mode).option("ignoreNullFields", True).json(path)


def write_partitioned(df: DataFrame, path: str, keys, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """O-K2: one folder per key value (edition, year/month, run time) — later
    reads prune partitions by those keys.

    ``rebalance`` (not ``repartition``) clusters rows by key so each key
    gets few files, and lets AQE split a hot key's partition (one edition
    may hold a third of all rows) into advisory-size pieces for parallel
    writers while coalescing the small ones."""
    w = df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys)
    getattr(w, fmt)(path)


def write_url_list(df: DataFrame, path: str, col: str = "url", mode: str = "overwrite") -> None:
    """O-K3: newline-delimited URL text; NULL and blank URLs are not written
    (Q4, Q15)."""
    u = df.select(F.col(col).alias("value")).where(F.col("value").isNotNull() & (F.col("value") != ""))
    u.write.mode(mode).text(path)


def write_named_text(df: DataFrame, path: str, key: str, value: str, mode: str = "overwrite") -> None:
    """O-K5 / O-K4: one text folder per key (per worker / genre), values as lines."""
    df.select(key, F.col(value).alias("value")).write.mode(mode).partitionBy(key).text(path)


def ensure_table(spark: SparkSession, name: str, path: str, ddl: str = "url STRING, status STRING, seq BIGINT") -> None:
    """O-K10: create the URL table if absent (key uniqueness is a check done
    by :func:`presslake.operators.urls.insert_or_raise`, not a constraint)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet LOCATION '{path}'")


def check_url_lengths(df: DataFrame, col: str = "url") -> DataFrame:
    """The key column is ≤ 2040 characters; longer keys fail the job."""
    bad = F.length(col) > MAX_URL_LEN
    return df.where(F.when(bad, F.raise_error(F.lit(f"url longer than {MAX_URL_LEN}"))).isNull())


def _current_version(spark: SparkSession, path: str) -> int | None:
    """Highest committed version of the table at ``path`` (a partition value,
    so any storage Spark can list works — no local-filesystem calls)."""
    try:
        versions = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no table yet; any other error is one
            return None
        raise
    return versions.agg(F.max("v")).first()[0]


def read_versioned(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a keyed table: of a versioned one its current version
    (partition pruning on ``v``), of a bucketed one all its buckets."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no table yet; any other error is one
            return None
        raise
    if "key_bucket" in df.columns:
        return df.drop("key_bucket")
    return df.where(F.col("v") == df.agg(F.max("v")).first()[0]).drop("v")


def upsert_buckets(spark: SparkSession, path: str, batch: DataFrame, key: str = "url", seq: str = "seq", buckets: int = 64) -> list[str]:
    """O-K9 persisted: insert-or-replace ``batch`` into the table at ``path``,
    which holds its rows in ``buckets`` folders by a hash of the key.

    Only the buckets that the batch touches are read, merged (largest ``seq``
    per key wins) and written, with dynamic partition overwrite: a batch of k
    keys costs at most k buckets, not the table.  A job that fails before its
    commit leaves the table as it was; a batch that is run again gives the same
    table.  The commit replaces one bucket folder after another, so writers
    must not run at the same time, and readers may see some buckets of a batch
    before others.  Returns the buckets written.

    ``buckets`` is a property of the table and part of its folders' names: a
    call with another number is an error."""
    bucket = F.concat(F.lit("b"), F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("string"), F.lit(f"of{buckets}"))
    keep = [c for c in batch.columns if c not in (key, seq)]
    new = stage(latest(batch, key, seq, keep=keep).withColumn("key_bucket", bucket), "upsert")
    touched = sorted(r["key_bucket"] for r in new.select("key_bucket").distinct().collect())     # at most ``buckets``
    if not touched:
        return []
    if read_versioned(spark, path) is not None:
        table = spark.read.parquet(path)
        if not all(f"of{buckets}/" in f for f in table.inputFiles()):
            raise ValueError(f"the table at {path} has another number of buckets than {buckets}")
        merged = table.where(F.col("key_bucket").isin(touched)).select(*new.columns).unionByName(new)
        new = latest(merged, key, seq, keep=[*keep, "key_bucket"])
    out = new.select(key, seq, *keep, "key_bucket").repartition(F.col("key_bucket"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("key_bucket").parquet(path)
    return touched


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, key: str = "url", seq: str = "seq") -> int:
    """O-K9 persisted: insert-or-replace ``batch`` into the table at ``path``.

    Each upsert appends a new version (partition ``v=<n>``) through Spark's
    commit protocol; readers take the highest version, so a failed or
    retried run never exposes a half-written table, and the previous
    version stays readable.  (A table format with MERGE would update in
    place; none is available here, so this is the portable form.)
    Returns the new version number.
    """
    prev = _current_version(spark, path)
    cur = None if prev is None else spark.read.parquet(path).where(F.col("v") == prev).drop("v")
    merged = batch if cur is None else cur.unionByName(batch)
    keep = [c for c in batch.columns if c not in (key, seq)]
    out = latest(merged, key, seq, keep=keep)
    v = (prev or 0) + 1
    out.withColumn("v", F.lit(v)).write.mode("append").partitionBy("v").parquet(path)
    return v
