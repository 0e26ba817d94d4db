"""Readers for the landed tables (pages, documents, events, ...).

Every reader is a lazy ``spark.read.parquet``; Catalyst prunes columns and
pushes filters into the scan, so callers select only what they use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# Tables whose rows carry whole pages / documents: per-row work is CPU-heavy.
HEAVY = ("pages", "documents", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool | None = None) -> DataFrame:
    """Lazy scan of one table.  For the text-heavy tables the scan is spread
    over the cluster's cores when the files yield fewer splits than cores
    (see :func:`spread`)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread_rows if spread_rows is not None else name in HEAVY:
        df = spread(df)
    return df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give CPU-heavy per-row work (regex extraction, shredding, tokenising)
    at least one task per core.

    A scan yields one task per file split; a few large row groups leave most
    cores idle.  Only then is the scan round-robin repartitioned to the
    session's parallelism — a one-off shuffle of the input.  A scan that
    already has at least that many splits (any large input) is returned
    unchanged, so at scale this adds no shuffle.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # sessions without RDD access (e.g. Spark Connect): leave the scan as is
        return df
    return df if have >= target else df.repartition(target)


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register every table as a temp view, for ``spark.sql`` users."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-S3: the fetch boundary.  ``pages(page_id, url, html)``; a landing job
    may add ``status``; when absent it is NULL (unknown), never invented."""
    df = table(spark, sf_dir, "pages")
    if "status" not in df.columns:
        from pyspark.sql import functions as F
        df = df.withColumn("status", F.lit(None).cast("int"))
    return df
