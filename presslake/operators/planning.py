"""Work planning as data (O-W2, O-W3, O-W5, O-W6).

The reference cuts URL lists into per-process chunks and throttles per host;
on Spark the partitioning does the work, so these operators only *report*
the plan as columns — chunk id, host wave, plateau position — computed with
the skew-safe :func:`dense_index` (no global window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.operators.windows import dense_index


def chunk_assign(df: DataFrame, order_col: str, workers: int) -> DataFrame:
    """O-W2 / Q12: ``chunk_size = max(1, n // workers)``; row i → chunk
    ``i // chunk_size`` (so the chunk count may exceed ``workers``, as in the
    reference).  ``workers < 1`` is rejected.  Adds ``idx``, ``chunk`` and
    ``chunk_pos`` (position inside the chunk)."""
    if workers < 1:
        raise ValueError("workers must be >= 1")
    idx = dense_index(df, order_col, total_col="_total")
    size = F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("_total") / F.lit(workers)).cast("bigint"))
    chunk = F.floor(F.col("idx") / size).cast("bigint")
    return (idx.withColumn("chunk", chunk).withColumn("chunk_pos", F.col("idx") - F.col("chunk") * size)
            .drop("_total"))


def remainder_split(df: DataFrame, order_col: str, workers: int) -> DataFrame:
    """O-W3 / Q13: near-equal split, the remainder goes to the last worker:
    chunk = ``min(i // (n // k), k - 1)``; every row is assigned (totals
    conserve, unlike the reference's remainder bug).  Adds ``idx``,
    ``chunk`` and ``chunk_pos``."""
    if workers < 1:
        raise ValueError("workers must be >= 1")
    idx = dense_index(df, order_col, total_col="_total")
    per = F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("_total") / F.lit(workers)).cast("bigint"))
    chunk = F.least(F.floor(F.col("idx") / per).cast("bigint"), F.lit(workers - 1).cast("bigint"))
    return (idx.withColumn("chunk", chunk).withColumn("chunk_pos", F.col("idx") - F.col("chunk") * per)
            .drop("_total"))


def host_waves(df: DataFrame, host_col: str, order_col: str, per_host: int) -> DataFrame:
    """O-W6: at most ``per_host`` rows of one host per wave:
    wave = ``idx_in_host // per_host``.  A dominant host is split by the
    sub-bucketed index, not sorted in one task."""
    out = dense_index(df, order_col, [host_col], out="host_pos")
    return out.withColumn("wave", F.floor(F.col("host_pos") / F.lit(per_host)).cast("bigint"))


def plateau_stop(df: DataFrame, group_col: str, order_col: str, height_col: str) -> DataFrame:
    """O-W5 / O-T7: per group, the first position whose height equals the
    previous height (the scroll loop's stop point).  Groups without a
    plateau produce no row.  The previous height comes with the position,
    so a hot group does not land in one task."""
    idx = dense_index(df, order_col, [group_col], out="pos", lag_cols=[height_col])
    hit = idx.where(F.col(height_col) == F.col("prev_" + height_col))
    return hit.groupBy(group_col).agg(
        F.min_by(F.struct("pos", order_col, height_col), F.col("pos")).alias("_s")).select(
        group_col, F.col("_s.pos").alias("stop_pos"), F.col("_s")[order_col].alias("stop_" + order_col),
        F.col("_s")[height_col].alias("stop_height"))


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """O-L5: n rows picked by a seeded hash of the id — the same rows on every
    run, retry and partitioning (``rand()`` would not be); planned as a
    top-k (each task keeps n candidates), never a full sort."""
    return df.orderBy(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))), F.col(id_col)).limit(n)
