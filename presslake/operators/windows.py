"""Skew-safe positional operators.

``row_number()`` over a window with no ``partitionBy`` (or over a hot key)
sorts all of that data in one task.  :func:`dense_index` computes the same
0-based position without that: rows are range-partitioned by (group, order),
so that a hot group spreads over many tasks and an outlier drags nothing with
it; each task sorts its range and numbers its rows; and a small table with one
row per (group, range) says what came before — how many rows, and the last of
them.  The numbered rows are staged in the shared folder, so the ranges that
were counted are the ranges that are numbered, even after a lost executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.session import stage

_ROW_BITS = 33      # monotonically_increasing_id: partition above, row in it below


def in_ranges(df: DataFrame, cols, ranges: int) -> DataFrame:
    """Staged ``df``, range-partitioned and sorted by ``cols`` (NULLs first),
    with ``_part`` (its range) and ``_i`` (the row's place in it)."""
    keys = [F.col(f"`{c}`") for c in cols]
    rows = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    return stage(rows.withColumn("_part", F.shiftright("_id", _ROW_BITS)).withColumn("_i", F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)).drop("_id"), "ranges")


def _same(a: DataFrame, b: DataFrame, keys, other) -> Column:
    """Null-safe equality of ``a``'s keys with ``b``'s columns ``other``."""
    cond = F.lit(True)
    for k, o in zip(keys, other, strict=True):
        cond = cond & a[k].eqNullSafe(b[o])
    return cond


def dense_index(df: DataFrame, order_col: str, group_cols=(), out: str = "idx",
                ranges: int | None = None, total_col: str | None = None, lag_cols=(),
                lag_prefix: str = "prev_") -> DataFrame:
    """Add ``out`` = 0-based position of each row inside its group ordered by
    ``order_col`` (any orderable type, NULLs first; unique inside a group,
    e.g. an id).  A NULL group is a group like any other.

    ``total_col`` also adds the group's row count, ``lag_cols`` the previous
    row's values (``lag``), both from the small table of ranges: no second
    pass over the input and no self-join.  ``ranges``: as many as the session's
    shuffle partitions, if not given; any number gives the same positions."""
    g = [f"_g{k}" for k in range(len(group_cols))]
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = in_ranges(df, [*group_cols, order_col], ranges)
    last = [F.max_by(F.struct(*[F.col(c).alias(c) for c in lag_cols]), F.col("_i")).alias("_last")] if lag_cols else []
    table = rows.groupBy(*[F.col(c).alias(k) for c, k in zip(group_cols, g, strict=True)], F.col("_part").alias("_r")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"), *last)
    before = Window.partitionBy(*g).orderBy("_r")
    upto = before.rowsBetween(Window.unboundedPreceding, -1)
    table = table.withColumn("_off", F.coalesce(F.sum("_n").over(upto), F.lit(0)) - F.col("_first"))
    if lag_cols:
        table = table.withColumn("_last", F.lag("_last").over(before))
    if total_col:
        table = table.withColumn(total_col, F.sum("_n").over(Window.partitionBy(*g)).cast("bigint"))
    table = table.drop("_n", "_first")
    # Without groups the table has at most ``ranges`` rows: a proven bound.
    joined = rows.join(table if g else F.broadcast(table), _same(rows, table, [*group_cols, "_part"], [*g, "_r"]))
    res = joined.withColumn(out, (F.col("_i") + F.col("_off")).cast("bigint"))
    if lag_cols:
        w = Window.partitionBy(*group_cols, "_part").orderBy("_i")
        first = F.row_number().over(w) == 1
        for c in lag_cols:
            res = res.withColumn(lag_prefix + c, F.when(first, F.col("_last")[c]).otherwise(F.lag(c).over(w)))
    return res.drop(*g, "_part", "_i", "_r", "_off", "_last")
