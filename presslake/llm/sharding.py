"""Operator 10, sharding: weighted rendezvous hashing of stable record keys.

Every record gets, for each shard, a pseudo-random number ``u`` in (0, 1) that
depends on its key and the shard's number only, and goes to the shard with the
largest ``-weight / ln(u)``.  Shard ``i`` so holds a share of
``weight[i] / sum(weight)`` of the keys, and a further shard changes nothing
but the records that it wins itself.

Everything is a Spark expression: one projection assigns shards, without a
shuffle.  :func:`number_slots` numbers the rows of each shard from 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.llm.common import stage

#: Hash buckets of a shard that are numbered apart from each other.
SLOT_BUCKETS = 1024


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 to ``len(weights) - 1``) of a key of any type.

    A null key is a key like any other.  Weights must be positive; ties of the
    score (practically none) go to the smaller shard number.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive numbers")
    scores = []
    for i, w in enumerate(weights):
        h = F.xxhash64(F.lit(f"shard {i}"), key)
        u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        scores.append(F.lit(-float(w)) / F.log(u))
    # Plain doubles: a struct per row and shard was most of what a task allocated.
    top = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (F.array_position(F.array(*scores), top) - 1).cast("int")


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], out: str = "shard") -> DataFrame:
    """``df`` with the column ``out``: each row's shard by its ``key`` column.

    All other columns stay; equal keys share a shard; an empty table stays
    empty.  An existing column named ``out`` is an error, not overwritten."""
    if out in df.columns:
        raise ValueError(f"the table has a column {out!r} already")
    return df.withColumn(out, rendezvous(F.col(f"`{key}`"), weights))


def number_slots(rows: DataFrame, shard: str, content: Sequence[str], out: str = "slot",
                 buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Number the rows of each shard from 0, without gaps, as column ``out``.

    Rows are dealt into ``buckets`` hash buckets per shard by the ``content``
    columns; each bucket is sorted and numbered in a task of its own and
    starts where the bucket before it ends (the bucket sizes, at most
    shards x buckets numbers, are the only thing that is joined).  ``rows`` is
    staged first, so that sizes and numbers see the same rows.  Rows equal in
    all ``content`` columns get neighbouring numbers in any order.
    """
    names = [shard, *content]
    rows = stage(rows.withColumn("_slots_b", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in content]), F.lit(buckets))), "slots")
    sizes = rows.groupBy(F.col(f"`{shard}`").alias("_slots_s"), F.col("_slots_b").alias("_slots_c")).agg(F.count("*").alias("_slots_n"))
    before = Window.partitionBy("_slots_s").orderBy("_slots_c").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slots_s", "_slots_c", F.coalesce(F.sum("_slots_n").over(before), F.lit(0)).alias("_slots_start"))
    inside = Window.partitionBy(shard, "_slots_b").orderBy(*[F.col(f"`{c}`") for c in names[1:]])
    # At most shards x buckets rows of three numbers: a proven bound.
    return (rows.withColumn("_slots_i", F.row_number().over(inside) - 1)
            .join(F.broadcast(starts), (F.col(f"`{shard}`") == F.col("_slots_s")) & (F.col("_slots_b") == F.col("_slots_c")))
            .withColumn(out, (F.col("_slots_i") + F.col("_slots_start")).cast("long"))
            .drop("_slots_b", "_slots_i", "_slots_s", "_slots_c", "_slots_start"))


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Shard documents ``(doc_id, text)`` by doc_id over equal shards.

    Returns doc_id, size (UTF-8 bytes + 1; null text: 1), text_crc32 (null:
    as empty), law ``key``, shard, slot and grown_shard (with one shard more).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"), rendezvous(F.col("doc_id"), [1.0] * shards).alias("shard"),
        rendezvous(F.col("doc_id"), [1.0] * (shards + 1)).alias("grown_shard"))
    out = number_slots(rows, "shard", ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
