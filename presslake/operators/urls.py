"""URL-table algebra: dedup, lookup, resume (anti), done (semi), insert and
upsert semantics of the URL-status table (§2.2 O-K8/9, §2.5, O-W1, O-T3/5/6).

Every "first"/"latest" is an aggregate (``min_by``/``max_by`` over an
ordering key), which Spark combines map-side: a URL repeated in a third of
all rows collapses to one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions.urls import normalize_url

# ---- fixed values -------------------------------------------------------
# Status domain of the URL table (upper-case codes) and the free-text synonyms
# also found in URL tables ("new" / "error" / "done").
STATUS_NEW, STATUS_ERR, STATUS_OKK = "NEW", "ERR", "OKK"
STATUS_SYNONYMS = {"new": "NEW", "error": "ERR", "done": "OKK"}
MAX_URL_LEN = 2040
# -------------------------------------------------------------------------


def normalize_status(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    m = F.create_map(*[x for kv in STATUS_SYNONYMS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    up = F.upper(c)
    return F.when(up.isin(STATUS_NEW, STATUS_ERR, STATUS_OKK), up).otherwise(F.try_element_at(m, F.lower(c)))


def first_occurrence(df: DataFrame, key: str, order: str, keep=(), count_as: str | None = None) -> DataFrame:
    """O-W1 / O-T3: order-preserving distinct — the row with the smallest
    ``order`` per ``key`` (``min_by`` over a struct, map-side combined)."""
    cols = [order, *keep]
    agg = [F.min_by(F.struct(*cols), F.col(order)).alias("_first")]
    if count_as:
        agg.append(F.count(F.lit(1)).cast("bigint").alias(count_as))
    out = df.groupBy(key).agg(*agg)
    return out.select(key, *[F.col("_first")[c].alias(c) for c in cols], *([count_as] if count_as else []))


def latest(df: DataFrame, key: str, seq: str, keep=()) -> DataFrame:
    """O-K9 / O-T5: last write wins per key (``max_by`` over a struct)."""
    cols = [seq, *keep]
    out = df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(seq)).alias("_last"))
    return out.select(key, *[F.col("_last")[c].alias(c) for c in cols])


def upsert(target: DataFrame, batch: DataFrame, key: str = "url", seq: str = "seq") -> DataFrame:
    """Insert-or-replace ``batch`` into ``target`` (both carry ``seq``; the
    batch's rows must carry larger ``seq`` to win)."""
    cols = [c for c in target.columns if c not in (key, seq)]
    return latest(target.unionByName(batch), key, seq, keep=cols)


def insert_conflicts(target: DataFrame, batch: DataFrame, key: str = "url") -> DataFrame:
    """O-K8: what a plain INSERT would reject — one row
    ``(batch_rows, in_batch_duplicates, existing_keys)``.  Callers raise when
    either count is non-zero (:func:`insert_or_raise`)."""
    per_key = batch.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hits = target.select(key).distinct().withColumn("_hit", F.lit(1))
    return per_key.join(hits, key, "left").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("batch_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("in_batch_duplicates"),
        F.count("_hit").cast("bigint").alias("existing_keys"))


def insert_or_raise(target: DataFrame, batch: DataFrame, key: str = "url") -> DataFrame:
    """Append semantics of a keyed INSERT: fail before writing when the batch
    repeats a key or hits an existing one; otherwise return the union."""
    r = insert_conflicts(target, batch, key).first()
    if (r["in_batch_duplicates"] or 0) > 0 or (r["existing_keys"] or 0) > 0:
        raise ValueError(f"UNIQUE constraint failed on {key}: {r.asDict()}")
    return target.unionByName(batch)


def pending(urls: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    """O-J3: rows of ``urls`` whose key is not in ``done`` (left anti).

    ``done`` is reduced to distinct keys first (a harvest log repeats URLs);
    the distinct is map-side combined and hash-partitioned on the key, so the
    join reuses that partitioning.  A hot key on the ``urls`` side is split
    by AQE's skew-join handling (left anti / semi are supported)."""
    return urls.join(done.select(key).distinct(), key, "left_anti")


def already_done(urls: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    """O-J4: rows of ``urls`` whose key is in ``done`` (left semi)."""
    return urls.join(done.select(key).distinct(), key, "left_semi")


def lookup(urls: DataFrame, pages: DataFrame, key: str = "url") -> DataFrame:
    """O-J1: each URL with its page; a missing page stays visible as NULLs."""
    return urls.join(pages, key, "left")


def with_url_key(df: DataFrame, col: str = "url", out: str = "url_key") -> DataFrame:
    return df.withColumn(out, normalize_url(col))


def url_events(events: DataFrame) -> DataFrame:
    """Stand-in URL-status log from ``events`` (§FIXTURES 5): one URL per user,
    status by event type (error → ERR, purchase → OKK, else NEW), sequence =
    event id."""
    return events.select(
        F.concat(F.lit("https://example.org/u/"), F.col("user_id").cast("string")).alias("url"),
        F.when(F.col("event_type") == "error", STATUS_ERR)
         .when(F.col("event_type") == "purchase", STATUS_OKK)
         .otherwise(STATUS_NEW).alias("status"),
        F.col("event_id").alias("seq"),
        F.col("ts"),
    )


def distinct_sketches(df: DataFrame, key: str, by=(), lg_k: int = 12) -> DataFrame:
    """O-A3 at scale: one mergeable sketch of the distinct ``key`` values per
    group ``by`` (e.g. per day and site), as the binary column ``sketch`` of
    at most 2^lg_k bytes or so.  Sketches can be stored and merged later, when
    the keys themselves are gone.  NULL keys don't count."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(key, lg_k).alias("sketch"))


def merge_sketches(sketches: DataFrame, by=()) -> DataFrame:
    """``sketches`` merged per group ``by``, with ``n_estimate``.  With the
    default lg_k the estimate's standard error is about 1.6 %."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.withColumn("n_estimate", F.hll_sketch_estimate("sketch"))
