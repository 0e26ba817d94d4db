"""Pagination, editions and listing-page plans (O-S4..S6, O-X22, O-X24..26, O-T1).

Page fan-out is ``explode(sequence(...))`` — a narrow, per-row expansion —
and a traversal of unknown depth doubles its reach with each round of joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.text import col_, py_strip
from presslake.session import stage

# ---- fixed values -------------------------------------------------------
# Romanian month names, month number "01".."12" → name (edition calendar).
MONTH_NAMES = {
    "01": "ianuarie", "02": "februarie", "03": "martie", "04": "aprilie",
    "05": "mai", "06": "iunie", "07": "iulie", "08": "august",
    "09": "septembrie", "10": "octombrie", "11": "noiembrie", "12": "decembrie",
}
# Word positions in a listing counter such as
# "Afisare stiri de la 811 la 825 din 840": current = word 6, total = word 8.
COUNTER_CURRENT_WORD, COUNTER_TOTAL_WORD = 6, 8
# -------------------------------------------------------------------------


def month_map() -> Column:
    return F.create_map(*[F.lit(x) for kv in MONTH_NAMES.items() for x in kv])


def month_name(mm) -> Column:
    """O-F13 / O-J7: month number text → name via a map literal (no join)."""
    return F.try_element_at(month_map(), col_(mm))


def page_url(base, page_no, pattern: str = "{base}/page/{n}") -> Column:
    """O-S4 / O-F10: page 1 is the base URL itself, page n uses ``pattern``."""
    b, n = col_(base), col_(page_no)
    head, tail = pattern.split("{n}")
    head = head.replace("{base}", "")
    return F.when(n == 1, b).otherwise(F.concat(b, F.lit(head), n.cast("string"), F.lit(tail)))


def expand_pages(df: DataFrame, n_col: str, first: int = 2, skip_last: bool = False) -> DataFrame:
    """O-S5: one row per page ``first..n`` of each parent (Q3: ``skip_last``
    reproduces ``range(2, n)``).  ``sequence`` is guarded: a descending
    sequence is not empty."""
    n = F.col(n_col) - (1 if skip_last else 0)
    seq = F.when(n >= first, F.sequence(F.lit(first).cast("bigint"), n.cast("bigint")))
    return df.withColumn("page_no", F.explode(seq))


def page_count(label, strict: bool = False) -> Column:
    """O-X24 / Q2: last word of ``Page x of y`` → int; lenient gives 0 on a
    bad label, strict raises (ANSI cast)."""
    w = F.element_at(F.split(F.coalesce(col_(label), F.lit("")), " "), -1)
    return w.cast("int") if strict else F.coalesce(w.try_cast("int"), F.lit(0))


def has_next_page(counter_text) -> Column:
    """O-X25 / O-P10 / Q17: ``current < total`` from the listing counter;
    any parse failure means "last page" (``get`` is NULL-safe, ``try_cast``)."""
    words = F.split(col_(counter_text), " ")
    cur = F.get(words, COUNTER_CURRENT_WORD).try_cast("int")
    tot = F.get(words, COUNTER_TOTAL_WORD).try_cast("int")
    return F.coalesce(cur < tot, F.lit(False))


def valid_year_label(label, years) -> Column:
    """O-X22 / O-P4: an edition link is kept when the label's last word is a
    valid year."""
    return F.element_at(F.split(py_strip(col_(label)), " "), -1).isin([str(y) for y in years])


def romanian_date(text) -> Column:
    """O-X26: ``'3 octombrie 1998'`` → DATE (NULL when unparsable)."""
    inv = F.create_map(*[F.lit(x) for mm, name in MONTH_NAMES.items() for x in (name, mm)])
    parts = F.split(py_strip(col_(text)), " ")
    d = F.lpad(F.get(parts, 0), 2, "0")
    m = F.try_element_at(inv, F.lower(F.get(parts, 1)))
    y = F.get(parts, 2)
    return F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-MM-dd")


def follow_next(edges: DataFrame, start: DataFrame) -> DataFrame:
    """O-T1: follow ``next`` links from each start until there is none.

    ``edges(src_key, src, dst)`` (one next page at most per page) and
    ``start(src_key, src)`` give ``(src_key, node, depth)`` for every page of
    every walk, however long.  Pointer doubling: round k extends each walk by
    the jumps of 2^k links and joins the jumps with themselves, so a walk of n
    pages takes about log2(n) rounds of joins keyed by page, and ends when no
    walk grows.  A walk that comes to a page for the second time is a cycle, an
    error: it is found in the round that closes it, when the walk is less than
    twice as long as the pages it reached.  Cycles that no start leads to don't
    matter.
    """
    jumps = stage(edges.select("src_key", "src", "dst"), "jumps")
    walk = stage(start.select("src_key", F.col("src").alias("start"), F.col("src").alias("node"), F.lit(0).cast("bigint").alias("depth")).distinct(), "walk")
    step = 1
    while True:
        hop = jumps.select(F.col("src_key").alias("_k"), F.col("src").alias("_s"), F.col("dst").alias("_d"))
        more = stage(walk.join(hop, F.col("src_key").eqNullSafe(F.col("_k")) & (F.col("node") == F.col("_s"))).select(
            "src_key", "start", F.col("_d").alias("node"), (F.col("depth") + step).alias("depth")), "walk")
        if more.isEmpty():
            return walk.select("src_key", "node", "depth")
        walk = walk.unionByName(more)      # staged parts: nothing is written twice
        again = walk.groupBy("src_key", "start", "node").count().where("count > 1").limit(3).collect()
        if again:
            raise ValueError(f"the next links of some pages form a cycle: {[(r['src_key'], r['node']) for r in again]}")
        jumps = stage(jumps.join(hop, F.col("src_key").eqNullSafe(F.col("_k")) & (F.col("dst") == F.col("_s"))).select(
            "src_key", "src", F.col("_d").alias("dst")), "jumps")
        step *= 2
