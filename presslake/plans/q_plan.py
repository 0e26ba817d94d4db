"""Queries: planning, windows, aggregations, sort/limit (§2.6, §2.7, §2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.functions.urls import host
from presslake.operators import extract as X
from presslake.operators import planning as P
from presslake.operators import quality as Q
from presslake.operators.windows import dense_index
from presslake.plans import sqlfrag as S
from presslake.plans.registry import query
from presslake.sources.tables import table

CHUNK_WORKERS = 7      # chunk_assign: 7 workers
SPLIT_WORKERS = 15     # remainder_split: the 15-worker case of Q13
HOST_SLOTS = 5         # host_waves: connections per host
TITLE_WORKERS = 4      # titles_by_chunk
TITLES_PER_LINE = 100  # bounded ordered concat


@query("chunk_assign", f"""
WITH t AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx, count(*) OVER () AS n FROM events)
SELECT event_id, CAST(idx AS BIGINT) AS idx,
       CAST(floor(idx / greatest(1, n // {CHUNK_WORKERS})) AS BIGINT) AS chunk FROM t
""", op="O-W2 Q12")
def q_chunk_assign(spark, sf):
    ev = table(spark, sf, "events").select("event_id")
    return P.chunk_assign(ev, "event_id", CHUNK_WORKERS).select("event_id", "idx", "chunk")


@query("remainder_split", f"""
WITH t AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx, count(*) OVER () AS n FROM events)
SELECT event_id, CAST(least(idx // greatest(1, n // {SPLIT_WORKERS}), {SPLIT_WORKERS - 1}) AS BIGINT) AS chunk FROM t
""", op="O-W3 Q13")
def q_remainder_split(spark, sf):
    ev = table(spark, sf, "events").select("event_id")
    return P.remainder_split(ev, "event_id", SPLIT_WORKERS).select("event_id", "chunk")


@query("host_waves", f"""
SELECT page_id, {S.host('url')} AS host,
       CAST((row_number() OVER (PARTITION BY {S.host('url')} ORDER BY page_id) - 1) // {HOST_SLOTS} AS BIGINT) AS wave
FROM pages
""", op="O-W6")
def q_host_waves(spark, sf):
    p = table(spark, sf, "pages", spread_rows=False).select("page_id", host("url").alias("host"))
    return P.host_waves(p, "host", "page_id", HOST_SLOTS).select("page_id", "host", "wave")


@query("plateau_stop", """
WITH h AS (SELECT user_id, event_id, CAST(floor(value) AS BIGINT) AS height,
                  row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM events),
l AS (SELECT *, lag(height) OVER (PARTITION BY user_id ORDER BY pos) AS prev FROM h)
SELECT user_id, CAST(min(pos) AS BIGINT) AS stop_pos, arg_min(event_id, pos) AS stop_event_id,
       arg_min(height, pos) AS stop_height
FROM l WHERE height = prev GROUP BY user_id
""", op="O-W5 O-T7 O-W4")
def q_plateau_stop(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", F.floor("value").cast("bigint").alias("height"))
    return P.plateau_stop(ev, "user_id", "event_id", "height")


@query("running_count", """
SELECT event_id, event_type,
       CAST(count(*) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_n
FROM events
""", op="O-A4")
def q_running_count(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type")
    return dense_index(ev, "event_id", ["event_type"]).select(
        "event_id", "event_type", (F.col("idx") + 1).alias("running_n"))


@query("url_total", "SELECT CAST(count(*) AS BIGINT) AS n_urls FROM pages", op="O-A1")
def q_url_total(spark, sf):
    return table(spark, sf, "pages", spread_rows=False).agg(F.count(F.lit(1)).cast("bigint").alias("n_urls"))


@query("distinct_sketch", """
SELECT l_returnflag, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_exact, true AS within_error FROM lineitem GROUP BY l_returnflag
""", op="O-A3: sketches per month, merged per flag, against the exact count")
def q_distinct_sketch(spark, sf):
    from presslake.operators.urls import distinct_sketches, merge_sketches
    li = table(spark, sf, "lineitem").select("l_returnflag", F.date_trunc("month", "l_shipdate").alias("month"), "l_orderkey")
    merged = merge_sketches(distinct_sketches(li, "l_orderkey", ["l_returnflag", "month"]), ["l_returnflag"])
    exact = li.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").cast("bigint").alias("n_exact"))
    near = F.abs(F.col("n_estimate") - F.col("n_exact")) <= 0.05 * F.col("n_exact")      # three standard errors
    return exact.join(merged, "l_returnflag").select("l_returnflag", "n_exact", near.alias("within_error"))


@query("distinct_urls", """
SELECT CAST(count(*) AS BIGINT) AS n_urls, CAST(count(DISTINCT url) AS BIGINT) AS n_distinct,
       CAST(count(DISTINCT source) AS BIGINT) AS n_sources
FROM (SELECT p.url, NULL AS source FROM pages p UNION ALL SELECT NULL, d.source FROM documents d)
""", op="O-A3 O-L1 O-M4")
def q_distinct_urls(spark, sf):
    p = table(spark, sf, "pages", spread_rows=False).select("url", F.lit(None).cast("string").alias("source"))
    d = table(spark, sf, "documents", spread_rows=False).select(F.lit(None).cast("string").alias("url"), "source")
    u = p.unionByName(d)
    return u.agg(F.count(F.lit(1)).cast("bigint").alias("n_urls"),
                 F.count_distinct("url").cast("bigint").alias("n_distinct"),
                 F.count_distinct("source").cast("bigint").alias("n_sources"))


@query("pages_per_host", f"""
SELECT {S.host('url')} AS host, CAST(count(*) AS BIGINT) AS n_pages FROM pages GROUP BY 1
""", op="O-A2")
def q_pages_per_host(spark, sf):
    p = table(spark, sf, "pages", spread_rows=False)
    return p.groupBy(host("url").alias("host")).agg(F.count(F.lit(1)).cast("bigint").alias("n_pages"))


@query("links_per_page", f"""
SELECT page_id, CAST(len(h) AS BIGINT) AS n_links, CAST(len(list_distinct(h)) AS BIGINT) AS n_distinct_links
FROM (SELECT page_id, {S.hrefs(S.clean('html'))} AS h FROM pages)
""", op="O-A2 O-F16")
def q_links_per_page(spark, sf):
    p = table(spark, sf, "pages").select("page_id", H.hrefs(H.clean_html("html")).alias("h"))
    return p.select("page_id", F.size("h").cast("bigint").alias("n_links"),
                    F.size(F.array_distinct("h")).cast("bigint").alias("n_distinct_links"))


@query("pages_per_category", """
SELECT conv_id, CAST(max(turn) + 1 AS BIGINT) AS n_pages, CAST(count(*) AS BIGINT) AS n_rows
FROM conversations GROUP BY conv_id
""", op="O-A5")
def q_pages_per_category(spark, sf):
    c = table(spark, sf, "conversations", spread_rows=False)
    return c.groupBy("conv_id").agg((F.max("turn") + 1).cast("bigint").alias("n_pages"),
                                    F.count(F.lit(1)).cast("bigint").alias("n_rows"))


@query("run_elapsed", """
SELECT user_id, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 2) AS elapsed_s
FROM events GROUP BY user_id
""", op="O-A6 O-F19")
def q_run_elapsed(spark, sf):
    ev = table(spark, sf, "events")
    # difference of wall-clock (NTZ) times: no session time zone involved
    us = F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts"))
    return ev.groupBy("user_id").agg(F.round(us / F.lit(1e6), 2).alias("elapsed_s"))


@query("titles_by_chunk", f"""
WITH t AS (SELECT page_id, {S.first_text(S.clean('html'), 'title')} AS title,
                  row_number() OVER (ORDER BY page_id) - 1 AS idx, count(*) OVER () AS n FROM pages),
c AS (SELECT *, least(idx // greatest(1, n // {TITLE_WORKERS}), {TITLE_WORKERS - 1}) AS chunk FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY idx) - 1 AS pos FROM c)
SELECT CAST(chunk AS BIGINT) AS chunk, CAST(pos // {TITLES_PER_LINE} AS BIGINT) AS line_no,
       string_agg(title, chr(9) ORDER BY pos) AS titles
FROM r GROUP BY chunk, pos // {TITLES_PER_LINE}
""", op="O-K4 O-A7 O-F15")
def q_titles_by_chunk(spark, sf):
    p = table(spark, sf, "pages").select("page_id", H.first_text(H.clean_html("html"), "title").alias("title"))
    pos = P.remainder_split(p, "page_id", TITLE_WORKERS).withColumnRenamed("chunk_pos", "pos")
    # Ordered concat in groups of at most TITLES_PER_LINE rows: no group is
    # unbounded, whatever the chunk size.
    g = pos.groupBy("chunk", F.floor(F.col("pos") / TITLES_PER_LINE).cast("bigint").alias("line_no"))
    return g.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "title"))),
                                          lambda s: s["title"]), "\t").alias("titles"))


@query("field_completeness", f"""
WITH a AS (
  SELECT {S.host('url')} AS site,
         {S.first_text(S.clean('html'), 'title')} AS title,
         {S.first_text(S.inner_first(S.clean('html'), 'article'), 'h1')} AS headline,
         {S.paragraphs(S.inner_first(S.clean('html'), 'article'))}[1] AS first_paragraph
  FROM pages),
l AS (FROM a UNPIVOT INCLUDE NULLS (value FOR field IN (title, headline, first_paragraph)))
SELECT site, field, CAST(count(*) AS BIGINT) AS n_total,
       CAST(count(*) FILTER (WHERE value IS NULL OR {S.strip('value')} = '') AS BIGINT) AS n_missing
FROM l
GROUP BY site, field
""", op="O-A9 Q5")
def q_field_completeness(spark, sf):
    a = X.extract_articles(table(spark, sf, "pages"))
    return Q.field_completeness(a, "site", ["title", "headline", "first_paragraph"])


@query("first_n", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events ORDER BY ts, event_id LIMIT 10
""", op="O-L2")
def q_first_n(spark, sf):
    ev = table(spark, sf, "events")
    return ev.orderBy("ts", "event_id").limit(10).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"))


@query("slice_rows", """
SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 50 OFFSET 100
""", op="O-L3")
def q_slice_rows(spark, sf):
    return table(spark, sf, "events").orderBy("event_id").offset(100).limit(50).select("event_id", "user_id")


@query("preview180", """
SELECT doc_id, substring(to_json({'doc_id': doc_id, 'lang': lang, 'source': source, 'text': text}), 1, 180) AS line
FROM documents
""", op="O-L6")
def q_preview180(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.substring(F.to_json(F.struct("doc_id", "lang", "source", "text")), 1, 180).alias("line"))


@query("progress_buckets", """
SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
       CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1, 2
""", op="O-T4 (batch twin)")
def q_progress_buckets(spark, sf):
    ev = table(spark, sf, "events")
    w = F.window("ts", "1 hour")  # on the NTZ column: independent of the session time zone
    return ev.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
        F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")


@query("sample_rows", """
SELECT doc_id, lang, source FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id LIMIT 20
""", op="O-L5")
def q_sample_rows(spark, sf):
    d = table(spark, sf, "documents", spread_rows=False).select("doc_id", "lang", "source")
    return P.sample_n(d, "doc_id", 20, seed=42)
