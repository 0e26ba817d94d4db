"""Queries: URL-status table, joins, set operators, filters (§2.2, §2.4, §2.5, §2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.functions.urls import host
from presslake.operators import extract as X
from presslake.operators import quality as Q
from presslake.operators import urls as U
from presslake.plans import sqlfrag as S
from presslake.plans.registry import query
from presslake.session import stage
from presslake.sources.tables import table

UE = """ue AS (
  SELECT 'https://example.org/u/' || CAST(user_id AS VARCHAR) AS url,
         CASE event_type WHEN 'error' THEN 'ERR' WHEN 'purchase' THEN 'OKK' ELSE 'NEW' END AS status,
         event_id AS seq, ts
  FROM events)"""
LATEST = f"""{UE},
latest AS (SELECT url, seq, status FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq DESC) AS rn FROM ue) WHERE rn = 1)"""


def _ue(spark, sf):
    return U.url_events(table(spark, sf, "events"))


def _latest(spark, sf):
    return U.latest(_ue(spark, sf), "url", "seq", keep=["status"])


@query("url_status_scan", f"WITH {UE} SELECT url, status, seq FROM ue", op="O-S7")
def q_url_status_scan(spark, sf):
    return _ue(spark, sf).select("url", "status", "seq")


@query("upsert_latest", f"WITH {LATEST} SELECT url, seq, status FROM latest", op="O-K9 O-T5")
def q_upsert_latest(spark, sf):
    return _latest(spark, sf)


@query("urls_by_status", f"WITH {LATEST} SELECT url, status FROM latest WHERE status = 'OKK'",
       op="O-P3 O-Y4 O-S11")
def q_urls_by_status(spark, sf):
    # Named SQL with a bound parameter, as the named-statement API does.
    return spark.sql("SELECT url, status FROM {t} WHERE status = :status",
                     args={"status": "OKK"}, t=_latest(spark, sf))


@query("retry_list", f"WITH {LATEST} SELECT url FROM latest WHERE status = 'ERR'", op="O-T6")
def q_retry_list(spark, sf):
    return _latest(spark, sf).where(F.col("status") == U.STATUS_ERR).select("url")


@query("insert_conflicts", f"""
WITH {UE},
t AS (SELECT DISTINCT url FROM ue WHERE status = 'OKK'),
b AS (SELECT url, count(*) AS n FROM ue WHERE status = 'ERR' GROUP BY url)
SELECT CAST(coalesce(sum(b.n), 0) AS BIGINT) AS batch_rows,
       CAST(coalesce(sum(b.n - 1), 0) AS BIGINT) AS in_batch_duplicates,
       CAST(count(t.url) AS BIGINT) AS existing_keys
FROM b LEFT JOIN t ON b.url = t.url
""", op="O-K8")
def q_insert_conflicts(spark, sf):
    ue = _ue(spark, sf)
    return U.insert_conflicts(ue.where(F.col("status") == U.STATUS_OKK),
                              ue.where(F.col("status") == U.STATUS_ERR), "url")


@query("dedup_by_key", f"""
WITH {UE}
SELECT url, seq, status FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS rn FROM ue) WHERE rn = 1
""", op="O-T3 O-W1")
def q_dedup_by_key(spark, sf):
    return U.first_occurrence(_ue(spark, sf), "url", "seq", keep=["status"])


@query("split_ok_error", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
       CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS outcome
FROM events
""", op="O-P1 O-T8")
def q_split_ok_error(spark, sf):
    ev = table(spark, sf, "events")
    st = F.when(F.col("event_type") == "error", 500).otherwise(200)
    return ev.select("event_id", st.alias("status"), Q.outcome(st).alias("outcome"))


@query("url_lookup", """
SELECT d.doc_id, l.quality, l.toxic, l.doc_id IS NOT NULL AS matched
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""", op="O-J1")
def q_url_lookup(spark, sf):
    d = table(spark, sf, "documents", spread_rows=False).select("doc_id")
    lab = table(spark, sf, "labels").select("doc_id", "quality", "toxic", F.lit(True).alias("matched"))
    return U.lookup(d, lab, "doc_id").select(
        "doc_id", "quality", "toxic", F.coalesce("matched", F.lit(False)).alias("matched"))


@query("resume_pending", """
SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""", op="O-J3")
def q_resume_pending(spark, sf):
    return U.pending(table(spark, sf, "documents", spread_rows=False).select("doc_id"),
                     table(spark, sf, "labels"), "doc_id")


@query("resume_pending_orders", """
SELECT o.o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""", op="O-J3 (at size)")
def q_resume_pending_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return U.pending(o, li, "o_orderkey")


@query("already_done", """
SELECT d.doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""", op="O-J4")
def q_already_done(spark, sf):
    return U.already_done(table(spark, sf, "documents", spread_rows=False).select("doc_id"),
                          table(spark, sf, "labels"), "doc_id")


@query("urls_minus_done", f"""
WITH {UE}
SELECT url FROM ue EXCEPT ALL SELECT url FROM ue WHERE status = 'OKK'
""", op="O-U4")
def q_urls_minus_done(spark, sf):
    ue = _ue(spark, sf)
    return ue.select("url").exceptAll(ue.where(F.col("status") == U.STATUS_OKK).select("url"))


@query("ordered_distinct", """
SELECT doc_id, lang, n_copies FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn,
         count(*) OVER (PARTITION BY text) AS n_copies FROM documents) WHERE rn = 1
""", op="O-W1 Q1")
def q_ordered_distinct(spark, sf):
    d = table(spark, sf, "documents")
    # Key on a 256-bit digest of the text: the shuffle carries 32 bytes per
    # row instead of the whole document.
    keyed = d.select(F.sha2("text", 256).alias("k"), "doc_id", "lang")
    return U.first_occurrence(keyed, "k", "doc_id", keep=["lang"], count_as="n_copies").drop("k")


_HREFS = f"""links AS (
  SELECT p.page_id, {S.host('p.url')} AS host, {S.attr_first(S.clean('p.html'), 'html', 'lang')} AS lang,
         u.href, CAST(u.pos - 1 AS BIGINT) AS pos
  FROM pages p, LATERAL (SELECT unnest({S.hrefs(S.clean('p.html'))}) AS href,
                                generate_subscripts({S.hrefs(S.clean('p.html'))}, 1) AS pos) u)"""


def _links(spark, sf):
    p = table(spark, sf, "pages")
    c = p.select("page_id", "url", H.clean_html("html").alias("c"))
    c = c.select("page_id", host("url").alias("host"), H.html_lang("c").alias("lang"), H.hrefs("c").alias("_h"))
    return X.explode_items(c, ["page_id", "host", "lang"], "_h", "pos", "href").withColumn(
        "pos", F.col("pos").cast("bigint"))


_FIRST_PAGE = """first_page AS (SELECT host, min(page_id) AS page_id FROM links GROUP BY host)"""


@query("links_union_all", f"""
WITH {_HREFS}, {_FIRST_PAGE}
SELECT host, href FROM links
UNION ALL
SELECT l.host, l.href FROM links l JOIN first_page f ON l.page_id = f.page_id
""", op="O-U1 Q1")
def q_links_union_all(spark, sf):
    links = stage(_links(spark, sf), "links")      # every page is read once
    first = links.groupBy("host").agg(F.min("page_id").alias("page_id"))
    again = links.join(first.select("page_id"), "page_id", "left_semi")
    return links.select("host", "href").unionByName(again.select("host", "href"))


@query("links_union_distinct", f"""
WITH {_HREFS}, {_FIRST_PAGE}
SELECT host, href FROM links
UNION
SELECT l.host, l.href FROM links l JOIN first_page f ON l.page_id = f.page_id
""", op="O-U2 O-L1")
def q_links_union_distinct(spark, sf):
    return q_links_union_all(spark, sf).distinct()


@query("cross_listed_links", f"""
WITH {_HREFS}
SELECT href, CAST(count(DISTINCT lang) AS BIGINT) AS n_categories
FROM links GROUP BY href HAVING count(DISTINCT lang) > 1
""", op="O-U5")
def q_cross_listed_links(spark, sf):
    return (_links(spark, sf).groupBy("href")
            .agg(F.count_distinct("lang").cast("bigint").alias("n_categories"))
            .where(F.col("n_categories") > 1))


@query("links_not_prefix", f"""
WITH {_HREFS} SELECT page_id, pos, href FROM links WHERE NOT starts_with(href, '/th')
""", op="O-P5 O-F9")
def q_links_not_prefix(spark, sf):
    return _links(spark, sf).where(~F.col("href").startswith("/th")).select("page_id", "pos", "href")


@query("links_valid", f"""
WITH {_HREFS} SELECT page_id, pos, href FROM links WHERE href IS NOT NULL AND href <> ''
""", op="O-P6 Q15")
def q_links_valid(spark, sf):
    return _links(spark, sf).where(F.col("href").isNotNull() & (F.col("href") != "")).select("page_id", "pos", "href")


@query("first_link_per_page", f"""
WITH {_HREFS} SELECT page_id, arg_min(href, pos) AS first_href FROM links GROUP BY page_id
""", op="O-L4")
def q_first_link_per_page(spark, sf):
    return _links(spark, sf).groupBy("page_id").agg(F.min_by("href", "pos").alias("first_href"))


@query("articles_unified", f"""
WITH a AS (
  SELECT 'page' AS kind, page_id AS id, {S.host('url')} AS site,
         {S.paragraphs(S.inner_first(S.clean('html'), 'article'))} AS content
  FROM pages),
d AS (SELECT 'document' AS kind, doc_id AS id, source AS site, [text] AS content FROM documents)
SELECT kind, id, site, CAST(len(content) AS BIGINT) AS n_content,
       CAST(list_sum(list_transform(content, lambda x: length(x))) AS BIGINT) AS content_chars
FROM (SELECT * FROM a UNION ALL SELECT * FROM d)
""", op="O-U3")
def q_articles_unified(spark, sf):
    arts = X.extract_articles_full(table(spark, sf, "pages")).select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), "site", "content", "title")
    docs = table(spark, sf, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("source").alias("site"),
        F.array("text").alias("content"))  # string body wrapped: unionByName rejects string vs array
    u = arts.unionByName(docs, allowMissingColumns=True)
    return u.select("kind", "id", "site", F.size("content").cast("bigint").alias("n_content"),
                    F.aggregate("content", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("content_chars"))


@query("harvest_summary", """
SELECT d.source AS site,
       CAST(count(*) FILTER (WHERE l.quality = 1) AS BIGINT) AS n_ok,
       CAST(count(*) FILTER (WHERE l.quality = 0) AS BIGINT) AS n_error,
       CAST(count(*) FILTER (WHERE l.doc_id IS NULL) AS BIGINT) AS n_lost
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source
""", op="O-A8")
def q_harvest_summary(spark, sf):
    d = table(spark, sf, "documents", spread_rows=False).select("doc_id", F.col("source").alias("site"))
    lab = table(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, 200).otherwise(500).alias("status"))
    return Q.harvest_summary(d.join(lab, "doc_id", "left"), "site", "status")


@query("synthetic_urls", """
SELECT 'https://u' || CAST(event_id AS VARCHAR) || '.example.net/' AS url,
       ['new', 'error', 'done'][(instr('0123456789abcdef', substr(md5(CAST(event_id AS VARCHAR) || ':42'), 1, 1)) - 1) % 3 + 1] AS status
FROM events
""", op="O-S10 O-F24")
def q_synthetic_urls(spark, sf):
    from presslake.sources.readers import synthetic_urls
    return synthetic_urls(table(spark, sf, "events").select("event_id"), "event_id")
