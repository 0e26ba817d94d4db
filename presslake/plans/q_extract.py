"""Queries for extraction over ``pages`` (§2.3 token path, flagship)."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.operators import extract as X
from presslake.plans import sqlfrag as S
from presslake.plans.registry import query
from presslake.sources.tables import read_pages, table

_C = S.clean("html")
_ART = S.inner_first("c", "article")

ARTICLES_SQL = f"""
WITH c AS (SELECT page_id, url, {_C} AS c FROM pages),
a AS (SELECT page_id, url, c, {_ART} AS article FROM c),
p AS (SELECT *, {S.paragraphs("article")} AS paras FROM a)
SELECT page_id, url,
       {S.host("url")} AS site,
       {S.attr_first("c", "html", "lang")} AS lang,
       {S.first_text("c", "title")} AS title,
       {S.first_text("article", "h1")} AS headline,
       CAST(len(paras) AS BIGINT) AS n_paragraphs,
       paras[1] AS first_paragraph,
       CAST(list_sum(list_transform(paras, lambda x: length(x))) AS BIGINT) AS content_chars,
       CAST(len({S.hrefs("c")}) AS BIGINT) AS n_links
FROM p
"""


@query("articles", ARTICLES_SQL, op="O-X23 O-X1 O-X2 O-X14 O-X16 O-S3")
def q_articles(spark, sf):
    return X.extract_articles(read_pages(spark, sf))


@query("pages_scan", "SELECT page_id, url, CAST(length(html) AS BIGINT) AS html_chars FROM pages", op="O-S3")
def q_pages_scan(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", F.length("html").cast("bigint").alias("html_chars"))


@query("page_title", f"SELECT page_id, coalesce({S.first_text(_C, 'title')}, 'Default title') AS title FROM pages",
       op="O-X1")
def q_page_title(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", H.first_text(H.clean_html("html"), "title", default="Default title").alias("title"))


@query("page_h1", f"SELECT page_id, {S.first_text(_C, 'h1')} AS h1 FROM pages", op="O-X2")
def q_page_h1(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", H.first_text(H.clean_html("html"), "h1").alias("h1"))


@query("page_links", f"""
SELECT page_id, CAST(len({S.hrefs(_C)}) AS BIGINT) AS n_links FROM pages
""", op="O-X14")
def q_page_links(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", F.size(H.hrefs(H.clean_html("html"))).cast("bigint").alias("n_links"))


_LINKS_SQL = f"""
SELECT page_id, url, CAST(u.pos - 1 AS BIGINT) AS pos, u.href
FROM (SELECT page_id, url, {S.hrefs(_C)} AS hs FROM pages) t,
     LATERAL (SELECT unnest(hs) AS href, generate_subscripts(hs, 1) AS pos) u
"""


def _abs_sql(h: str, b: str) -> str:
    sh = S.scheme_host(b)
    nofrag = f"regexp_replace({b}, '#.*$', '')"
    path = f"regexp_replace({nofrag}, '\\?.*$', '')"
    rest_dir = f"regexp_replace(substring({path}, length({sh}) + 1), '[^/]*$', '')"
    bdir = f"{sh} || CASE WHEN {rest_dir} = '' THEN '/' ELSE {rest_dir} END"
    return f"""CASE WHEN {h} IS NULL THEN NULL
      WHEN regexp_matches({h}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {h}
      WHEN starts_with({h}, '//') THEN regexp_extract({b}, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) || ':' || {h}
      WHEN starts_with({h}, '/') THEN {sh} || {h}
      WHEN starts_with({h}, '#') THEN {nofrag} || {h}
      WHEN starts_with({h}, '?') THEN {path} || {h}
      WHEN {h} = '' THEN {nofrag}
      ELSE {bdir} || {h} END"""


@query("links_absolute", f"""
SELECT page_id, pos, href, {_abs_sql('href', 'url')} AS abs_url FROM ({_LINKS_SQL})
""", op="O-X15")
def q_links_absolute(spark, sf):
    return X.page_links(table(spark, sf, "pages"), absolute=True).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "href", "abs_url")


@query("article_paragraphs", f"""
WITH a AS (SELECT page_id, {S.inner_first(_C, 'article')} AS article FROM pages),
p AS (SELECT page_id, {S.paragraphs('article')} AS paras FROM a)
SELECT page_id, CAST(u.pos - 1 AS BIGINT) AS pos, u.text
FROM p, LATERAL (SELECT unnest(paras) AS text, generate_subscripts(paras, 1) AS pos) u
""", op="O-X16")
def q_article_paragraphs(spark, sf):
    return X.article_paragraphs(table(spark, sf, "pages")).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "text")


@query("article_text", f"""
SELECT page_id, {S.strip(S.text_of(S.inner_first(_C, 'article')))} AS text FROM pages
""", op="O-X18")
def q_article_text(spark, sf):
    return X.article_text(table(spark, sf, "pages"))


@query("article_outer_html", f"""
SELECT page_id, {S.outer_first(_C, 'h1')} AS h1_html,
       CAST(length({S.outer_first(_C, 'article')}) AS BIGINT) AS article_html_len FROM pages
""", op="O-X19")
def q_article_outer_html(spark, sf):
    return X.article_outer_html(table(spark, sf, "pages"))


@query("sql_links", f"""
SELECT page_id, CAST(u.pos - 1 AS BIGINT) AS pos, u.href
FROM pages, LATERAL (SELECT unnest({S.hrefs(_C)}) AS href, generate_subscripts({S.hrefs(_C)}, 1) AS pos) u
""", op="O-Y2 O-Y4 (SQL table function)")
def q_sql_links(spark, sf):
    from presslake.sqlapi import register_sql_functions
    register_sql_functions(spark)
    return spark.sql("SELECT p.page_id, CAST(l.pos AS BIGINT) AS pos, l.href FROM {pages} p, LATERAL pl_links(p.html) l",
                     pages=table(spark, sf, "pages"))
