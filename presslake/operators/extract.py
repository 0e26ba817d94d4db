"""Extraction operators over ``pages`` (token path, Catalyst only).

The page is read once, cleaned once, and every field is projected in one
narrow ``select`` — no shuffle, whole-stage codegen, and the ``html`` column
is dropped before anything downstream can shuffle it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.functions.text import py_strip
from presslake.functions.urls import absolutize_with, host, normalize_url, with_page_base


def explode_items(df: DataFrame, keep, array_col, pos: str = "pos", val: str = "value") -> DataFrame:
    """One row per array element with its 0-based position; empty / NULL
    arrays give no row.

    Uses ``posexplode_outer`` + a NULL filter instead of ``posexplode``: for
    the plain generator Catalyst infers ``size(array) > 0`` and pushes it to
    the scan, which would evaluate the (expensive) array expression twice —
    once below any repartition, i.e. without its parallelism."""
    out = df.select(*keep, F.posexplode_outer(array_col).alias(pos, val))
    return out.where(F.col(pos).isNotNull())


def cleaned(pages: DataFrame, cols=("page_id", "url")) -> DataFrame:
    """Pages with ``clean`` (script/style/comments removed) and ``article``."""
    return (pages.select(*cols, H.clean_html("html").alias("clean"))
            .withColumn("article", H.inner_first("clean", "article")))


def extract_articles(pages: DataFrame) -> DataFrame:
    """O-X23 flagship: one record per page with every field in one pass.

    Output: page_id, url, site, lang, title, headline, n_paragraphs,
    first_paragraph, content_chars, n_links.  ``content`` stays an array in
    :func:`extract_articles_full`; here it is summarised for the report.
    """
    # ``paras`` is its own projection: referenced three times, it is computed
    # once (Catalyst does not collapse a non-cheap alias used repeatedly).
    c = cleaned(pages).withColumn("paras", H.paragraphs(F.col("article")))
    return c.select(
        "page_id", "url",
        host("url").alias("site"),
        H.html_lang("clean").alias("lang"),
        H.first_text("clean", "title").alias("title"),
        H.first_text("article", "h1").alias("headline"),
        F.size("paras").cast("bigint").alias("n_paragraphs"),
        F.get("paras", 0).alias("first_paragraph"),
        F.length(F.array_join("paras", "")).cast("bigint").alias("content_chars"),
        F.size(H.hrefs("clean")).cast("bigint").alias("n_links"),
    )


def extract_articles_full(pages: DataFrame, sentinels: dict | None = None) -> DataFrame:
    """Article records in the unified ``articles`` schema (§1.3).

    Missing fields are NULL internally (Q5); ``sentinels`` renders a site's own
    placeholder text (e.g. ``{"title": "[scrape] no title"}``) at the edge.
    """
    c = cleaned(pages, cols=[x for x in ("page_id", "url", "status") if x in pages.columns])
    if "status" not in c.columns:
        c = c.withColumn("status", F.lit(None).cast("int"))
    out = c.select(
        "page_id",
        host("url").alias("site"),
        "url",
        F.col("status").cast("int").alias("status"),
        H.first_text("article", "h1").alias("title"),
        H.paragraphs(F.col("article")).alias("content"),
        F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("string").alias("author"),
        F.lit(None).cast("string").alias("published_raw"),
        F.lit(None).cast("date").alias("published"),
        F.lit(None).cast("string").alias("tags"),
        H.attr_first("article", "img", "src").alias("image_url"),
    )
    if sentinels:
        out = out.select(*[F.coalesce(F.col(k), F.lit(sentinels[k])).alias(k) if k in sentinels else F.col(k)
                           for k in out.columns])
    return out


def page_links(pages: DataFrame, absolute: bool = False) -> DataFrame:
    """O-X14/O-X20: one row per link ``(page_id, url, pos, href)`` in page order."""
    if not absolute:
        c = pages.select("page_id", "url", H.hrefs(H.clean_html("html")).alias("hrefs"))
        return explode_items(c, ["page_id", "url"], "hrefs", "pos", "href")
    # base-URL parts once per page, then explode the page's links
    c = with_page_base(pages.select("page_id", "url", H.clean_html("html").alias("_clean")), "url", "_clean")
    c = c.select("page_id", "url", "_base", H.hrefs("_clean").alias("hrefs"))
    out = explode_items(c, ["page_id", "url", "_base"], "hrefs", "pos", "href")
    return out.withColumn("abs_url", absolutize_with("href", "_base")).drop("_base")


def download_manifest(listing: DataFrame, details: DataFrame) -> DataFrame:
    """O-K7 / O-J5: listing link → detail page → its first download link.

    ``listing`` has ``detail_url`` (and any columns that name the entry);
    ``details(url, html)`` are the landed detail pages.  Download links are
    read where the pages are read; the lookup joins URLs only.  An entry whose
    detail page did not land, or has no link, stays as ``skipped``."""
    d = with_page_base(details.select(normalize_url("url").alias("_key"), H.clean_html("html").alias("c"), "url"), "url", "c")
    d = d.select("_key", "_base", F.get(H.hrefs("c"), 0).alias("_href"))
    one = d.select("_key", absolutize_with("_href", "_base").alias("pdf_url")).groupBy("_key").agg(F.min("pdf_url").alias("pdf_url"))
    out = listing.withColumn("_k", normalize_url("detail_url")).join(one, F.col("_k") == F.col("_key"), "left").drop("_k", "_key")
    name = F.regexp_extract("pdf_url", r"([^/?#]*)(?:[?#].*)?$", 1)
    return out.withColumn("skipped", F.col("pdf_url").isNull()).withColumn("file_name", F.when(F.col("pdf_url").isNotNull(), name))


def article_paragraphs(pages: DataFrame, drop_blank: bool = False) -> DataFrame:
    """O-X16: ``(page_id, pos, text)`` one row per paragraph."""
    c = cleaned(pages)
    return explode_items(c, ["page_id"], H.paragraphs(F.col("article"), drop_blank), "pos", "text")


def article_text(pages: DataFrame) -> DataFrame:
    """O-X18: full text of the article element (``get_text`` + strip)."""
    c = cleaned(pages)
    return c.select("page_id", py_strip(H.text_of(F.col("article"))).alias("text"))


def article_outer_html(pages: DataFrame) -> DataFrame:
    """O-X19: outer markup of the article's first ``<h1>`` and of the article."""
    c = pages.select("page_id", H.clean_html("html").alias("clean"))
    return c.select("page_id",
                    H.outer_first("clean", "h1").alias("h1_html"),
                    F.length(H.outer_first("clean", "article")).cast("bigint").alias("article_html_len"))
