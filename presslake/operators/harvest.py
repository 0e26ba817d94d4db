"""The harvest jobs of SURVEY §3 composed from the operators.

Article harvest: URL list → first occurrence per normalised URL (O-W1) → left
lookup of the landed pages (O-J1; a URL without a page stays as a ``lost``
row, Q8) → record and outcome (O-X23, O-P1) → sinks (O-K1 JSONL, O-K6
manifest).  Every page is extracted where it is read: what is shuffled is its
record, never its HTML.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.functions.urls import absolutize_all, host, normalize_url, with_page_base
from presslake.operators.extract import extract_articles_full
from presslake.operators.pagination import expand_pages, page_count, page_url
from presslake.operators.urls import first_occurrence, lookup
from presslake.session import stage

# Fields parsed from the page: an error page has none of them.
PARSED = ("title", "content", "category", "author", "published_raw", "published", "tags", "image_url")


def latest_page(pages: DataFrame, key: str = "url_key") -> DataFrame:
    """Of several landed pages of one URL the one with the largest page_id."""
    cols = [c for c in pages.columns if c != key]
    one = pages.groupBy(key).agg(F.max_by(F.struct(*cols), "page_id").alias("_p"))
    return one.select(key, "_p.*")


def harvest(urls: DataFrame, pages: DataFrame, order_col: str = "pos") -> DataFrame:
    """``urls(url, <order_col>)`` + ``pages(page_id, url, html[, status])`` →
    one article record per distinct normalised URL, with ``outcome``:

    * ``lost`` — no landed page;
    * ``ok`` — a page with status 200, or landed without a status;
    * ``error`` — any other status; only url and status are kept, a page that
      reports an error is not parsed into fields.

    ``order_col`` (any orderable type, e.g. a struct) decides which spelling
    of a URL is kept: the first.  Of several pages of one URL the latest
    (largest page_id) counts."""
    keyed = urls.select(normalize_url("url").alias("url_key"), "url", order_col)
    first = first_occurrence(keyed, "url_key", order_col, keep=["url"])
    status = F.coalesce(F.col("status"), F.lit(200)) if "status" in pages.columns else F.lit(200)
    landed = pages.select("page_id", "url", status.cast("int").alias("status"), "html")
    arts = extract_articles_full(landed).withColumn("url_key", normalize_url("url")).drop("url", "site")
    good = F.col("status") == 200
    arts = arts.select(*[F.when(good, F.col(c)).alias(c) if c in PARSED else F.col(c) for c in arts.columns])
    joined = lookup(first.drop(order_col), latest_page(arts), "url_key")
    kind = F.when(F.col("page_id").isNull(), F.lit("lost")).when(good, F.lit("ok")).otherwise(F.lit("error"))
    return joined.withColumn("outcome", kind).withColumn("site", host("url"))


def harvest_report(articles: DataFrame) -> DataFrame:
    """Per site: distinct URLs and their outcomes (the run's final summary);
    ``n_ok + n_error + n_lost = n_urls``."""
    o = F.col("outcome")
    return articles.groupBy("site").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_urls"),
        F.count_if(o == "ok").cast("bigint").alias("n_ok"),
        F.count_if(o == "error").cast("bigint").alias("n_error"),
        F.count_if(o == "lost").cast("bigint").alias("n_lost"),
        F.count_if((o == "ok") & F.col("title").isNotNull()).cast("bigint").alias("n_with_title"))


def listing_harvest(seeds: DataFrame, pages: DataFrame, counter_tag: str = "span",
                    counter_class: str = "pages", page_pattern: str = "{base}/page/{n}",
                    skip_last: bool = False) -> DataFrame:
    """The listing-harvest job of SURVEY §3.2 composed from the operators.

    ``seeds(url)`` are first listing pages (editions / categories);
    ``pages(page_id, url, html)`` is everything fetched.  Each page's counter
    and links are read in place; then per seed: page count from the ``Page x
    of y`` label (O-X24, lenient: unparsable → first page only, Q2), page URLs
    2..n (O-S5, ``skip_last`` = Q3), lookup of those pages' links (O-J1, O-X14/
    15), union with the seed's own (O-U1, Q1) and order-preserving distinct
    (O-W1).  Output ``(seed_url, page_no, pos, link)``, one row per distinct
    link per seed; a listing page that did not land stays visible as a row
    without pos and link.
    """
    label_re = f'(?is)<{counter_tag}\\b[^>]*\\bclass="[^"]*\\b{counter_class}\\b[^"]*"[^>]*>(.*?)</{counter_tag}>'
    read = with_page_base(pages.select("page_id", "url", H.clean_html("html").alias("clean")))
    # Staged: each page is read once, for its counter and its links alike.
    read = stage(latest_page(read.select(
        normalize_url("url").alias("url_key"), "page_id", page_count(F.regexp_extract("clean", label_re, 1)).alias("n"),
        absolutize_all(H.hrefs("clean"), "_base").alias("links"))), "listing-pages")
    seed = seeds.select(F.col("url").alias("seed_url"), normalize_url("url").alias("url_key")).distinct()
    first = seed.join(read.select("url_key", "n"), "url_key", "left")
    more = expand_pages(first.select("seed_url", F.greatest(F.coalesce("n", F.lit(1)), F.lit(1)).alias("n")), "n", skip_last=skip_last)
    listing = first.select("seed_url", F.lit(1).cast("bigint").alias("page_no"), "url_key").unionByName(
        more.select("seed_url", "page_no", normalize_url(page_url(F.col("seed_url"), "page_no", page_pattern)).alias("url_key")))
    got = listing.join(read.select("url_key", "page_id", "links"), "url_key", "left")
    lost = got.where("page_id is null").select("seed_url", "page_no", F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("link"))
    links = got.where("page_id is not null").select("seed_url", "page_no", F.posexplode_outer("links").alias("pos", "link")).where("pos is not null")
    # The first place of each link of a seed, by (page_no, pos).
    firsts = links.groupBy("seed_url", "link").agg(F.min(F.struct("page_no", "pos")).alias("_at"))
    return firsts.select("seed_url", "_at.page_no", "_at.pos", "link").unionByName(lost)
