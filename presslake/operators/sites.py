"""Per-site article specs as data (§2.3.1) and the generic spec evaluator (O-X23).

A spec maps output fields to selectors over the node table; one generic
function evaluates any spec, so adding a site is adding data, not code.
Field kinds: ``first`` (text of the first match), ``all`` (texts of every
match in document order), ``attr:<name>`` (attribute of the first match),
``attrs:<name>`` (of every match), ``children`` (texts of the first match's
children, bare text included), ``outer`` (markup of the first match).  A
selector may be a tuple: the union of its members.  :func:`site_records` reads
a mixed table, each page by its host's spec, in one pass.
Missing values are NULL (Q5); list fields are ``[]`` when nothing matches
(Q6); ``render_sentinels`` writes a site's own placeholders at the edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from presslake.functions.text import path_tail_name, py_strip, remove_prefix, split_last, strip_chars
from presslake.functions.urls import absolutize_all, base_parts, host, scheme_host
from presslake.operators import nodes as N
from presslake.operators import selectors as SL
from presslake.operators.pagination import page_count
from presslake.operators.selectors import Sel

# ---- fixed values -------------------------------------------------------
# Selectors and placeholder texts of the harvested sites (field → selector).
SPECS = {
    "wp_cats": {
        "category": ("first", Sel.tag(None, cls="the-post-meta").descendant(Sel.tag("span", cls="cats"))
                     .descendant(Sel.tag("a").last_child())),
        "title": ("first", Sel.tag("h1", cls="post-title")),
        "content": ("all", Sel.any().cls("post-content").child(Sel.any().is_("h2", "p"))),
        "author": ("first", Sel.tag("span", cls="posted-by").descendant(Sel.tag("span", cls="reviewer"))),
        "published_raw": ("first", Sel.tag("span", cls="posted-on").descendant(Sel.tag("time"))),
        "image_url": ("attr:src", Sel.tag("figure", cls="wp-block-image").descendant(Sel.tag("img"))),
    },
    "counter_paged": {
        "title": ("first", Sel.tag("div", cls="article-title").nth_child(2)),
        "content_text": ("first", Sel.any().cls("article-body")),
        "published_raw": ("first", Sel.any().cls("info-bar").descendant(Sel.any().cls("date"))),
        "tags": ("first", Sel.any().cls("article-tags")),
    },
    "entry_paras": {
        "title": ("first", Sel.tag("h1", cls="post-title")),
        "content": ("all", Sel.tag("div", cls="entry").child(Sel.tag("p"))),
    },
    "td_post": {
        "title": ("first", Sel.tag("h1", cls="tdb-title-text")),
        "content_text": ("first", Sel.tag("div", cls="td-post-content")),
    },
    "item_page": {
        "category": ("first", Sel.tag(None, id="mytex_middle_content_component_div1").descendant(Sel.tag("h3"))),
        "title": ("first", Sel.tag("h2", cls="contentheading")),
        "content": ("all", Sel.any().cls("item-page").descendant(Sel.tag("p").without_attr("class"))),
        "author": ("first", Sel.tag("dl", cls="article-info").descendant(Sel.tag("dd", cls="createdby"))),
        "published_raw": ("first", Sel.tag("dl", cls="article-info").descendant(Sel.tag("dd", cls="published"))),
    },
    "styled_components": {
        "title": ("first", Sel.tag("h1")),
        "category": ("first", Sel.tag("div").attr_prefix("class", "DefaultFormatShell__Meta")
                     .descendant(Sel.tag("a").attr_prefix("class", "HeadingLabel"))),
        "published_raw": ("first", Sel.any().cls("common__Date-sc-dffrbw-2")),
        "content": ("children", Sel.any().cls("BodyStyler__GutenbergStyled-sc-ssx5r2-0", "epAIFH")),
        "author": ("first", Sel.tag("div").attr_prefix("class", "AuthorCard__Content").descendant(Sel.tag("strong"))),
        "image_url": ("attr:src", Sel.tag("div").attr_prefix("class", "DefaultArticleType__FeaturedImage")
                      .descendant(Sel.tag("img"))),
    },
    "edition_article": {
        "title": ("first", Sel.tag("h1")),
        "author": ("first", Sel.any().cls("a_author").child(Sel.tag("span").nth_child(1))),
        "text_html": ("outer", Sel.any().cls("txt_articol").child(Sel.tag("p").nth_child(2))),
        "image_url": ("attr:src", Sel.any().cls("article_img")),
    },
    "book_detail": {
        "title": ("first", Sel.tag("h1")),
        "description": ("first", Sel.tag("div", id="product_description").adjacent(Sel.tag("p"))),
        "price_raw": ("first", Sel.tag("h1").adjacent(Sel.tag("p", cls="price_color"))),
        "image_url": ("attr:src", Sel.tag(None, id="product_gallery").child(Sel.tag("div")).child(Sel.tag("div"))
                      .child(Sel.tag("div")).child(Sel.tag("img"))),
    },
    "book_http": {"title": ("first", Sel.tag("h1"))},
    "book_single": {"title": ("first", Sel.tag("h1"))},
    "wiki_title": {"title": ("first", Sel.tag("h1"))},
    "pdf_offer": {
        "download_url": ("attr:href", Sel.any().cls("product-price-and-delivery").descendant(Sel.any().cls("product-price"))
                         .descendant(Sel.tag("a"))),
    },
    "pdf_library": {
        "download_url": ("attr:href", Sel.any().cls("prod_desc_text").descendant(Sel.tag("a").attr_equals("target", "_blank"))),
    },
}
# Listing pages: the article links, and the counter that says how many pages there are.
LISTINGS = {
    "wp_cats": {"links": ("attrs:href", tuple(Sel.any().cls(c).descendant(Sel.tag("h2", cls=("is-title", "post-title"))).descendant(Sel.tag("a"))
                                              for c in ("main-content", "main-featured")))},
    "entry_paras": {"links": ("attrs:href", Sel.tag("article", cls="item-list").descendant(Sel.tag("h2")).descendant(Sel.tag("a"))),
                    "page_label": ("first", Sel.tag("span", cls="pages"))},
    "td_post": {"links": ("attrs:href", (Sel.any().cls("td-category-pos-above").descendant(Sel.tag("a", cls="td-image-wrap")),
                                         Sel.any().cls("tdb-numbered-pagination").descendant(Sel.tag("h3", cls="entry-title")).descendant(Sel.tag("a")))),
                "page_label": ("first", Sel.tag("span", cls="pages"))},
    "pdf_offer": {"links": ("attrs:href", Sel.tag("a", cls="product-item-name"))},
    "pdf_library": {"links": ("attrs:href", Sel.any().cls("book_box").descendant(Sel.any().cls("book-description")).descendant(Sel.tag("a")))},
}
# How a listing's further pages are addressed; skip_last leaves the last one out.
LISTING_PAGES = {
    "wp_cats": {"pattern": "{base}page/{n}", "pages": 1440},
    "entry_paras": {"pattern": "{base}/page/{n}"},
    "td_post": {"pattern": "{base}page/{n}/", "skip_last": True},
    "pdf_offer": {"pattern": "{base}?page={n}", "pages": 60},
    "pdf_library": {"pattern": "{base}/{n}", "pages": 4},
}
# An edition's page: its date, and sections that hold the article links.
EDITION_PAGE = {"publication_date": ("first", Sel.any().cls("archive_index").descendant(Sel.tag("h1")))}
EDITION_SECTION = Sel.any().cls("category_holder")
EDITION_SECTION_FIELDS = {"section_title": ("first", Sel.tag("h2"))}
EDITION_LINK = Sel.tag("h3").descendant(Sel.tag("a"))
SENTINELS = {
    "wp_cats": {"title": "[scrape] no title", "category": "[scrape] no category",
                "author": "[scrape] no author", "published_raw": "[scrape] no published date",
                "image_url": "none", "image_file": "none"},
    "counter_paged": {"title": "[scrape] no title", "content_text": "[scrape] no content",
                      "published_raw": "[scrape] no published date", "tags": "[scrape] no tags"},
    "entry_paras": {"title": "[scrape] No title"},
    "td_post": {"title": "[scrape] No title", "content_text": "[scrape] No content"},
    "item_page": {"title": "[scrape] no title", "category": "[scrape] no category",
                  "author": "[scrape] no author", "published_raw": "[scrape] no published date"},
    "styled_components": {"title": "[scrape] no title", "category": "[scrape] no category", "author": "[scrape] no author",
                          "published_raw": "[scrape] no published date", "image_url": "n/a"},
    "edition_article": {"title": "", "author": "", "text_html": ""},
    "book_detail": {"title": "", "description": "", "image_url": ""},
    "book_http": {"title": ""},
    "wiki_title": {"title": "Default title"},
}
#: Fields that a site's harvest strips.
STRIPPED = {
    "wp_cats": ("title", "category", "published_raw"),
    "counter_paged": ("title", "published_raw", "tags"),
    "item_page": ("title", "category", "published_raw"),
    "styled_components": ("title", "category", "author", "published_raw"),
}
# -------------------------------------------------------------------------


def plain_spec(spec: dict) -> list:
    """A spec as data that tasks compile: (field, kind, selectors)."""
    return [(field, kind, [SL.plain(x) for x in (sel if isinstance(sel, tuple) else (sel,))]) for field, (kind, sel) in spec.items()]


def extract_with_spec(pages: DataFrame, nodes: DataFrame | None, spec: dict) -> DataFrame:
    """Evaluate a spec: one row per page with one column per field.

    All fields are read in one pass over each page, in the task that reads it:
    no shuffle, no join.  ``nodes`` is not needed; it is taken for calls that
    have shredded the pages already."""
    return N.record_rows(pages, {"": plain_spec(spec)}).select("page_id", "url", *[_listed(k, f) for f, (k, _) in spec.items()])


def _listed(kind: str, field: str) -> Column:
    """List fields are ``[]`` when nothing matches (Q6)."""
    return F.coalesce(F.col(field), F.array().cast("array<string>")).alias(field) if N.field_type(kind) != "string" else F.col(field)


def site_of(url, hosts: dict[str, str]) -> Column:
    """The site of a URL by its host (``hosts``: host → site); NULL if unknown."""
    known = F.create_map(*[F.lit(x) for kv in sorted(hosts.items()) for x in kv]) if hosts else F.create_map().cast("map<string,string>")
    return F.try_element_at(known, F.lower(host(url)))


def site_records(pages: DataFrame, hosts: dict[str, str], specs: dict | None = None) -> DataFrame:
    """O-X23 over a mixed landing table ``pages(page_id, url, html[, status])``:
    every page is read by the spec of its host, in one pass and no shuffle, and
    cleaned as its site does.

    All specs' fields are columns; those that a site does not have, are missing
    on the page (Q5), or belong to a page of an unknown host (site NULL), are
    NULL.  ``outcome``: ``ok``; ``error`` for another status than 200 (no
    fields, the status in ``error``); ``broken`` if the page's markup could not
    be read to its end (``parse_error`` says why, the fields before it stay);
    ``unknown`` host; ``skipped`` if a download page shows no link."""
    specs = specs or SPECS
    carry = ["url", *(["status"] if "status" in pages.columns else [])]
    rows = N.record_rows(pages.withColumn("site", site_of("url", hosts)), {k: plain_spec(v) for k, v in specs.items()}, "site", carry)
    lists = {f for spec in specs.values() for f, (kind, _) in spec.items() if N.field_type(kind) != "string"}
    for f in lists:      # a site with the field has a list; another has NULL
        having = [k for k, spec in specs.items() if f in spec]
        rows = rows.withColumn(f, F.when(F.col("site").isin(having), F.coalesce(F.col(f), F.array().cast("array<string>"))))
    rows = cleaned(rows)
    status = F.col("status") if "status" in rows.columns else F.lit(200)
    good = F.coalesce(status, F.lit(200)) == 200
    fields = [c for c in rows.columns if c not in ("page_id", "url", "site", "status", "parse_error")]
    downloads = [k for k, spec in specs.items() if "download_url" in spec]
    outcome = (F.when(~good, F.lit("error")).when(F.col("parse_error").isNotNull(), F.lit("broken")).when(F.col("site").isNull(), F.lit("unknown"))
               .when(F.col("site").isin(downloads) & F.col("download_url").isNull(), F.lit("skipped")).otherwise(F.lit("ok")))
    return rows.select("page_id", "url", "site", outcome.alias("outcome"), F.when(~good, status).cast("int").alias("error"), "parse_error",
                       *[F.when(good, F.col(f)).alias(f) for f in fields])


def observed(records: DataFrame, name: str = "records") -> tuple[DataFrame, Observation]:
    """``records`` and an observation of their outcomes, counted in the pass
    that writes them (``observation.get`` after an action)."""
    seen = Observation(name)
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in ("ok", "error", "broken", "unknown", "skipped")]
    return records.observe(seen, F.count(F.lit(1)).alias("pages"), *counts), seen


def parse_errors(records: DataFrame) -> DataFrame:
    """The error channel: one row per page whose markup broke the tokenizer."""
    return records.where("parse_error is not null").select("page_id", "url", "site", "parse_error")


def image_manifest(records: DataFrame) -> DataFrame:
    """O-K6: the images of records to fetch, each URL once, with the file name
    its site gives it; records without an image have none (nor those whose
    placeholder says so)."""
    none = sorted({v["image_url"] for v in SENTINELS.values() if "image_url" in v} | {""})
    have = records.where(F.col("image_url").isNotNull() & ~F.col("image_url").isin(none))
    return have.groupBy("image_url").agg(F.min(F.struct("page_id", "site", "image_file")).alias("r")).select(
        "image_url", F.coalesce("r.image_file", split_last("image_url", "/")).alias("image_file"), "r.site", "r.page_id")


def _on(site: str, field: str, value: Column, df: DataFrame) -> Column:
    return F.when(F.col("site") == site, value).otherwise(F.col(field) if field in df.columns else F.lit(None)).alias(field)


def cleaned(df: DataFrame) -> DataFrame:
    """The clean-ups of each site (§2.3.1) on rows with a ``site`` column."""
    for field in sorted({f for fields in STRIPPED.values() for f in fields}):
        if field in df.columns:
            sites_ = [k for k, fields in STRIPPED.items() if field in fields]
            df = df.withColumn(field, F.when(F.col("site").isin(sites_), py_strip(field)).otherwise(F.col(field)))
    if "category" in df.columns:
        df = df.withColumn("category", _on("wp_cats", "category", F.lower("category"), df))
    if "image_url" in df.columns:
        name = (F.when(F.col("site") == "wp_cats", path_tail_name("image_url", 5)).when(F.col("site") == "styled_components", path_tail_name("image_url", 5, False))
                .when(F.col("site") == "edition_article", split_last("image_url", "/")))
        df = df.withColumn("image_file", F.when(F.col("image_url").isNotNull(), name))
        df = df.withColumn("image_url", F.when(F.col("site") == "edition_article", F.concat(scheme_host("url"), "image_url"))
                           .when(F.col("site") == "book_detail", remove_prefix("image_url", "../../")).otherwise(F.col("image_url")))
    if "price_raw" in df.columns:
        df = df.withColumn("price", _on("book_detail", "price", strip_chars(py_strip("price_raw"), "£").try_cast("decimal(10,2)"), df))
    if "download_url" in df.columns:
        df = df.withColumn("download_url", _on("pdf_library", "download_url", F.concat(scheme_host("url"), "download_url"), df))
    return df


def site_articles(pages: DataFrame, nodes: DataFrame | None, site: str) -> DataFrame:
    """O-X23 for pages of one site: spec fields, then the site's clean-ups."""
    return cleaned(extract_with_spec(pages, nodes, SPECS[site]).withColumn("site", F.lit(site)))


def render_sentinels(df: DataFrame, site: str | None = None) -> DataFrame:
    """Q5: write a site's own placeholder text where a field is missing; each
    row by its ``site`` if none is given."""
    if site is not None:
        s = SENTINELS.get(site, {})
        return df.select(*[F.coalesce(F.col(c), F.lit(s[c])).alias(c) if c in s else F.col(c) for c in df.columns])
    out = []
    for c in df.columns:
        texts = {k: v[c] for k, v in SENTINELS.items() if c in v}
        given = F.create_map(*[F.lit(x) for kv in texts.items() for x in kv]) if texts else None
        out.append(F.coalesce(F.col(c), F.try_element_at(given, F.col("site"))).alias(c) if texts else F.col(c))
    return df.select(*out)


def listing_records(pages: DataFrame, hosts: dict[str, str]) -> DataFrame:
    """O-X20: one row per listing page: site, the counter's number of pages
    (0: no label; a site with a fixed number: that) and the article links in
    order, resolved against the page.  A page of an unknown host has site NULL
    and no links."""
    rows = N.record_rows(pages.withColumn("site", site_of("url", hosts)), {k: plain_spec(v) for k, v in LISTINGS.items()}, "site")
    fixed = F.create_map(*[F.lit(x) for k, v in LISTING_PAGES.items() if "pages" in v for x in (k, v["pages"])])
    n = F.coalesce(F.try_element_at(fixed, F.col("site")), page_count("page_label"))
    links = F.filter(F.coalesce("links", F.array().cast("array<string>")), lambda x: x != "")
    return rows.withColumn("_base", base_parts("url")).select("page_id", "url", "site", n.alias("n_pages"), absolutize_all(links, "_base").alias("links"))


def listing_page_urls(listings: DataFrame) -> DataFrame:
    """(url, site, page_no, page_url) of every page of each listing's first
    page, by its site's pattern."""
    of = lambda what, none: F.try_element_at(F.create_map(*[F.lit(x) for k, v in LISTING_PAGES.items() for x in (k, v.get(what, none))]), F.col("site"))
    last = F.greatest(F.col("n_pages") - F.when(of("skip_last", False), 1).otherwise(0), F.lit(1))
    rows = listings.where("site is not null").select("url", "site", of("pattern", "").alias("_p"), F.explode(F.sequence(F.lit(1), last)).alias("page_no"))
    at = F.replace(F.replace("_p", F.lit("{base}"), F.col("url")), F.lit("{n}"), F.col("page_no").cast("string"))
    return rows.select("url", "site", "page_no", F.when(F.col("page_no") == 1, F.col("url")).otherwise(at).alias("page_url"))


def edition_links(pages: DataFrame) -> DataFrame:
    """O-X21: the article links of edition pages, one row each, with what lies
    above them carried down: the edition's date (what follows the last `` - ``)
    and the title of the section (``Default`` if it has none).  A section
    without links has one row with a NULL link."""
    nested = lambda fields: [(f, kind, SL.plain(sel) if sel is not None else None) for f, (kind, sel) in fields.items()]
    rows = N.nested_rows(pages, nested(EDITION_PAGE), SL.plain(EDITION_SECTION), nested(EDITION_SECTION_FIELDS), SL.plain(EDITION_LINK),
                         nested({"href": ("attr:href", None), "link_text": ("first", None)}))
    return rows.select("page_id", split_last("publication_date", " - ").alias("publication_date"), F.col("scope_pos").alias("section_pos"),
                       F.coalesce("section_title", F.lit("Default")).alias("section_title"), F.col("item_pos").alias("link_pos"),
                       F.concat(scheme_host("url"), "href").alias("link"), "link_text")
