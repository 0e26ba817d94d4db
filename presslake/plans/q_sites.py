"""Queries: per-site records, listings and editions over a mixed landing table (O-X20, O-X21, O-X23).

The pages are the given documents, conversations and links, wrapped in the
markup of the harvested sites; the oracle reads those tables directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.operators import sites
from presslake.plans import sqlfrag as S
from presslake.plans.q_extract import _abs_sql
from presslake.plans.registry import query
from presslake.sources.tables import table

#: Sites by document number; the last place is a host that no spec knows.
ORDER = ["wp_cats", "counter_paged", "entry_paras", "td_post", "item_page", "styled_components", "edition_article",
         "book_detail", "book_http", "book_single", "wiki_title", "pdf_offer", "pdf_library", "unknown"]
HOSTS = {f"{s.replace('_', '-')}.example": s for s in ORDER[:-1]}


def esc(c):
    """Text as it is written in markup."""
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _esc_sql(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def site_pages(docs):
    """Documents (doc_id, text, lang, source) as pages of the sites; a tenth of
    them without a title."""
    lines = F.split("text", "\n", -1)
    paras = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<p>"), esc(x), F.lit("</p>"))), "")
    i = F.col("doc_id").cast("string")
    title = F.when(F.col("doc_id") % 10 != 3, F.concat(F.lit(" Story & "), i, F.lit(" ")))
    heading = lambda tag: F.coalesce(F.concat(F.lit(f"<{tag}>"), esc(title), F.lit(f"</{tag.split(' ')[0]}>")), F.lit(""))
    whom, lang = esc(F.coalesce("source", F.lit(""))), F.coalesce("lang", F.lit("xx"))
    c = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    html = {
        "wp_cats": c('<div class="the-post-meta"><span class="cats"><a>All</a><a> ', F.upper(lang), ' </a></span></div>', heading('h1 class="x post-title"'),
                     '<div class="post-content">', paras, '<div>no</div></div><span class="posted-by">by <span class="reviewer"> ', whom,
                     ' </span></span><span class="posted-on"><time> 2020-05-', i, ' </time></span><figure class="wp-block-image"><img src="https://h.example/wp-content/uploads/2020/05/', i, '.jpg?fit=1&amp;ssl=1"></figure>'),
        "counter_paged": c('<div class="w"><div>crumbs</div>', heading('div class="article-title"'), '</div><div class="info-bar"><span class="date"> ', i, ' mai </span></div><div class="article-body">', paras,
                           '</div><div class="article-tags"> ', lang, ', news </div>'),
        "entry_paras": c(heading('h1 class="post-title"'), '<div class="entry">', paras, '<div><p>nested</p></div></div>'),
        "td_post": c(heading('h1 class="tdb-title-text"'), '<div class="td-post-content">', paras, '<script>var x = "<p>";</script></div>'),
        "item_page": c('<div id="mytex_middle_content_component_div1"><h3> ', lang, ' </h3></div>', heading('h2 class="contentheading"'), '<dl class="article-info"><dd class="createdby"> ', whom,
                       ' <dd class="published"> 1 mai ', i, ' </dl><div class="item-page"><p class="img">drop</p>', paras, '</div>'),
        "styled_components": c('<div class="DefaultFormatShell__Meta-abc"><a class="HeadingLabel-x"> ', lang, ' </a></div>', heading('h1'), '<span class="common__Date-sc-dffrbw-2"> 3 iunie </span>',
                               '<div class="BodyStyler__GutenbergStyled-sc-ssx5r2-0 epAIFH">', paras, 'bare &amp; tail</div><div class="AuthorCard__Content-q"><strong> ', whom,
                               ' </strong></div><div class="DefaultArticleType__FeaturedImage-z"><img src="https://h.example/a/b/c/d/', i, '.jpg"></div>'),
        "edition_article": c(heading('h1'), '<div class="a_author"><span> ', whom, ' </span><span>editor</span></div><div class="txt_articol">', paras, '</div><img class="article_img" src="/img/x/', i, '.jpg">'),
        "book_detail": c(heading('h1'), F.when(title.isNotNull(), c('<p class="price_color">£', i, '.50</p>')).otherwise(F.lit("")), '<div id="product_gallery"><div><div><div><img src="../../media/', i, '.jpg"></div></div></div></div>',
                         '<div id="product_description"><h2>About</h2></div>', paras),
        "book_http": c(heading('h1'), paras), "book_single": c(heading('h1'), paras), "wiki_title": c(heading('h1'), paras),
        "pdf_offer": c('<div class="product-price-and-delivery"><div class="product-price">', F.when(title.isNotNull(), c('<a href="https://f.example/', i, '.pdf">free</a>')).otherwise(F.lit("soon")), '</div></div>', paras),
        "pdf_library": c('<div class="prod_desc_text"><a href="/no.pdf">no</a>', F.when(title.isNotNull(), c('<a target="_blank" href="/f/', i, '.pdf">pdf</a>')).otherwise(F.lit("")), paras, '</div>'),
        "unknown": paras,
    }
    names = F.array(*[F.lit(s.replace("_", "-")) for s in ORDER])
    at = F.get(names, (F.col("doc_id") % len(ORDER)).cast("int"))
    body = F.lit(None).cast("string")
    for k, s in reversed(list(enumerate(ORDER))):
        body = F.when(F.col("doc_id") % len(ORDER) == k, html[s]).otherwise(body)
    status = F.when(F.col("doc_id") % 17 == 5, 404).otherwise(200)
    return docs.select(F.col("doc_id").alias("page_id"), c("https://", at, ".example/a/", i).alias("url"), body.alias("html"), status.alias("status"))


def _site_sql() -> str:
    return "CASE doc_id % " + str(len(ORDER)) + " " + " ".join(f"WHEN {k} THEN '{s}'" for k, s in enumerate(ORDER)) + " END"


def _sentinel(field: str, value: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {S.lit(v[field])}" for k, v in sites.SENTINELS.items() if field in v)
    return f"coalesce({value}, CASE WHEN site <> 'unknown' THEN CASE site {whens} END END)"


def _case(**of: str) -> str:
    return "CASE " + " ".join(f"WHEN site IN ({', '.join(repr(s) for s in k.split('__and__'))}) THEN {v}" for k, v in of.items()) + " END"


_I = "CAST(doc_id AS VARCHAR)"
_ARTICLE = "site IN ('wp_cats', 'entry_paras', 'item_page', 'styled_components')"


@query("site_records", f"""
WITH d AS (SELECT doc_id, coalesce(lang, 'xx') AS lang, coalesce(source, '') AS whom, string_split(text, chr(10)) AS lines, {_site_sql()} AS site,
                  CASE WHEN doc_id % 10 <> 3 THEN 'Story & ' || CAST(doc_id AS VARCHAR) END AS t, doc_id % 17 = 5 AS bad FROM documents),
g AS (SELECT *, CASE WHEN site IN ('wp_cats', 'counter_paged', 'item_page', 'styled_components') THEN t
                     WHEN site IN ('entry_paras', 'td_post', 'edition_article', 'book_detail', 'book_http', 'book_single', 'wiki_title') THEN ' ' || t || ' ' END AS title FROM d),
r AS (SELECT *,
  CASE WHEN {_ARTICLE} THEN CASE WHEN site = 'styled_components' THEN list_append(lines, 'bare & tail') ELSE lines END END AS content,
  {_case(counter_paged__and__td_post="array_to_string(lines, '')")} AS content_text,
  {_case(wp_cats="lower(upper(lang))", item_page__and__styled_components="lang")} AS category,
  {_case(wp_cats="' ' || whom || ' '", item_page="' ' || whom || ' '", styled_components=S.strip("whom"), edition_article="' ' || whom || ' '")} AS author,
  {_case(wp_cats="'2020-05-' || " + _I, counter_paged=_I + " || ' mai'", item_page="'1 mai ' || " + _I, styled_components="'3 iunie'")} AS published_raw,
  {_case(counter_paged="lang || ', news'")} AS tags,
  {_case(wp_cats="'https://h.example/wp-content/uploads/2020/05/' || " + _I + " || '.jpg?fit=1&ssl=1'", styled_components="'https://h.example/a/b/c/d/' || " + _I + " || '.jpg'",
         edition_article="'https://edition-article.example/img/x/' || " + _I + " || '.jpg'", book_detail="'media/' || " + _I + " || '.jpg'")} AS image_url,
  {_case(wp_cats="'2020_05_' || " + _I + " || '.jpg'", styled_components="'c_d_' || " + _I + " || '.jpg'", edition_article=_I + " || '.jpg'")} AS image_file,
  {_case(edition_article="'<p>' || " + _esc_sql("lines[2]") + " || '</p>'")} AS text_html,
  {_case(book_detail="lines[1]")} AS description,
  CASE WHEN site = 'book_detail' AND t IS NOT NULL THEN {_I} || '.50' END AS price,
  CASE WHEN t IS NOT NULL THEN {_case(pdf_offer="'https://f.example/' || " + _I + " || '.pdf'", pdf_library="'https://pdf-library.example/f/' || " + _I + " || '.pdf'")} END AS download_url
  FROM g)
SELECT doc_id AS page_id, nullif(site, 'unknown') AS site,
       CASE WHEN bad THEN 'error' WHEN site = 'unknown' THEN 'unknown' WHEN site LIKE 'pdf%' AND download_url IS NULL THEN 'skipped' ELSE 'ok' END AS outcome,
       CASE WHEN bad THEN 404 END AS error,
       {", ".join(f"CASE WHEN NOT bad THEN {_sentinel(f, f)} END AS {f}" for f in ("title", "category", "author", "published_raw", "tags", "image_url", "image_file", "description"))},
       CASE WHEN NOT bad THEN CAST(len(content) AS INTEGER) END AS n_content, CASE WHEN NOT bad THEN md5(array_to_string(content, '|')) END AS content_md5,
       CASE WHEN NOT bad THEN md5({_sentinel("content_text", "content_text")}) END AS content_text_md5, CASE WHEN NOT bad THEN {_sentinel("text_html", "text_html")} END AS text_html,
       CASE WHEN NOT bad THEN price END AS price, CASE WHEN NOT bad THEN download_url END AS download_url
FROM r
""", op="O-X23 O-X17 O-P1 §2.3.1: 13 sites by host in one pass")
def q_site_records(spark, sf):
    got = sites.site_records(site_pages(table(spark, sf, "documents")), HOSTS)
    full = sites.render_sentinels(got)
    # a page that reports an error, and one without a spec, have no placeholders either
    fields = [c for c in got.columns if c not in ("page_id", "url", "site", "outcome", "error", "parse_error")]
    full = full.select("page_id", "site", "outcome", "error", *[F.when(F.col("outcome") != "error", F.col(c)).alias(c) for c in fields])
    return full.select("page_id", "site", "outcome", "error", "title", "category", "author", "published_raw", "tags", "image_url", "image_file", "description",
                       F.when(F.col("content").isNotNull(), F.size("content")).alias("n_content"), F.md5(F.array_join("content", "|")).alias("content_md5"),
                       F.md5("content_text").alias("content_text_md5"), "text_html", F.col("price").cast("string").alias("price"), "download_url")


@query("image_manifest", f"""
WITH d AS (SELECT doc_id, {_site_sql()} AS site FROM documents WHERE doc_id % 17 <> 5)
SELECT doc_id AS page_id, site,
       {_case(wp_cats="'https://h.example/wp-content/uploads/2020/05/' || " + _I + " || '.jpg?fit=1&ssl=1'", styled_components="'https://h.example/a/b/c/d/' || " + _I + " || '.jpg'",
              edition_article="'https://edition-article.example/img/x/' || " + _I + " || '.jpg'", book_detail="'media/' || " + _I + " || '.jpg'")} AS image_url,
       {_case(wp_cats="'2020_05_' || " + _I + " || '.jpg'", styled_components="'c_d_' || " + _I + " || '.jpg'", edition_article__and__book_detail=_I + " || '.jpg'")} AS image_file
FROM d WHERE site IN ('wp_cats', 'styled_components', 'edition_article', 'book_detail')
""", op="O-K6 O-P7: images of records, each once")
def q_image_manifest(spark, sf):
    got = sites.render_sentinels(sites.site_records(site_pages(table(spark, sf, "documents")), HOSTS))
    return sites.image_manifest(got.where("outcome <> 'error'"))


LISTED = ["wp_cats", "entry_paras", "td_post", "pdf_offer", "pdf_library", "unknown"]


def listing_markup(pages):
    """The links of the given pages as listing pages of the sites."""
    links = pages.select("page_id", H.hrefs(H.clean_html("html")).alias("h"))
    k = F.col("page_id") % len(LISTED)
    link = lambda before, after, rest="": F.array_join(F.transform("h", lambda x: F.concat(F.lit(f'{before}<a {rest}href="'), esc(x), F.lit(f'">t</a>{after}'))), "")
    n = F.concat(F.lit('<span class="pages">Page 1 of '), F.size("h").cast("string"), F.lit("</span>"))
    c = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    html = [c('<a href="/menu">m</a><div class="main-featured">', link('<h2 class="is-title post-title">', '</h2>'), '</div><div class="main-content"><h2><a href="/no">n</a></h2></div>'),
            c(link('<article class="item-list"><h2>', '</h2></article>'), n),
            c('<div class="td-category-pos-above"><a class="td-image-wrap" href="/top">top</a></div><div class="tdb-numbered-pagination">', link('<h3 class="entry-title">', '</h3>'), '</div>', n),
            c(link('', '', 'class="product-item-name" ')), c(link('<div class="book_box"><div class="book-description">', '</div></div>')), c(link('', ''))]
    body = F.lit(None).cast("string")
    for i, x in reversed(list(enumerate(html))):
        body = F.when(k == i, x).otherwise(body)
    names = F.array(*[F.lit(s.replace("_", "-")) for s in LISTED])
    return links.select("page_id", F.concat(F.lit("https://"), F.get(names, k.cast("int")), F.lit(".example/list/"), F.col("page_id").cast("string")).alias("url"), body.alias("html"))


@query("site_listings", f"""
WITH p AS (SELECT page_id, {S.hrefs(S.clean('html'))} AS h, CASE page_id % {len(LISTED)} {" ".join(f"WHEN {k} THEN '{s}'" for k, s in enumerate(LISTED))} END AS site FROM pages),
q AS (SELECT page_id, site, len(h) AS n, 'https://' || replace(site, '_', '-') || '.example/list/' || CAST(page_id AS VARCHAR) AS url,
             CASE WHEN site = 'unknown' THEN [] WHEN site = 'td_post' THEN list_prepend('/top', h) ELSE h END AS links FROM p),
l AS (SELECT page_id, url, u.pos - 1 AS pos, u.href FROM q, LATERAL (SELECT unnest(links) AS href, generate_subscripts(links, 1) AS pos) u),
a AS (SELECT page_id, pos, {_abs_sql('href', 'url')} AS link FROM l),
j AS (SELECT page_id, string_agg(link, ' ' ORDER BY pos) AS links, count(*) AS c FROM a GROUP BY page_id)
SELECT q.page_id, nullif(site, 'unknown') AS site,
       CAST(CASE site WHEN 'wp_cats' THEN 1440 WHEN 'pdf_offer' THEN 60 WHEN 'pdf_library' THEN 4 WHEN 'unknown' THEN 0 ELSE n END AS INTEGER) AS n_pages,
       CAST(coalesce(c, 0) AS INTEGER) AS n_links, coalesce(j.links, '') AS links
FROM q LEFT JOIN j USING (page_id)
""", op="O-X20 O-X13 O-X24: listing pages of five sites by host, unknown hosts visible")
def q_site_listings(spark, sf):
    got = sites.listing_records(listing_markup(table(spark, sf, "pages")), HOSTS)
    return got.select("page_id", "site", "n_pages", F.size("links").alias("n_links"), F.array_join("links", " ").alias("links"))


def edition_markup(turns):
    """Conversations as edition pages: a section per role (of system turns one
    without a title), a link per turn."""
    link = F.concat(F.lit('<h3><a href="/c/'), F.col("turn").cast("string"), F.lit('">'), esc(F.col("text")), F.lit("</a></h3><a>other</a>"))
    sections = turns.groupBy("conv_id", "role").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", link.alias("x")))), lambda s: s["x"]), "").alias("links"))
    head = F.when(F.col("role") != "system", F.concat(F.lit("<h2>"), "role", F.lit("</h2>"))).otherwise(F.lit(""))
    section = F.concat(F.lit('<div class="category_holder">'), head, "links", F.lit("</div>"))
    pages = sections.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("role", section.alias("x")))), lambda s: s["x"]), "").alias("body"))
    i = F.col("conv_id").cast("string")
    return pages.select(F.col("conv_id").alias("page_id"), F.concat(F.lit("https://ed.example/arhiva/"), i).alias("url"),
                        F.concat(F.lit('<div class="archive_index"><h1>Editia - '), i, F.lit(' - '), i, F.lit(' mai</h1></div><h3><a href="/x">outside</a></h3>'), "body").alias("html"))


@query("edition_sections", """
SELECT conv_id AS page_id, CAST(conv_id AS VARCHAR) || ' mai' AS publication_date,
       CAST(dense_rank() OVER (PARTITION BY conv_id ORDER BY role) - 1 AS INTEGER) AS section_pos,
       CASE WHEN role = 'system' THEN 'Default' ELSE role END AS section_title,
       CAST(row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS INTEGER) AS link_pos,
       'https://ed.example/c/' || CAST(turn AS VARCHAR) AS link, text AS link_text
FROM conversations
""", op="O-X21 O-J2: edition → section → link, parent fields carried down")
def q_edition_sections(spark, sf):
    return sites.edition_links(edition_markup(table(spark, sf, "conversations", spread_rows=False)))
