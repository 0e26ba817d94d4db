"""Queries: listing-page plans, pagination, editions, manifests (§2.1, §2.2, §2.3 O-X20..26)."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.functions.text import path_tail_name, split_last
from presslake.functions.urls import absolutize_all, absolutize_with, base_parts, host, normalize_url, scheme_host
from presslake.operators import extract as X
from presslake.operators import pagination as PG
from presslake.plans import sqlfrag as S
from presslake.plans.q_extract import _abs_sql
from presslake.plans.registry import query
from presslake.sources.tables import table

VALID_YEARS = range(1994, 1997)  # run parameter of editions_valid_year
EDITION_BASE = "https://press.example/editions"
COUNTER_PAGE_SIZE = 15


def _month_case(mm: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PG.MONTH_NAMES.items())
    return f"CASE {mm} {whens} END"


@query("page_url_range", f"""
WITH h AS (SELECT {S.scheme_host('url')} AS base, CAST(count(*) AS BIGINT) AS n FROM pages GROUP BY 1)
SELECT base, CAST(i AS BIGINT) AS page_no,
       CASE WHEN i = 1 THEN base ELSE base || '/page/' || CAST(i AS VARCHAR) END AS url
FROM h, range(1, n + 1) t(i)
""", op="O-S4 O-F10")
def q_page_url_range(spark, sf):
    p = table(spark, sf, "pages", spread_rows=False)
    h = p.groupBy(scheme_host("url").alias("base")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    e = h.withColumn("page_no", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    return e.select("base", "page_no", PG.page_url("base", "page_no").alias("url"))


@query("expand_pages", """
WITH c AS (SELECT conv_id, CAST(count(*) AS BIGINT) AS n FROM conversations GROUP BY conv_id)
SELECT conv_id, CAST(i AS BIGINT) AS page_no,
       'https://example.org/c/' || CAST(conv_id AS VARCHAR) || '/page/' || CAST(i AS VARCHAR) AS url
FROM c, range(2, n + 1) t(i)
""", op="O-S5 O-J8 Q3")
def q_expand_pages(spark, sf):
    c = table(spark, sf, "conversations", spread_rows=False).groupBy("conv_id").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    base = F.concat(F.lit("https://example.org/c/"), F.col("conv_id").cast("string"))
    e = PG.expand_pages(c, "n")
    return e.select("conv_id", "page_no", PG.page_url(base, "page_no").alias("url"))


@query("edition_calendar", f"""
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS year FROM orders),
m AS (SELECT year, lpad(CAST(i AS VARCHAR), 2, '0') AS mm FROM y, range(1, 13) t(i))
SELECT year, mm, {_month_case('mm')} AS month_name,
       '{EDITION_BASE}/nr-' || mm || '-' || {_month_case('mm')} || '-' || CAST(year AS VARCHAR) AS url
FROM m
""", op="O-S6 O-J7 O-F11 O-F13")
def q_edition_calendar(spark, sf):
    y = table(spark, sf, "orders").select(F.year("o_orderdate").cast("bigint").alias("year")).distinct()
    m = y.select("year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("i"))
    m = m.select("year", F.lpad(F.col("i").cast("string"), 2, "0").alias("mm"))
    name = PG.month_name("mm")
    return m.select("year", "mm", name.alias("month_name"),
                    F.concat(F.lit(EDITION_BASE + "/nr-"), "mm", F.lit("-"), name, F.lit("-"),
                             F.col("year").cast("string")).alias("url"))


@query("edition_date", f"""
WITH r AS (SELECT o_orderkey,
                  CAST(day(o_orderdate) AS VARCHAR) || ' ' || {_month_case("lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')")}
                  || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS raw FROM orders)
SELECT o_orderkey, raw,
       strftime(strptime(split_part(raw, ' ', 3) || '-' ||
         CASE split_part(raw, ' ', 2) {" ".join(f"WHEN '{v}' THEN '{k}'" for k, v in PG.MONTH_NAMES.items())} END
         || '-' || lpad(split_part(raw, ' ', 1), 2, '0'), '%Y-%m-%d'), '%Y-%m-%d') AS published
FROM r
""", op="O-X26")
def q_edition_date(spark, sf):
    o = table(spark, sf, "orders")
    raw = F.concat_ws(" ", F.dayofmonth("o_orderdate").cast("string"),
                      PG.month_name(F.lpad(F.month("o_orderdate").cast("string"), 2, "0")),
                      F.year("o_orderdate").cast("string"))
    r = o.select("o_orderkey", raw.alias("raw"))
    return r.select("o_orderkey", "raw", F.date_format(PG.romanian_date("raw"), "yyyy-MM-dd").alias("published"))


@query("editions_valid_year", f"""
WITH e AS (SELECT o_orderkey, 'Editia ' || o_orderpriority || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS label FROM orders)
SELECT o_orderkey, label FROM e
WHERE string_split(label, ' ')[-1] IN ({", ".join(f"'{y}'" for y in VALID_YEARS)})
""", op="O-X22 O-P4 O-Y3 O-F1")
def q_editions_valid_year(spark, sf):
    o = table(spark, sf, "orders")
    e = o.select("o_orderkey", F.concat(F.lit("Editia "), "o_orderpriority", F.lit(" "),
                                        F.year("o_orderdate").cast("string")).alias("label"))
    return e.where(PG.valid_year_label("label", VALID_YEARS))


@query("page_count_parse", f"""
WITH p AS (SELECT page_id, {S.hrefs(S.clean('html'))} AS h, {S.first_text(S.clean('html'), 'title')} AS title FROM pages)
SELECT page_id, coalesce(TRY_CAST(string_split('Page 1 of ' || CAST(len(h) AS VARCHAR), ' ')[-1] AS INTEGER), 0) AS n_pages,
       coalesce(TRY_CAST(string_split(coalesce(title, ''), ' ')[-1] AS INTEGER), 0) AS n_pages_bad_label
FROM p
""", op="O-X24 O-F12 Q2")
def q_page_count_parse(spark, sf):
    p = table(spark, sf, "pages").select("page_id", H.hrefs(H.clean_html("html")).alias("h"),
                                          H.first_text(H.clean_html("html"), "title").alias("title"))
    label = F.concat(F.lit("Page 1 of "), F.size("h").cast("string"))
    return p.select("page_id", PG.page_count(label).alias("n_pages"),
                    PG.page_count("title").alias("n_pages_bad_label"))


@query("is_last_page", f"""
WITH c AS (SELECT conv_id, turn, text, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
t AS (SELECT conv_id, turn, text,
             'Afisare stiri de la ' || CAST(turn * {COUNTER_PAGE_SIZE} + 1 AS VARCHAR) || ' la '
             || CAST(least((turn + 1) * {COUNTER_PAGE_SIZE}, n * {COUNTER_PAGE_SIZE} - 7) AS VARCHAR)
             || ' din ' || CAST(n * {COUNTER_PAGE_SIZE} - 7 AS VARCHAR) AS counter FROM c)
SELECT conv_id, turn, counter,
       coalesce(TRY_CAST(string_split(counter, ' ')[7] AS INTEGER) < TRY_CAST(string_split(counter, ' ')[9] AS INTEGER), false) AS has_next,
       coalesce(TRY_CAST(string_split(text, ' ')[7] AS INTEGER) < TRY_CAST(string_split(text, ' ')[9] AS INTEGER), false) AS has_next_raw
FROM t
""", op="O-X25 O-P10 Q17")
def q_is_last_page(spark, sf):
    c = table(spark, sf, "conversations", spread_rows=False)
    n = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    t = c.join(n, "conv_id")
    k = COUNTER_PAGE_SIZE
    counter = F.concat(F.lit("Afisare stiri de la "), (F.col("turn") * k + 1).cast("string"), F.lit(" la "),
                       F.least((F.col("turn") + 1) * k, F.col("n") * k - 7).cast("string"), F.lit(" din "),
                       (F.col("n") * k - 7).cast("string"))
    t = t.withColumn("counter", counter)
    return t.select("conv_id", "turn", "counter", PG.has_next_page("counter").alias("has_next"),
                    PG.has_next_page("text").alias("has_next_raw"))


@query("follow_next", """
WITH RECURSIVE walk(conv_id, turn, depth) AS (
  SELECT conv_id, turn, 0 FROM conversations WHERE turn = 0
  UNION ALL
  SELECT w.conv_id, c.turn, w.depth + 1 FROM walk w
  JOIN conversations c ON c.conv_id = w.conv_id AND c.turn = w.turn + 1)
SELECT conv_id, CAST(max(depth) AS BIGINT) AS last_depth, CAST(count(*) AS BIGINT) AS n_visited
FROM walk GROUP BY conv_id
""", op="O-T1")
def q_follow_next(spark, sf):
    c = table(spark, sf, "conversations", spread_rows=False)
    # the "next" link into every existing turn, from the turn before it
    edges = c.where(F.col("turn") >= 1).select(F.col("conv_id").alias("src_key"), (F.col("turn") - 1).alias("src"),
                                               F.col("turn").alias("dst"))
    start = c.where(F.col("turn") == 0).select(F.col("conv_id").alias("src_key"), F.col("turn").alias("src"))
    w = PG.follow_next(edges, start)
    return w.groupBy(F.col("src_key").alias("conv_id")).agg(
        F.max("depth").cast("bigint").alias("last_depth"), F.count(F.lit(1)).cast("bigint").alias("n_visited"))


_LINKS = f"""links AS (
  SELECT p.page_id, p.url, {S.attr_first(S.clean('p.html'), 'html', 'lang')} AS lang, u.href, CAST(u.pos - 1 AS BIGINT) AS pos
  FROM pages p, LATERAL (SELECT unnest({S.hrefs(S.clean('p.html'))}) AS href,
                                generate_subscripts({S.hrefs(S.clean('p.html'))}, 1) AS pos) u)"""


@query("section_links", f"""
WITH {_LINKS}
SELECT lang AS section_title, {S.host('url')} AS edition, page_id, pos AS link_pos, href FROM links
""", op="O-X21 O-J2")
def q_section_links(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url", H.clean_html("html").alias("c"))
    # sections (here: the page language) → links, parent columns carried down
    s = X.explode_items(p.select("page_id", host("url").alias("edition"), H.html_lang("c").alias("section_title"),
                                 H.hrefs("c").alias("_h")),
                        ["page_id", "edition", "section_title"], "_h", "link_pos", "href")
    return s.select("section_title", "edition", "page_id", F.col("link_pos").cast("bigint").alias("link_pos"), "href")


# Site specs as data: which element scopes the listing links, per site key.
LISTING_SPECS = [("com", "nav"), ("net", "nav"), ("org", "article")]


@query("listing_links", f"""
WITH spec(site_key, scope) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in LISTING_SPECS)}),
p AS (SELECT page_id, url, {S.clean('html')} AS c, regexp_extract({S.host('url')}, '\\.([a-z]+)$', 1) AS site_key FROM pages),
s AS (SELECT p.page_id, p.url, p.site_key,
             CASE spec.scope WHEN 'nav' THEN {S.inner_first('p.c', 'nav')} ELSE {S.inner_first('p.c', 'article')} END AS scope_html
      FROM p JOIN spec ON p.site_key = spec.site_key),
l AS (SELECT page_id, url, site_key, u.href, CAST(u.pos - 1 AS BIGINT) AS pos
      FROM s, LATERAL (SELECT unnest({S.hrefs('coalesce(scope_html, \'\')')}) AS href,
                              generate_subscripts({S.hrefs('coalesce(scope_html, \'\')')}, 1) AS pos) u)
SELECT page_id, site_key, pos, {_abs_sql('href', 'url')} AS link FROM l
""", op="O-X20 O-Y2 O-J8")
def q_listing_links(spark, sf):
    spec = spark.createDataFrame(LISTING_SPECS, "site_key string, scope string")
    p = table(spark, sf, "pages").select("page_id", "url", H.clean_html("html").alias("c"),
                                          F.regexp_extract(host("url"), r"\.([a-z]+)$", 1).alias("site_key"))
    # the spec table is a fixed handful of rows: broadcast of proven size
    s = p.join(F.broadcast(spec), "site_key")
    scope = F.when(F.col("scope") == "nav", H.inner_first("c", "nav")).otherwise(H.inner_first("c", "article"))
    s = X.explode_items(s.select("page_id", base_parts("url").alias("_base"), "site_key",
                                 H.hrefs(F.coalesce(scope, F.lit(""))).alias("_h")),
                        ["page_id", "_base", "site_key"], "_h", "pos", "href")
    return s.select("page_id", "site_key", F.col("pos").cast("bigint").alias("pos"),
                    absolutize_with("href", "_base").alias("link"))


@query("asset_manifest", f"""
WITH {_LINKS},
a AS (SELECT page_id, {_abs_sql('href', 'url')} AS asset_url FROM links)
SELECT page_id, asset_url,
       split_part(CASE WHEN len(string_split(asset_url, '/')) > 3
                       THEN array_to_string(string_split(asset_url, '/')[4:], '_') ELSE '' END, '?', 1) AS file_name
FROM a
WHERE asset_url IS NOT NULL
""", op="O-K6 O-P7 O-F3 O-F4 Q9")
def q_asset_manifest(spark, sf):
    links = X.page_links(table(spark, sf, "pages"), absolute=True)
    m = links.select("page_id", F.col("abs_url").alias("asset_url"))
    return m.where(F.col("asset_url").isNotNull()).withColumn("file_name", path_tail_name("asset_url", 3))


# Detail pages of pdf_manifest: the target of a listing link has a download
# link, unless the link's length is a multiple of three (no page landed).
@query("pdf_manifest", f"""
WITH {_LINKS},
l AS (SELECT page_id, pos, lang, {_abs_sql('href', 'url')} AS link FROM links),
d AS (SELECT link AS detail_url, min(lang) AS lang FROM l WHERE length(link) % 3 <> 0 GROUP BY link)
SELECT l.page_id, l.pos, l.link AS detail_url, d.detail_url IS NULL AS skipped,
       CASE WHEN d.detail_url IS NOT NULL THEN {S.scheme_host('l.link')} || '/files/' || string_split(l.link, '/')[-1] || '.pdf?v=1&lang=' || d.lang END AS pdf_url,
       CASE WHEN d.detail_url IS NOT NULL THEN string_split(l.link, '/')[-1] || '.pdf' END AS file_name
FROM l LEFT JOIN d ON l.link = d.detail_url
""", op="O-K7 O-J5")
def q_pdf_manifest(spark, sf):
    pages = table(spark, sf, "pages")
    lang = pages.select("page_id", "url", H.html_lang(H.clean_html("html")).alias("lang"), H.hrefs(H.clean_html("html")).alias("_h"))
    listing = X.explode_items(lang.withColumn("_base", base_parts("url")), ["page_id", "lang", "_base"], "_h", "pos", "href").select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "lang", absolutize_with("href", "_base").alias("detail_url"))
    # the landed detail pages, derived from the listing: each shows one download link
    name = split_last("detail_url", "/")
    landed = (listing.where(F.length("detail_url") % 3 != 0).groupBy("detail_url").agg(F.min("lang").alias("lang"))
              .select(F.concat("detail_url", F.lit("/")).alias("url"), F.concat(F.lit('<h1>'), name, F.lit('</h1><a class="dl" href="../files/'), name,
                                                            F.lit(".pdf?v=1&amp;lang="), "lang", F.lit('">PDF</a>')).alias("html")))
    return X.download_manifest(listing.drop("lang"), landed)


@query("url_normalize", f"""
WITH u AS (SELECT page_id, v, regexp_replace({S.strip('v')}, '#.*$', '') AS s
           FROM (SELECT page_id, url AS v FROM pages
                 UNION ALL SELECT page_id, upper({S.scheme_host('url')}) || '//' || substring(url, length({S.scheme_host('url')}) + 2) || '/' FROM pages)),
p AS (SELECT page_id, v, s, {S.scheme_host('s')} AS sh FROM u),
q AS (SELECT page_id, v, sh, substring(s, length(sh) + 1) AS rest FROM p),
r AS (SELECT page_id, v, sh, regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '/{{2,}}', '/', 'g') AS path,
             regexp_extract(rest, '(\\?.*)$', 1) AS query FROM q),
t AS (SELECT page_id, v, sh, query, regexp_replace(path, '(.)/$', '\\1') AS path FROM r)
SELECT page_id, v AS raw, lower(sh) || CASE WHEN path = '/' THEN '' ELSE path END || query AS url_key FROM t
""", op="O-F14 Q20")
def q_url_normalize(spark, sf):
    p = table(spark, sf, "pages", spread_rows=False)
    sh = scheme_host("url")
    doubled = F.concat(F.upper(sh), F.lit("//"), F.substr(F.col("url"), F.length(sh) + 2), F.lit("/"))
    u = p.select("page_id", F.col("url").alias("raw")).unionByName(p.select("page_id", doubled.alias("raw")))
    return u.select("page_id", "raw", normalize_url("raw").alias("url_key"))


_HARVEST_SQL = f"""
WITH {_LINKS},
u AS (SELECT url, page_id, -1 AS pos FROM pages
      UNION ALL SELECT {_abs_sql('href', 'url')} AS url, page_id, pos FROM links),
n AS (SELECT url, page_id, pos, {S.normalize_url('url')} AS url_key FROM u),
f AS (SELECT url_key, url FROM n QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY page_id, pos) = 1),
p AS (SELECT {S.normalize_url('url')} AS url_key, max(page_id) AS page_id, arg_max(html, page_id) AS html FROM pages GROUP BY 1),
j AS (SELECT f.url, p.page_id,
             {S.first_text(S.inner_first(S.clean('p.html'), 'article'), 'h1')} AS title
      FROM f LEFT JOIN p ON f.url_key = p.url_key)
SELECT {S.host('url')} AS site, CAST(count(*) AS BIGINT) AS n_urls,
       CAST(count(page_id) AS BIGINT) AS n_ok, CAST(0 AS BIGINT) AS n_error, CAST(count(*) - count(page_id) AS BIGINT) AS n_lost,
       CAST(count(*) FILTER (WHERE page_id IS NOT NULL AND title IS NOT NULL) AS BIGINT) AS n_with_title
FROM j GROUP BY 1
"""


@query("harvest_run", _HARVEST_SQL, op="§3.1 article harvest: O-S1 O-W1 O-J1 O-X23 O-P1 O-A8 Q8")
def q_harvest_run(spark, sf):
    from presslake.operators.harvest import harvest, harvest_report
    pages = table(spark, sf, "pages")
    # one pass: each page's own URL, then its links in order (order = (page_id, pos))
    found = pages.select("page_id", "url", base_parts("url").alias("_base"), H.hrefs(H.clean_html("html")).alias("_h"))
    urls = found.select("page_id", F.posexplode(F.concat(F.array("url"), absolutize_all("_h", "_base"))).alias("k", "url"))
    return harvest_report(harvest(urls.select("url", F.struct("page_id", "k").alias("pos")), pages))


_STATUS_SQL = "CASE WHEN page_id % 7 = 3 THEN 404 WHEN page_id % 11 = 5 THEN NULL ELSE 200 END"


@query("harvest_outcomes", f"""
WITH {_LINKS},
landed AS (
  SELECT page_id, url, CAST({_STATUS_SQL} AS INTEGER) AS status, html FROM pages
  UNION ALL
  SELECT page_id + 1000000000, url || '/', 200, html FROM pages
  WHERE page_id % 5 = 0 AND NOT contains(url, '?') AND NOT contains(url, '#') AND url NOT LIKE '%/'),
p AS (SELECT {S.normalize_url('url')} AS url_key, max(page_id) AS page_id, arg_max(coalesce(status, 200), page_id) AS status,
             arg_max(html, page_id) AS html FROM landed GROUP BY 1),
u AS (SELECT url, page_id, -1 AS pos FROM pages
      UNION ALL SELECT {_abs_sql('href', 'url')} AS url, page_id, pos FROM links),
n AS (SELECT url, page_id, pos, {S.normalize_url('url')} AS url_key FROM u),
f AS (SELECT url_key, url FROM n QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY page_id, pos) = 1)
SELECT f.url, p.page_id, p.status,
       CASE WHEN p.page_id IS NULL THEN 'lost' WHEN p.status = 200 THEN 'ok' ELSE 'error' END AS outcome,
       CASE WHEN p.status = 200 THEN {S.first_text(S.inner_first(S.clean('p.html'), 'article'), 'h1')} END AS title,
       CASE WHEN p.status = 200 THEN CAST(len({S.paragraphs(S.inner_first(S.clean('p.html'), 'article'))}) AS BIGINT) END AS n_paragraphs
FROM f LEFT JOIN p ON f.url_key = p.url_key
""", op="O-P1 O-J1 O-T8 Q8: status missing, error pages, repeated pages, links without a page")
def q_harvest_outcomes(spark, sf):
    from presslake.operators.harvest import harvest
    pages = table(spark, sf, "pages")
    status = F.when(F.col("page_id") % 7 == 3, 404).when(F.col("page_id") % 11 == 5, F.lit(None).cast("int")).otherwise(200)
    again = pages.where((F.col("page_id") % 5 == 0) & ~F.col("url").contains("?") & ~F.col("url").contains("#") & ~F.col("url").endswith("/"))
    landed = pages.select("page_id", "url", status.alias("status"), "html").unionByName(
        again.select((F.col("page_id") + 1_000_000_000).alias("page_id"), F.concat("url", F.lit("/")).alias("url"), F.lit(200).alias("status"), "html"))
    found = pages.select("page_id", "url", base_parts("url").alias("_base"), H.hrefs(H.clean_html("html")).alias("_h"))
    urls = found.select("page_id", F.posexplode(F.concat(F.array("url"), absolutize_all("_h", "_base"))).alias("k", "url"))
    got = harvest(urls.select("url", F.struct("page_id", "k").alias("pos")), landed)
    return got.select("url", "page_id", "status", "outcome", "title", F.when(F.col("content").isNotNull(), F.size("content").cast("bigint")).alias("n_paragraphs"))


# Listing pages of listing_harvest: the pages of a site in page_id order are the
# pages 1, 2, ... of its listing; the counter of each names one page more, which did not land.
@query("listing_harvest", f"""
WITH t AS (SELECT page_id, {S.scheme_host('url')} AS base, html,
                  row_number() OVER (PARTITION BY {S.scheme_host('url')} ORDER BY page_id) AS k, count(*) OVER (PARTITION BY {S.scheme_host('url')}) AS n FROM pages),
seeds AS (SELECT DISTINCT base AS seed_url, n FROM t),
listing AS (SELECT s.seed_url, i AS page_no FROM seeds s, range(1, s.n + 2) r(i)),
got AS (SELECT g.seed_url, g.page_no, l.page_id, {S.hrefs(S.clean('l.html'))} AS h
        FROM listing g LEFT JOIN t l ON l.base = g.seed_url AND l.k = g.page_no),
links AS (SELECT seed_url, page_no, u.pos, u.href FROM got,
          LATERAL (SELECT unnest(h) AS href, generate_subscripts(h, 1) - 1 AS pos) u WHERE page_id IS NOT NULL),
firsts AS (SELECT seed_url, page_no, pos, seed_url || href AS link FROM links
           QUALIFY row_number() OVER (PARTITION BY seed_url, href ORDER BY page_no, pos) = 1)
SELECT seed_url, CAST(page_no AS BIGINT) AS page_no, CAST(pos AS INTEGER) AS pos, link FROM firsts
UNION ALL SELECT seed_url, CAST(page_no AS BIGINT), NULL, NULL FROM got WHERE page_id IS NULL
""", op="§3.2 listing harvest: O-X24 O-S5 O-J1 O-X14 O-X15 O-U1 O-W1 Q1 Q2")
def q_listing_harvest(spark, sf):
    from presslake.operators.harvest import listing_harvest
    from presslake.operators.windows import dense_index
    from presslake.session import stage
    ids = table(spark, sf, "pages", spread_rows=False).select("page_id", scheme_host("url").alias("base"))
    placed = stage(dense_index(ids, "page_id", ["base"], out="k", total_col="n").select(F.col("page_id").alias("_id"), "base", (F.col("k") + 1).alias("k"), "n"), "placed")
    p = table(spark, sf, "pages")
    counter = F.concat(F.lit('<span class="pages">Page '), F.col("k").cast("string"), F.lit(" of "), (F.col("n") + 1).cast("string"), F.lit("</span>"))
    landed = p.join(placed, p["page_id"] == placed["_id"]).select("page_id", PG.page_url("base", "k").alias("url"), F.concat(counter, "html").alias("html"))
    return listing_harvest(placed.select(F.col("base").alias("url")).distinct(), landed)
