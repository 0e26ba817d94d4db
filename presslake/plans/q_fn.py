"""Queries: scalar functions O-F1..O-F22, one ``fn_<name>`` each (§2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.functions import text as T
from presslake.operators import urls as U
from presslake.operators.pagination import month_name
from presslake.plans import sqlfrag as S
from presslake.plans.registry import query
from presslake.sources.tables import table

_LINKS = f"""links AS (
  SELECT p.page_id, p.url, u.href, CAST(u.pos - 1 AS BIGINT) AS pos
  FROM pages p, LATERAL (SELECT unnest({S.hrefs(S.clean('p.html'))}) AS href,
                                generate_subscripts({S.hrefs(S.clean('p.html'))}, 1) AS pos) u)"""


def _pages(spark, sf):
    return table(spark, sf, "pages")


def _urls(spark, sf):
    # URL-only functions: no per-page heavy work, no need to spread the scan
    return table(spark, sf, "pages", spread_rows=False).select("page_id", "url")


def _links(spark, sf):
    p = _pages(spark, sf).select("page_id", "url", H.hrefs(H.clean_html("html")).alias("h"))
    from presslake.operators.extract import explode_items
    return explode_items(p, ["page_id", "url"], "h", "pos", "href").withColumn("pos", F.col("pos").cast("bigint"))


@query("fn_split_last", "SELECT page_id, string_split(url, '/')[-1] AS last_part FROM pages", op="O-F1")
def q_fn_split_last(spark, sf):
    return _urls(spark, sf).select("page_id", T.split_last("url", "/").alias("last_part"))


@query("fn_split_get", "SELECT page_id, string_split(url, '/')[5] AS part4 FROM pages", op="O-F2")
def q_fn_split_get(spark, sf):
    return _urls(spark, sf).select("page_id", T.split_get("url", "/", 4).alias("part4"))


@query("fn_path_join", """
SELECT page_id, CASE WHEN len(string_split(url, '/')) > 3 THEN array_to_string(string_split(url, '/')[4:], '_') ELSE '' END AS file_name
FROM pages
""", op="O-F3")
def q_fn_path_join(spark, sf):
    return _urls(spark, sf).select("page_id", T.path_tail_name("url", 3, strip_query=False).alias("file_name"))


@query("fn_strip_query", """
SELECT page_id, split_part(CASE WHEN len(string_split(url, '/')) > 3 THEN array_to_string(string_split(url, '/')[4:], '_') ELSE '' END, '?', 1) AS file_name
FROM pages
""", op="O-F4 Q9")
def q_fn_strip_query(spark, sf):
    return _urls(spark, sf).select("page_id", T.path_tail_name("url", 3, strip_query=True).alias("file_name"))


@query("fn_strip", f"""
SELECT conv_id, turn, {S.strip("chr(10) || chr(160) || '  ' || text || chr(8232) || chr(9) || ' '")} AS stripped,
       length({S.strip("chr(10) || chr(160) || '  ' || text || chr(8232) || chr(9) || ' '")}) = length({S.strip('text')}) AS same_len
FROM conversations
""", op="O-F5 Q10")
def q_fn_strip(spark, sf):
    c = table(spark, sf, "conversations")
    padded = F.concat(F.lit("\n   "), "text", F.lit(" \t "))
    return c.select("conv_id", "turn", T.py_strip(padded).alias("stripped"),
                    (F.length(T.py_strip(padded)) == F.length(T.py_strip("text"))).alias("same_len"))


@query("fn_strip_currency", """
SELECT o_orderkey, CAST(TRY_CAST(trim('£' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || '£', '£') AS DECIMAL(12, 2)) AS DOUBLE) AS price
FROM orders
""", op="O-F6")
def q_fn_strip_currency(spark, sf):
    o = table(spark, sf, "orders")
    txt = F.concat(F.lit("£"), F.floor("o_totalprice").cast("bigint").cast("string"), F.lit("£"))
    return o.select("o_orderkey", T.strip_chars(txt, "£").try_cast("decimal(12,2)").cast("double").alias("price"))


@query("fn_lower", "SELECT page_id, lower(url) AS url_lower FROM pages", op="O-F7")
def q_fn_lower(spark, sf):
    return _urls(spark, sf).select("page_id", F.lower("url").alias("url_lower"))


@query("fn_remove_prefix", f"""
WITH {_LINKS}
SELECT page_id, pos, CASE WHEN starts_with(href, '/t') THEN substring(href, 3) ELSE href END AS rest FROM links
""", op="O-F8")
def q_fn_remove_prefix(spark, sf):
    return _links(spark, sf).select("page_id", "pos", T.remove_prefix("href", "/t").alias("rest"))


@query("fn_startswith", f"""
WITH {_LINKS} SELECT page_id, pos, starts_with(href, '/th') AS is_archive FROM links
""", op="O-F9")
def q_fn_startswith(spark, sf):
    return _links(spark, sf).select("page_id", "pos", F.col("href").startswith("/th").alias("is_archive"))


@query("fn_format_url", f"""
SELECT page_id, printf('https://%s/page/%d', {S.host('url')}, page_id) AS listing_url FROM pages
""", op="O-F10")
def q_fn_format_url(spark, sf):
    from presslake.functions.urls import host
    return _urls(spark, sf).select("page_id", F.format_string("https://%s/page/%d", host("url"), "page_id").alias("listing_url"))


@query("fn_lpad", """
SELECT o_orderkey, lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS mm FROM orders
""", op="O-F11")
def q_fn_lpad(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.lpad(F.month("o_orderdate").cast("string"), 2, "0").alias("mm"))


@query("fn_try_int", f"""
SELECT page_id, TRY_CAST({S.strip("regexp_replace(string_split(url, '/')[-1], '[?#].*$', '')")} AS INTEGER) AS n,
       TRY_CAST({S.strip("string_split(url, '/')[-1]")} AS INTEGER) AS n_raw
FROM pages
""", op="O-F12")
def q_fn_try_int(spark, sf):
    last = T.split_last("url", "/")
    return _urls(spark, sf).select("page_id", T.try_int(F.regexp_replace(last, r"[?#].*$", "")).alias("n"),
                                    T.try_int(last).alias("n_raw"))


@query("fn_map_lookup", """
SELECT o_orderkey, CASE lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')
  WHEN '01' THEN 'ianuarie' WHEN '02' THEN 'februarie' WHEN '03' THEN 'martie' WHEN '04' THEN 'aprilie'
  WHEN '05' THEN 'mai' WHEN '06' THEN 'iunie' WHEN '07' THEN 'iulie' WHEN '08' THEN 'august'
  WHEN '09' THEN 'septembrie' WHEN '10' THEN 'octombrie' WHEN '11' THEN 'noiembrie' WHEN '12' THEN 'decembrie' END AS month_name
FROM orders
""", op="O-F13")
def q_fn_map_lookup(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", month_name(F.lpad(F.month("o_orderdate").cast("string"), 2, "0")).alias("month_name"))


@query("fn_array_join", f"""
SELECT page_id, array_to_string({S.hrefs(S.clean('html'))}, chr(10)) AS url_lines FROM pages
""", op="O-F15 O-K3")
def q_fn_array_join(spark, sf):
    return _pages(spark, sf).select("page_id", F.array_join(H.hrefs(H.clean_html("html")), "\n").alias("url_lines"))


@query("fn_len", f"""
SELECT page_id, CAST(len({S.hrefs(S.clean('html'))}) AS BIGINT) AS n_links,
       CAST(length({S.first_text(S.clean('html'), 'title')}) AS BIGINT) AS title_len FROM pages
""", op="O-F16")
def q_fn_len(spark, sf):
    c = H.clean_html("html")
    return _pages(spark, sf).select("page_id", F.size(H.hrefs(c)).cast("bigint").alias("n_links"),
                                    F.length(H.first_text(c, "title")).cast("bigint").alias("title_len"))


@query("fn_coalesce", f"""
SELECT page_id, coalesce({S.first_text(S.inner_first(S.clean('html'), 'footer'), 'h2')}, '[scrape] no title') AS subtitle FROM pages
""", op="O-F17 Q5")
def q_fn_coalesce(spark, sf):
    c = H.inner_first(H.clean_html("html"), "footer")
    return _pages(spark, sf).select("page_id", F.coalesce(H.first_text(c, "h2"), F.lit("[scrape] no title")).alias("subtitle"))


@query("fn_round", """
SELECT event_id, round(value / 3, 2) AS v3, CAST(floor(value) AS BIGINT) AS v_floor,
       user_id % 7 AS u_mod, user_id // 7 AS u_div FROM events
""", op="O-F19")
def q_fn_round(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.round(F.col("value") / 3, 2).alias("v3"), F.floor("value").cast("bigint").alias("v_floor"),
                     (F.col("user_id") % 7).alias("u_mod"), F.expr("user_id div 7").alias("u_div"))


@query("fn_strftime", """
SELECT event_id, strftime(ts, '%Y-%m-%d-%H:%M:%S') AS run_ts FROM events
""", op="O-F20 O-K2")
def q_fn_strftime(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.date_format("ts", "yyyy-MM-dd-HH:mm:ss").alias("run_ts"))


@query("fn_entity_decode", f"""
SELECT page_id, {S.decode(S.inner_first(S.clean('html'), 'footer'))} AS footer_text FROM pages
""", op="O-F21")
def q_fn_entity_decode(spark, sf):
    return _pages(spark, sf).select("page_id", T.decode_entities(H.inner_first(H.clean_html("html"), "footer")).alias("footer_text"))


@query("fn_title_preview", f"""
WITH {__import__('presslake.plans.q_urls', fromlist=['LATEST']).LATEST}
SELECT url, '[' || status || '] ' || substring(url, 1, 20) AS preview FROM latest
""", op="O-F22")
def q_fn_title_preview(spark, sf):
    lat = U.latest(U.url_events(table(spark, sf, "events")), "url", "seq", keep=["status"])
    return lat.select("url", F.concat(F.lit("["), "status", F.lit("] "), F.substring("url", 1, 20)).alias("preview"))


@query("fn_splitlines", """
SELECT conv_id, turn,
       CAST(CASE WHEN text = '' THEN 0 ELSE len(string_split_regex(
              regexp_replace(text, '(\\r\\n|[\\n\\r\\x{0b}\\x{0c}\\x{1c}\\x{1d}\\x{1e}\\x{85}\\x{2028}\\x{2029}])\\z', ''),
              '\\r\\n|[\\n\\r\\x{0b}\\x{0c}\\x{1c}\\x{1d}\\x{1e}\\x{85}\\x{2028}\\x{2029}]')) END AS BIGINT) AS n_lines
FROM conversations
""", op="O-S1 Q14")
def q_fn_splitlines(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", F.size(T.splitlines("text")).cast("bigint").alias("n_lines"))


@query("fn_status_domain", """
WITH s AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'done'
                                WHEN 'view' THEN 'new' ELSE upper(event_type) END AS raw FROM events)
SELECT event_id, raw, CASE WHEN upper(raw) IN ('NEW', 'ERR', 'OKK') THEN upper(raw)
                           WHEN lower(raw) = 'new' THEN 'NEW' WHEN lower(raw) = 'error' THEN 'ERR'
                           WHEN lower(raw) = 'done' THEN 'OKK' END AS status
FROM s
""", op="O-S7 status enum")
def q_fn_status_domain(spark, sf):
    ev = table(spark, sf, "events")
    raw = (F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "purchase", "done")
           .when(F.col("event_type") == "view", "new").otherwise(F.upper("event_type")))
    return ev.select("event_id", raw.alias("raw"), U.normalize_status(raw).alias("status"))
