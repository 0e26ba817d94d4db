"""Queries: structural selectors over the node table (§2.3 O-X3..O-X13, O-X17, O-J6, O-W4).

The Spark side shreds pages and evaluates selectors relationally; the DuckDB
oracle answers the same question from the markup with regular expressions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.functions.text import py_strip
from presslake.operators import nodes as N
from presslake.operators import selectors as SL
from presslake.operators.selectors import Sel
from presslake.plans import sqlfrag as S
from presslake.plans.registry import query
from presslake.sources.tables import table

_C = S.clean("html")
_BASE = f"""b AS (SELECT page_id, c, {S.inner_first('c', 'article')} AS art, {S.inner_first('c', 'nav')} AS nav
             FROM (SELECT page_id, {_C} AS c FROM pages))"""


def _cnt(x: str, pat: str) -> str:
    return f"CAST(len(regexp_extract_all(coalesce({x}, ''), {S.lit(pat)})) AS BIGINT)"


def _nodes(spark, sf, with_text: bool = True):
    return N.shred(table(spark, sf, "pages"), with_text=with_text)


def _counts(spark, sf, **sels):
    """Matches per page, zero for pages without: one pass, no shuffle."""
    return SL.count_matches(_nodes(spark, sf, with_text=False), sels, every_page=True)


@query("sel_descendant", f"""
WITH {_BASE}
SELECT page_id, {_cnt('art', '(?i)<p\\b')} AS n_p, {S.paragraphs('art')}[1] AS first_p FROM b
WHERE {_cnt('art', '(?i)<p\\b')} > 0
""", op="O-X5 O-J6 O-X1")
def q_sel_descendant(spark, sf):
    m = SL.select(_nodes(spark, sf), Sel.tag("article").descendant(Sel.tag("p")))
    return m.groupBy("page_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_p"),
                                    py_strip(F.min_by("text", "pre")).alias("first_p"))


@query("sel_nav_links", f"""
WITH {_BASE} SELECT page_id, {_cnt('nav', '(?i)<a\\b')} AS n_links FROM b
""", op="O-X5 (3-step chain)")
def q_sel_nav_links(spark, sf):
    return _counts(spark, sf, n_links=Sel.tag("nav").descendant(Sel.tag("li")).descendant(Sel.tag("a")))


@query("sel_child", f"""
WITH {_BASE} SELECT page_id, {_cnt('nav', '(?i)<li\\b')} AS n_li FROM b
""", op="O-X6")
def q_sel_child(spark, sf):
    return _counts(spark, sf, n_li=Sel.tag("nav").child(Sel.tag("ul")).child(Sel.tag("li")))


@query("sel_adjacent", f"""
WITH {_BASE}
SELECT page_id, {S.paragraphs('art')}[1] AS text FROM b WHERE regexp_matches(art, '(?is)</h1>\\s*<p\\b')
""", op="O-X7 O-W4")
def q_sel_adjacent(spark, sf):
    m = SL.select(_nodes(spark, sf), Sel.tag("h1").adjacent(Sel.tag("p")))
    return m.select("page_id", py_strip("text").alias("text"))


_LI = "regexp_extract_all(coalesce(nav, ''), '(?is)<li\\b[^>]*>(.*?)(?:</li>|\\z)', 1)"


@query("sel_nth_child", f"""
WITH {_BASE}
SELECT page_id, {S.strip(S.text_of(f'{_LI}[2]'))} AS text FROM b WHERE len({_LI}) >= 2
""", op="O-X8 O-W4")
def q_sel_nth_child(spark, sf):
    m = SL.select(_nodes(spark, sf), Sel.tag("li").nth_child(2))
    return m.select("page_id", py_strip("text").alias("text"))


@query("sel_last_child", f"""
WITH {_BASE}
SELECT page_id, {S.strip(S.text_of(f'{_LI}[-1]'))} AS text FROM b WHERE len({_LI}) >= 1
""", op="O-X9 O-W4")
def q_sel_last_child(spark, sf):
    m = SL.select(_nodes(spark, sf), Sel.tag("li").last_child().descendant(Sel.tag("a")))
    return m.select("page_id", py_strip("text").alias("text"))


@query("sel_is", f"""
WITH {_BASE}
SELECT page_id, {_cnt('art', '(?i)<h1\\b')} + {_cnt('art', '(?i)<p\\b')} AS n_blocks FROM b
""", op="O-X10 O-X6")
def q_sel_is(spark, sf):
    return _counts(spark, sf, n_blocks=Sel.tag("article").child(Sel.any().is_("h1", "p")))


@query("sel_not_attr", f"""
WITH {_BASE}
SELECT page_id, {_cnt('c', '(?i)<div\\b')} - {_cnt('c', '(?i)<div\\b[^>]*\\bclass=')} AS n_div_plain,
       {_cnt('art', '(?i)<p\\b')} - {_cnt('art', '(?i)<p\\b[^>]*\\bclass=')} AS n_p_plain
FROM b
""", op="O-X11")
def q_sel_not_attr(spark, sf):
    return _counts(spark, sf, n_div_plain=Sel.tag("div").without_attr("class"),
                   n_p_plain=Sel.tag("article").descendant(Sel.tag("p").without_attr("class")))


@query("sel_attr_prefix", f"""
WITH {_BASE} SELECT page_id, {_cnt('c', '<[aA]\\b[^>]*\\bhref="/t')} AS n_t_links FROM b
""", op="O-X12")
def q_sel_attr_prefix(spark, sf):
    return _counts(spark, sf, n_t_links=Sel.tag("a").attr_prefix("href", "/t"))


@query("sel_attr_equals", f"""
WITH {_BASE}
SELECT page_id, {S.strip(S.text_of(S.inner_first('c', 'div', '[^>]*\\bclass="ad"[^>]*')))} AS ad_text FROM b
WHERE regexp_matches(c, '(?is)<div\\b[^>]*\\bclass="ad"')
""", op="O-X12 O-X3")
def q_sel_attr_equals(spark, sf):
    m = SL.select(_nodes(spark, sf), Sel.tag("div").attr_equals("class", "ad"))
    return SL.first_per_page(m).select("page_id", py_strip("text").alias("ad_text"))


@query("sel_class", f"""
WITH {_BASE}
SELECT page_id, {S.strip(S.text_of(S.inner_first('c', 'div', '[^>]*\\bclass="ad"[^>]*')))} AS text FROM b
WHERE regexp_matches(c, '(?is)<div\\b[^>]*\\bclass="ad"')
""", op="O-X3")
def q_sel_class(spark, sf):
    m = SL.select(_nodes(spark, sf), Sel.tag("div", cls="ad"))
    return SL.first_per_page(m).select("page_id", py_strip("text").alias("text"))


@query("sel_list", f"""
WITH {_BASE} SELECT page_id, {_cnt('nav', '(?i)<a\\b')} + {_cnt('art', '(?i)<p\\b')} AS n_matches FROM b
""", op="O-X13")
def q_sel_list(spark, sf):
    m = SL.select_union(_nodes(spark, sf, with_text=False), Sel.tag("nav").descendant(Sel.tag("a")),
                        Sel.tag("article").descendant(Sel.tag("p")))
    every = table(spark, sf, "pages", spread_rows=False).select("page_id", F.lit(0).cast("bigint").alias("n"))
    return every.unionByName(m.select("page_id", F.lit(1).cast("bigint").alias("n"))).groupBy("page_id").agg(F.sum("n").alias("n_matches"))


@query("sel_title_node", f"SELECT page_id, {S.first_text(_C, 'title')} AS title FROM pages", op="O-X1 O-X2 two-path")
def q_sel_title_node(spark, sf):
    m = SL.select(_nodes(spark, sf), Sel.tag("title"))
    return SL.first_per_page(m).select("page_id", py_strip("text").alias("title"))


@query("children_text", f"""
WITH {_BASE}
SELECT page_id, {_cnt('art', '(?i)<h1\\b')} + {_cnt('art', '(?i)<p\\b')} AS n_children,
       array_to_string(list_concat(list_filter([{S.first_text('art', 'h1')}], lambda x: x IS NOT NULL), {S.paragraphs('art')}), '|') AS texts
FROM b WHERE art IS NOT NULL
""", op="O-X17 Q16")
def q_children_text(spark, sf):
    kids = SL.children_text(_nodes(spark, sf), Sel.tag("article"))
    ordered = F.sort_array(F.collect_list(F.struct("pre", py_strip("text").alias("text"))))
    return kids.groupBy("page_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_children"), F.array_join(F.transform(ordered, lambda x: x["text"]), "|").alias("texts"))


@query("node_inventory", f"""
WITH t AS (SELECT lower(unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
                                                  '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS tag FROM pages)
SELECT tag, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY tag
""", op="node shred")
def q_node_inventory(spark, sf):
    n = _nodes(spark, sf, with_text=False).where(F.col("kind") == "element")
    return n.groupBy("tag").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("sel_interval_join", f"""
WITH {_BASE}
SELECT page_id, {S.strip(S.text_of(f'{_LI}[1]'))} AS text FROM b WHERE len({_LI}) >= 1
""", op="O-J6 (links inside a positional ancestor)")
def q_sel_interval_join(spark, sf):
    m = SL.select(_nodes(spark, sf), Sel.tag("ul").child(Sel.tag("li").nth_child(1)).descendant(Sel.tag("a")))
    return m.select("page_id", py_strip("text").alias("text"))


# A spec for the landed test pages, evaluated like any site spec (node path).
GENERIC_SPEC = {
    "title": ("first", Sel.tag("title")),
    "headline": ("first", Sel.tag("article").child(Sel.tag("h1"))),
    "content": ("all", Sel.tag("article").child(Sel.tag("p"))),
    "lang": ("attr:lang", Sel.tag("html")),
    "first_link": ("attr:href", Sel.tag("nav").descendant(Sel.tag("a"))),
}


@query("spec_articles", f"""
WITH {_BASE},
p AS (SELECT page_id, c, art, nav, {S.paragraphs('art')} AS paras FROM b)
SELECT page_id,
       {S.first_text('c', 'title')} AS title,
       {S.first_text('art', 'h1')} AS headline,
       CAST(len(paras) AS BIGINT) AS n_paragraphs,
       CAST(list_sum(list_transform(paras, lambda x: length(x))) AS BIGINT) AS content_chars,
       {S.attr_first('c', 'html', 'lang')} AS lang,
       {S.hrefs('nav')}[1] AS first_link
FROM p
""", op="O-X23 O-Y1 (spec-driven, node path)")
def q_spec_articles(spark, sf):
    from presslake.operators import sites
    pages = table(spark, sf, "pages")
    a = sites.extract_with_spec(pages, N.shred(pages), GENERIC_SPEC)
    paras = F.transform("content", py_strip)
    return a.select("page_id", py_strip("title").alias("title"), py_strip("headline").alias("headline"),
                    F.size(paras).cast("bigint").alias("n_paragraphs"),
                    F.length(F.array_join(paras, "")).cast("bigint").alias("content_chars"),
                    "lang", "first_link")
