"""The node path: linear in the page, one automaton for all selectors."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL, pages_df
from presslake.operators import nodes as N
from presslake.operators import selectors as SL
from presslake.operators.selectors import Sel
from presslake.sources.tables import table


@pytest.mark.parametrize("n", [1000, 4000, 16000])
def test_rows_and_text_are_linear_in_open_elements(n):
    cols = [[] for _ in N._COLS]
    N._shred_one(1, "<b>x" * n, cols)
    assert len(cols[0]) == 2 * n
    assert sum(len(t or "") for t in cols[N._COLS.index("text")]) == n


def test_a_megabyte_of_unclosed_elements(spark):
    html = "<b>" * 350_000 + "<p>deep</p>" + "</i>" * 1000 + "<table>" + "<p><i>" * 2000
    t0 = time.time()
    got = SL.select(N.shred(pages_df(spark, html)), Sel.tag("b").descendant(Sel.tag("p"))).limit(1).collect()
    assert got[0].text == "deep" and time.time() - t0 < 60
    counts = SL.count_matches(N.shred(pages_df(spark, html), with_text=False), {"b": Sel.tag("b"), "chain": Sel.tag("b").child(Sel.tag("b"))}).first()
    assert (counts.b, counts.chain) == (350_000, 349_999)


@pytest.mark.parametrize("html", ["<p><table>" + "<b>" * 20_000 + "<div>" * 20_000, "<li><ul>" + "<i>" * 20_000 + "<li>" * 20_000, "<b>" * 20_000 + "</x>" * 20_000, "a< " * 50_000])
def test_scope_searches_do_not_scan_the_stack(html):
    t0 = time.time()
    N.read_page(html)
    assert time.time() - t0 < 5


@pytest.mark.parametrize("name", ["sel_adjacent", "sel_nth_child", "sel_last_child", "sel_interval_join", "sel_child", "sel_not_attr", "spec_articles"])
def test_no_exchange_of_node_rows(spark, name):
    import __spark_entry__ as E
    plan = E.queries()[name](spark, SF_MID)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Window" not in plan and "Join" not in plan
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


def naive(html, sel):
    """Matches by trying every way to lay a chain over a node's relatives."""
    n = N.read_page(html)

    def fits(c, i):
        a = n.attrs[i]
        return (n.tag[i] is not None and (not c.tag or n.tag[i] == c.tag) and (not c.tags_in or n.tag[i] in c.tags_in)
                and (not c.id or a.get("id") == c.id) and all(k in (a.get("class") or "").split() for k in c.classes)
                and all(a.get(k) == v for k, v in c.attr_eq) and all(k in a and a[k].startswith(v) for k, v in c.attr_prefix)
                and all(k in a for k in c.has_attr) and not any(k in a for k in c.lacks_attr)
                and (c.nth is None or [k for k in siblings(i)].index(i) + 1 == c.nth) and (not c.last or list(siblings(i))[-1] == i))

    def siblings(i):
        return [k for k in range(len(n.tag)) if n.parent[k] == n.parent[i] and n.tag[k] is not None]

    def ends(steps, i):
        comb, c = steps[-1]
        if not fits(c, i):
            return False
        if len(steps) == 1:
            return True
        if comb == "+":
            at = siblings(i).index(i)
            return at > 0 and ends(steps[:-1], siblings(i)[at - 1])
        p = n.parent[i]
        while p >= 0:
            if ends(steps[:-1], p):
                return True
            if comb == ">":
                return False
            p = n.parent[p]
        return False
    return [i for i in range(len(n.tag)) if n.tag[i] is not None and ends(list(sel.steps), i)]


def test_automaton_equals_the_naive_reading():
    rng = random.Random(3)
    for _ in range(300):
        html = "".join(rng.choice(["<div>", "<p>", "<b class='k x'>", "<b id=i>", "</b>", "</div>", "t", "<ul><li>", "</li>", "<br>", "<a href='/t'>", "</a>"]) for _ in range(rng.randrange(1, 40)))
        sels = []
        for _ in range(4):
            sel = None
            for _ in range(rng.randrange(1, 5)):
                c = rng.choice([Sel.tag("div"), Sel.tag("b"), Sel.any(), Sel.tag("p"), Sel.any().is_("li", "b"), Sel.tag("b", cls="k"), Sel.tag("b", id="i"), Sel.any().attr_prefix("href", "/"), Sel.any().without_attr("class"), Sel.any().nth_child(2), Sel.any().last_child(), Sel.any().with_attr("id")])
                sel = c if sel is None else rng.choice([sel.descendant, sel.child, sel.adjacent])(c)
            sels.append(sel)
        got = N.Program([SL.plain(s) for s in sels]).run(N.read_page(html))
        assert got == [naive(html, s) for s in sels], (html, sels)


def test_stored_node_table_gives_the_same_matches(spark, scratch):
    pages = table(spark, SF_SMALL, "pages")
    stored = N.materialize_nodes(pages, os.path.join(scratch, "nodes"))
    for sel in (Sel.tag("article").descendant(Sel.tag("p")), Sel.tag("li").last_child().descendant(Sel.tag("a")), Sel.tag("h1").adjacent(Sel.tag("p"))):
        a, b = ([tuple(r) for r in SL.select(t, sel).select("page_id", "pre", "text", "own_text", "sib", "is_last").orderBy("page_id", "pre").collect()] for t in (N.shred(pages), stored))
        assert a == b and a
    assert SL.children_text(stored, Sel.tag("article")).count() == SL.children_text(N.shred(pages), Sel.tag("article")).count()


def test_interval_join_on_the_node_table(spark):
    pages = table(spark, SF_SMALL, "pages")
    nodes = N.shred(pages)
    inside = SL.contained_in(nodes.where("tag = 'article'"), nodes.where("tag = 'p'"))
    assert inside.count() == SL.select(N.shred(pages), Sel.tag("article").descendant(Sel.tag("p"))).count()
    direct = SL.contained_in(nodes.where("tag = 'nav'"), nodes.where("kind = 'element'"), direct=True)
    assert direct.count() == SL.select(N.shred(pages), Sel.tag("nav").child(Sel.any())).count()


def test_text_of_the_page_is_the_text_nodes(spark):
    html = "<div>a<b>b</b>c<script>no</script></div>d"
    rows = N.shred(pages_df(spark, html)).orderBy("pre").collect()
    text = "".join(r.text for r in rows if r.kind == "text")
    assert text == "abcd"
    div = next(r for r in rows if r.tag == "div")
    assert text[div.text_start:div.text_end] == "abc"
    got = SL.select(N.shred(pages_df(spark, html)), Sel.tag("div")).first()
    assert (got.text, got.own_text) == ("abc", "ac")


def test_null_html_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, None), (2, "")], "page_id long, html string")
    assert SL.select(N.shred(pages), Sel.tag("p")).count() == 0
    assert [tuple(r) for r in SL.count_matches(N.shred(pages), {"p": Sel.tag("p")}, every_page=True).orderBy("page_id").collect()] == [(1, 0), (2, 0)]
    assert N.shred(pages.limit(0)).select(F.count("*")).first()[0] == 0
