"""Every per-site spec (§2.3.1) on a hand-written page of that site's shape."""

import pytest

from conftest import SF_SMALL, pages_df
from presslake.operators import nodes as N
from presslake.operators import sites

PAGES = {
    "counter_paged": (
        '<div class="wrap"><div class="x">crumbs</div><div class="article-title">Titlu</div></div>'
        '<div class="info-bar"><span class="date">12.03.2021</span></div>'
        '<div class="article-body"><p>Unu.</p><p>Doi.</p></div><div class="article-tags">a, b</div>',
        {"title": "Titlu", "content_text": "Unu.Doi.", "published_raw": "12.03.2021", "tags": "a, b"}),
    "entry_paras": (
        '<h1 class="post-title">Editorial</h1><div class="entry"><p>P1</p><div><p>nested</p></div><p>P2</p></div>',
        {"title": "Editorial", "content": ["P1", "P2"]}),
    "td_post": (
        '<h1 class="tdb-title-text">Stire</h1><div class="td-post-content"><p>A</p> <p>B</p></div>',
        {"title": "Stire", "content_text": "A B"}),
    "item_page": (
        '<div id="mytex_middle_content_component_div1"><h3> Local </h3></div><h2 class="contentheading"> T </h2>'
        '<dl class="article-info"><dd class="createdby"> Ion </dd><dd class="published"> 1 mai 2020 </dd></dl>'
        '<div class="item-page"><p>keep</p><p class="img">drop</p><div><p>deep</p></div></div>',
        {"category": "Local", "title": "T", "author": " Ion ", "published_raw": "1 mai 2020",
         "content": ["keep", "deep"]}),
    "styled_components": (
        '<div class="DefaultFormatShell__Meta-abc"><a class="HeadingLabel-x" href="/c">Politic</a></div>'
        '<h1>Ancheta</h1><span class="common__Date-sc-dffrbw-2">3 iunie</span>'
        '<div class="BodyStyler__GutenbergStyled-sc-ssx5r2-0 epAIFH">lead <p>para</p>\n<div><b>x</b>y</div></div>'
        '<div class="AuthorCard__Content-q"><strong>Maria</strong></div>'
        '<div class="DefaultArticleType__FeaturedImage-z"><img src="https://h/a/b/c/d/e.jpg"></div>',
        {"category": "Politic", "title": "Ancheta", "published_raw": "3 iunie", "author": "Maria",
         "image_url": "https://h/a/b/c/d/e.jpg", "image_file": "c_d_e.jpg", "content": ["lead ", "para", "\n", "xy"]}),
    "book_http": ("<h1>A</h1><h1>B</h1>", {"title": "A"}),
    "book_single": ("<div><h1> A </h1></div>", {"title": " A "}),
    "wiki_title": ("<h1>On <i>it</i></h1>", {"title": "On it"}),
    "pdf_offer": (
        '<a href="/no">no</a><div class="product-price-and-delivery"><p class="product-price"><a href="https://h/f.pdf">f</a></p></div>',
        {"download_url": "https://h/f.pdf"}),
    "pdf_library": (
        '<div class="prod_desc_text"><a href="/no.pdf">no</a><p><a target="_blank" href="/f.pdf">f</a></p></div>',
        {"download_url": "https://h0.example.com/f.pdf"}),
}


@pytest.mark.parametrize("site", sorted(PAGES))
def test_site_spec(spark, site):
    html, expected = PAGES[site]
    pages = pages_df(spark, html)
    r = sites.site_articles(pages, N.shred(pages), site).first().asDict()
    for k, v in expected.items():
        assert r[k] == v, (k, r[k])


def test_every_spec_has_a_fixture():
    covered = set(PAGES) | {"wp_cats", "edition_article", "book_detail"}  # the last three in test_selectors
    assert covered == set(sites.SPECS)


HOSTS = {"a.example": "wp_cats", "b.example": "wiki_title", "c.example": "pdf_offer"}


def mixed(spark, extra=()):
    rows = [(1, "https://A.example/x", '<h1 class="post-title">One</h1>', 200), (2, "https://b.example/", "<h1>Two</h1>", None), (3, "https://c.example/", "<p>no link</p>", 200),
            (4, "https://b.example/gone", "<h1>Not found</h1>", 404), (5, "https://nowhere.example/", "<h1>Five</h1>", 200), (6, None, None, None), (7, "https://b.example/", "<p>untitled</p>", 200), *extra]
    return spark.createDataFrame(rows, "page_id long, url string, html string, status int")


def test_records_by_host_in_one_pass(spark):
    got = sites.site_records(mixed(spark), HOSTS)
    rows = {r.page_id: r for r in sites.render_sentinels(got).collect()}
    assert {k: (r.site, r.outcome, r.error) for k, r in rows.items()} == {
        1: ("wp_cats", "ok", None), 2: ("wiki_title", "ok", None), 3: ("pdf_offer", "skipped", None), 4: ("wiki_title", "error", 404),
        5: (None, "unknown", None), 6: (None, "unknown", None), 7: ("wiki_title", "ok", None)}
    assert (rows[1].title, rows[1].content, rows[1].author, rows[1].tags) == ("One", [], "[scrape] no author", None)
    assert (rows[2].title, rows[2].content, rows[5].title, rows[7].title) == ("Two", None, None, "Default title")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan and "Join" not in plan


def test_a_broken_page_is_one_error_record_and_counted(spark, monkeypatch):
    class Broken(N._Tree):
        def handle_endtag(self, tag):
            if tag == "i":
                raise AssertionError("odd")
            super().handle_endtag(tag)

    monkeypatch.setattr(N, "_Tree", Broken)
    got, seen = sites.observed(sites.site_records(mixed(spark, [(8, "https://b.example/", "<h1>Kept</h1><i>x</i><h2>lost</h2>", 200)]), HOSTS))
    rows = {r.page_id: r for r in got.collect()}
    assert (rows[8].outcome, rows[8].title, rows[8].parse_error) == ("broken", "Kept", "AssertionError: odd")
    assert seen.get == {"pages": 8, "ok": 3, "error": 1, "broken": 1, "unknown": 2, "skipped": 1}
    assert [tuple(r) for r in sites.parse_errors(got).collect()] == [(8, "https://b.example/", "wiki_title", "AssertionError: odd")]
    errors = N.shred(mixed(spark, [(8, "u", "<i>x</i>", 200)])).where("kind = 'error'").collect()
    assert [(r.page_id, r.text) for r in errors] == [(8, "AssertionError: odd")]


def test_a_field_must_have_one_type():
    from presslake.operators.selectors import Sel
    with pytest.raises(ValueError):
        N.record_rows(None, {"a": sites.plain_spec({"x": ("all", Sel.tag("p"))}), "b": sites.plain_spec({"x": ("first", Sel.tag("p"))})}, "site")
    with pytest.raises(ValueError):
        N.field_type("last")


def test_listing_pages_by_host(spark):
    pages = spark.createDataFrame([
        (1, "https://l.example/cat/x/", '<div class="tdb-numbered-pagination"><h3 class="entry-title"><a href="b">b</a></h3></div><div class="td-category-pos-above"><a class="td-image-wrap" href="/a">a</a></div><span class="pages">Page 1 of 4</span>'),
        (2, "https://e.example/ed", '<article class="item-list"><h2><a href="https://z/1">1</a><a>none</a><a href="">blank</a></h2></article><span class="pages">no count</span>'),
        (3, "https://nowhere.example/", '<h2><a href="/a">a</a></h2>')], "page_id long, url string, html string")
    got = sites.listing_records(pages, {"l.example": "td_post", "e.example": "entry_paras"})
    rows = {r.page_id: (r.site, r.n_pages, r.links) for r in got.collect()}
    assert rows == {1: ("td_post", 4, ["https://l.example/cat/x/b", "https://l.example/a"]), 2: ("entry_paras", 0, ["https://z/1"]), 3: (None, 0, [])}
    urls = sorted((r.site, r.page_no, r.page_url) for r in sites.listing_page_urls(got).collect())
    assert urls == [("entry_paras", 1, "https://e.example/ed"), ("td_post", 1, "https://l.example/cat/x/"), ("td_post", 2, "https://l.example/cat/x/page/2/"), ("td_post", 3, "https://l.example/cat/x/page/3/")]


def test_edition_sections_nest(spark):
    html = ('<div class="archive_index"><h1>Editia 12 - 3 mai 1999</h1></div><h3><a href="/out">out</a></h3>'
            '<div class="category_holder"><h2>Politic</h2><h3><a href="/1">one</a> <a href="/2">two</a></h3>'
            '<div class="category_holder"><h3><a href="/in">inner</a></h3></div><h3><a href="/3">three</a></h3></div>'
            '<div class="category_holder"><h2>Empty</h2></div>')
    pages = spark.createDataFrame([(1, "https://e.example/12", html), (2, "https://e.example/13", "<p>no sections</p>")], "page_id long, url string, html string")
    got = sorted((r.section_pos, r.section_title, r.publication_date, -1 if r.link_pos is None else r.link_pos, r.link, r.link_text) for r in sites.edition_links(pages).collect())
    d = "3 mai 1999"
    assert got == [(0, "Politic", d, 0, "https://e.example/1", "one"), (0, "Politic", d, 1, "https://e.example/2", "two"), (0, "Politic", d, 2, "https://e.example/3", "three"),
                   (1, "Default", d, 0, "https://e.example/in", "inner"), (2, "Empty", d, -1, None, None)]


def test_implied_end_tags_of_lists_and_tables():
    n = N.read_page("<dl><dt>a<dd>b<dd>c<dl><dd>d</dl><dt>e</dl><table><tr><td>1<td>2<tr><th>3<table><tr><td>4</table></table><select><option>x<option>y</select>")
    text = [(n.tag[i], n.text_of(i)) for i in range(len(n.tag)) if n.tag[i] in ("dt", "dd", "td", "th", "tr", "option")]
    assert text == [("dt", "a"), ("dd", "b"), ("dd", "cd"), ("dd", "d"), ("dt", "e"), ("tr", "12"), ("td", "1"), ("td", "2"), ("tr", "34"), ("th", "34"), ("tr", "4"), ("td", "4"), ("option", "x"), ("option", "y")]


def test_harvest_command_with_hosts(spark, scratch):
    import json
    import os

    from presslake.__main__ import main
    from presslake.plans.q_sites import HOSTS as SITE_HOSTS, site_pages
    landing, hosts = os.path.join(scratch, "landing"), os.path.join(scratch, "hosts.json")
    pages = site_pages(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    pages.write.parquet(landing)
    with open(hosts, "w") as f:
        json.dump(SITE_HOSTS, f)
    out = os.path.join(scratch, "records")
    main(["records", "--pages", landing, "--hosts", hosts, "--out", out])
    got = spark.read.json(os.path.join(out, "records"))
    assert got.count() == pages.count() and got.where("site = 'td_post' and title is null and error is null").count() == 0
    images = spark.read.parquet(os.path.join(out, "images"))
    assert images.count() > 0 and images.where("image_url rlike '^(none|n/a)$'").count() == 0
