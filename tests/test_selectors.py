"""Selector families on hand-written pages (FIXTURES §4) and the two-path law."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, pages_df
from presslake.functions import html as H
from presslake.functions.text import py_strip
from presslake.operators import nodes as N
from presslake.operators import selectors as SL
from presslake.operators import sites
from presslake.operators.selectors import Sel
from presslake.sources.tables import table

SEL_BASIC = ('<html><head><title>T</title></head><body><h1>Plain</h1><h1 class="post-title x">  Real title '
             '</h1><span class="pages">Page 1 of 7</span></body></html>')
SEL_ID_CHILD = ('<div id="product_gallery"><div><div><div><img src="../../media/a.jpg"></div></div></div></div>'
                '<h1>Book</h1><p class="price_color">£51.77</p>'
                '<div id="product_description"><h2>Product Description</h2></div><p>Great book.</p>')
SEL_NTH = ('<div class="a_author"><span>Ion Pop</span><span>editor</span></div>'
           '<div class="wrap"><div class="x">first</div><div class="article-title">Second child</div></div>'
           '<div class="the-post-meta"><span class="cats"><a>News</a><a> Local </a></span></div>')
SEL_IS_NOT = ('<div class="post-content"><h2>Head</h2><p>Para 1</p><div>skip</div><p class="meta">m</p></div>'
              '<div class="item-page"><p>kept</p><p class="x">dropped</p></div>')
SEL_ATTR = ('<div class="AuthorCard__Content-sc-1"><strong>Ana</strong></div>'
            '<a target="_blank" href="/f.pdf">pdf</a><a href="/g.pdf">other</a>')
SEL_LIST = ('<div class="main-featured"><a href="/x">x</a></div><div class="main-content"><a href="/x">x</a>'
            '<a href="/y">y</a></div>')
BROKEN = ('<html><head><script>var t="</p>";</script><style>p{}</style></head><body><article><h1>A &amp; B</h1>'
          '<p><b>one<br><p>two</p><!-- <p>not a p</p> --><p>three &lt;3')
MISSING = '<html><body><h1></h1><div>no title</div></body></html>'
CHILDREN_MIXED = '<div class="Body">lead <p>para</p>  <p>second</p> tail</div>'


def _sel(spark, html, sel):
    nodes = N.shred(pages_df(spark, html))
    return [py_strip(F.lit(t)) for t in []] or [r["text"] for r in SL.select(nodes, sel).orderBy("pre").collect()]


def test_basic(spark):
    assert _sel(spark, SEL_BASIC, Sel.tag("h1")) == ["Plain", "  Real title "]
    assert _sel(spark, SEL_BASIC, Sel.tag("h1", cls="post-title")) == ["  Real title "]
    assert _sel(spark, SEL_BASIC, Sel.tag("span", cls="pages")) == ["Page 1 of 7"]


def test_id_child_adjacent(spark):
    nodes = N.shred(pages_df(spark, SEL_ID_CHILD))
    img = Sel.tag(None, id="product_gallery").child(Sel.tag("div")).child(Sel.tag("div")).child(
        Sel.tag("div")).child(Sel.tag("img"))
    m = SL.select(nodes, img).collect()
    assert [r["attrs"]["src"] for r in m] == ["../../media/a.jpg"]
    assert _sel(spark, SEL_ID_CHILD, Sel.tag("div", id="product_description").adjacent(Sel.tag("p"))) == ["Great book."]
    assert _sel(spark, SEL_ID_CHILD, Sel.tag("h1").adjacent(Sel.tag("p", cls="price_color"))) == ["£51.77"]


def test_nth_and_last(spark):
    assert _sel(spark, SEL_NTH, Sel.any().cls("a_author").child(Sel.tag("span").nth_child(1))) == ["Ion Pop"]
    assert _sel(spark, SEL_NTH, Sel.tag("div", cls="article-title").nth_child(2)) == ["Second child"]
    cat = Sel.any().cls("the-post-meta").descendant(Sel.tag("span", cls="cats")).descendant(Sel.tag("a").last_child())
    assert _sel(spark, SEL_NTH, cat) == [" Local "]


def test_is_and_not(spark):
    assert _sel(spark, SEL_IS_NOT, Sel.any().cls("post-content").child(Sel.any().is_("h2", "p"))) == \
        ["Head", "Para 1", "m"]
    assert _sel(spark, SEL_IS_NOT, Sel.any().cls("item-page").descendant(Sel.tag("p").without_attr("class"))) == ["kept"]


def test_attr(spark):
    assert _sel(spark, SEL_ATTR, Sel.tag("div").attr_prefix("class", "AuthorCard__Content")
                .descendant(Sel.tag("strong"))) == ["Ana"]
    assert _sel(spark, SEL_ATTR, Sel.tag("a").attr_equals("target", "_blank")) == ["pdf"]


def test_list_distinct_in_order(spark):
    nodes = N.shred(pages_df(spark, SEL_LIST))
    u = SL.select_union(nodes, Sel.any().cls("main-featured").descendant(Sel.tag("a")),
                        Sel.any().cls("main-content").descendant(Sel.tag("a")),
                        Sel.tag("div").descendant(Sel.tag("a")))
    assert [r["text"] for r in u.orderBy("pre").collect()] == ["x", "x", "y"]


def test_broken_markup(spark):
    # implied </p>, script text ignored, comment ignored, cut-off tail closed
    assert _sel(spark, BROKEN, Sel.tag("article").child(Sel.tag("p"))) == ["one", "two", "three <3"]
    assert _sel(spark, BROKEN, Sel.tag("h1")) == ["A & B"]


def test_missing_fields_are_null_or_empty(spark):
    pages = pages_df(spark, MISSING)
    nodes = N.shred(pages)
    spec = {"title": ("first", Sel.tag("h1")), "author": ("first", Sel.tag("span", cls="reviewer")),
            "content": ("all", Sel.tag("p"))}
    r = sites.extract_with_spec(pages, nodes, spec).first()
    assert r["title"] == ""          # present but empty (Q7)
    assert r["author"] is None       # absent (Q5)
    assert r["content"] == []        # list body → [] (Q6)


def test_children_mixed(spark):
    nodes = N.shred(pages_df(spark, CHILDREN_MIXED))
    kids = SL.children_text(nodes, Sel.tag("div", cls="Body")).orderBy("pre").collect()
    assert [r["text"] for r in kids] == ["lead ", "para", "  ", "second", " tail"]
    kept = SL.children_text(nodes, Sel.tag("div", cls="Body"), drop_blank=True).collect()
    assert len(kept) == 4


def test_site_spec_wp_cats(spark):
    html = ('<div class="the-post-meta"><span class="cats"><a>A</a><a> Local News </a></span></div>'
            '<h1 class="post-title"> Title </h1><div class="post-content"><h2>H</h2><p>P1</p><ul><li>x</li></ul>'
            '<p>P2</p></div><span class="posted-by"><span class="reviewer">Ana</span></span>'
            '<span class="posted-on"><time> 2020-05-01 </time></span>'
            '<figure class="wp-block-image"><img src="https://h/wp-content/uploads/2020/05/x.jpg?fit=810"></figure>')
    pages = pages_df(spark, html)
    r = sites.site_articles(pages, N.shred(pages), "wp_cats").first()
    assert (r["title"], r["category"], r["author"], r["published_raw"]) == ("Title", "local news", "Ana", "2020-05-01")
    assert r["content"] == ["H", "P1", "P2"]
    assert r["image_file"] == "2020_05_x.jpg"
    empty = pages_df(spark, "<p>nothing</p>")
    e = sites.render_sentinels(sites.site_articles(empty, N.shred(empty), "wp_cats"), "wp_cats").first()
    assert e["title"] == "[scrape] no title" and e["image_url"] == "none" and e["content"] == []


def test_site_spec_outer_html(spark):
    html = '<div class="txt_articol"><p>lead</p><p>Body <b>bold</b></p></div><h1>T</h1>'
    pages = pages_df(spark, html)
    r = sites.site_articles(pages, N.shred(pages), "edition_article").first()
    assert r["text_html"] == "<p>Body <b>bold</b></p>"


def test_site_spec_books(spark):
    pages = pages_df(spark, SEL_ID_CHILD)
    r = sites.site_articles(pages, N.shred(pages), "book_detail").first()
    assert str(r["price"]) == "51.77" and r["image_url"] == "media/a.jpg" and r["description"] == "Great book."


def test_two_paths_agree(spark):
    """Token path (Catalyst regex) = node path (shred + selectors) on real pages."""
    pages = table(spark, SF_SMALL, "pages")
    nodes = N.shred(pages).cache()
    tok = pages.select("page_id", H.first_text(H.clean_html("html"), "title").alias("title"),
                       F.size(H.hrefs(H.clean_html("html"))).alias("n_links"),
                       F.size(H.paragraphs(H.inner_first(H.clean_html("html"), "article"))).alias("n_p"))
    t = SL.first_per_page(SL.select(nodes, Sel.tag("title"))).select("page_id", py_strip("text").alias("title_n"))
    a = SL.select(nodes, Sel.tag("a").with_attr("href")).groupBy("page_id").agg(F.count(F.lit(1)).alias("n_links_n"))
    p = SL.select(nodes, Sel.tag("article").descendant(Sel.tag("p"))).groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n_p_n"))
    j = tok.join(t, "page_id", "left").join(a, "page_id", "left").join(p, "page_id", "left")
    bad = j.where((F.col("title") != F.col("title_n")) | (F.col("n_links") != F.col("n_links_n"))
                  | (F.col("n_p") != F.coalesce(F.col("n_p_n"), F.lit(0))))
    assert bad.count() == 0
    nodes.unpersist()


def test_adjacent_with_ancestors_single_pass(spark):
    html = ('<div class="x"><h1>A</h1><p>p1</p><h1>B</h1><span>s</span><p>p2</p></div>'
            '<div class="y"><h1>C</h1><p>p3</p></div><section><div class="x"><h2>D</h2><p>p4</p></div></section>')
    assert _sel(spark, html, Sel.tag("div", cls="x").child(Sel.tag("h1")).adjacent(Sel.tag("p"))) == ["p1"]
    assert _sel(spark, html, Sel.tag("div").child(Sel.tag("h1")).adjacent(Sel.tag("p"))) == ["p1", "p3"]
    assert _sel(spark, html, Sel.tag("section").descendant(Sel.any()).adjacent(Sel.tag("p"))) == ["p4"]
    assert _sel(spark, html, Sel.tag("span").adjacent(Sel.tag("p"))) == ["p2"]
    assert _sel(spark, html, Sel.any().nth_child(1).adjacent(Sel.tag("p"))) == ["p1", "p3", "p4"]
    # chained "+" falls back to the join path
    assert _sel(spark, html, Sel.tag("h1").adjacent(Sel.tag("span")).adjacent(Sel.tag("p"))) == ["p2"]


def test_count_matches_one_pass_and_fallback(spark):
    html = ('<ul><li>a</li><li class="k">b</li></ul><div><p>x</p><p class="c">y</p></div>')
    nodes = N.shred(pages_df(spark, html))
    fast = SL.count_matches(nodes, {"li": Sel.tag("li"), "plain_p": Sel.tag("p").without_attr("class")}).first()
    assert (fast.li, fast.plain_p) == (2, 1)
    # a positional ancestor forces the per-selector path; same answer shape
    slow = SL.count_matches(nodes, {"a": Sel.tag("ul").child(Sel.tag("li").nth_child(2)).descendant(Sel.any()),
                                    "li": Sel.tag("li")}).first()
    assert (slow.a, slow.li) == (0, 2)


def test_attribute_ancestors_fall_back_to_join(spark):
    html = ('<div target="x"><p>in</p></div><div><p>out</p></div>'
            '<section data-k="1"><span>t</span> bare </section>')
    assert _sel(spark, html, Sel.tag("div").attr_equals("target", "x").descendant(Sel.tag("p"))) == ["in"]
    assert _sel(spark, html, Sel.tag("div").with_attr("target").child(Sel.tag("p"))) == ["in"]
    nodes = N.shred(pages_df(spark, html))
    kids = SL.children_text(nodes, Sel.tag("section").attr_equals("data-k", "1")).orderBy("pre").collect()
    assert [r.text for r in kids] == ["t", " bare "]
