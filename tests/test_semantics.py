"""SURVEY §1.4 behaviour rows (Q1..Q21) not already pinned by other tests,
plus the remaining sinks / sources (O-K5, O-K10, binaryFile landing).

Already covered elsewhere: Q2/Q17 test_fixtures (page label, counter), Q3
expand_pages guard, Q4/Q14 URL-list reader, Q5/Q6/Q7 missing-field fixture,
Q9 image name, Q10 strip, Q12/Q13 chunks, Q16 children_text, Q18
insert/upsert laws, Q20 normaliser; Q19 holds by construction (all
comparisons are order-insensitive).
"""

import os

from pyspark.sql import functions as F

from conftest import pages_df
from presslake.operators import extract as X
from presslake.operators import nodes as N
from presslake.operators import quality as Q
from presslake.operators import sites
from presslake.operators import urls as U
from presslake.sources import sinks
from presslake.sources.readers import read_landing, read_url_list


def test_q1_first_page_twice_then_ordered_distinct(spark):
    # the edition's first page is harvested twice (directly and as page 1)
    rows = [(0, "/a"), (1, "/b"), (2, "/a"), (3, "/c"), (4, "/b")]
    links = spark.createDataFrame(rows, "pos long, url string")
    out = U.first_occurrence(links, "url", "pos").orderBy("pos").collect()
    assert [(r.url, r.pos) for r in out] == [("/a", 0), ("/b", 1), ("/c", 3)]


def test_q8_lost_urls_are_visible(spark):
    urls = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string")
    got = spark.createDataFrame([("u1", 200), ("u2", 404)], "url string, status int")
    j = U.lookup(urls, got, "url").withColumn("site", F.lit("s"))
    s = Q.harvest_summary(j, "site", "status").first()
    assert (s.n_ok, s.n_error, s.n_lost) == (1, 1, 1)
    assert [r.url for r in U.pending(urls, got, "url").collect()] == ["u3"]


def test_q11_per_site_cleanups(spark):
    html = ('<div class="the-post-meta"><span class="cats"><a> Sport LOCAL </a></span></div>'
            '<span class="posted-by"><span class="reviewer"> Ana </span></span>')
    pages = pages_df(spark, html)
    r = sites.site_articles(pages, N.shred(pages), "wp_cats").first()
    assert r.category == "sport local"     # stripped and lower-cased on this site
    assert r.author == " Ana "             # author not stripped on this site


def test_q15_null_and_blank_urls_not_written(spark, scratch):
    df = spark.createDataFrame([("/a",), (None,), ("",), ("/b",)], "url string")
    path = os.path.join(scratch, "list")
    sinks.write_url_list(df, path)
    assert sorted(r.url for r in read_url_list(spark, path).collect()) == ["/a", "/b"]


def test_q21_listing_has_no_status_filter_article_stage_does(spark):
    pages = pages_df(spark, "<article><h1>A</h1><p>x</p></article>", "<article><h1>B</h1></article>")
    pages = pages.withColumn("status", F.when(F.col("page_id") == 0, 200).otherwise(500))
    listing = X.page_links(pages)                      # listing stage: every page
    assert listing.count() == 0
    arts = X.extract_articles_full(pages)
    ok = arts.where(Q.outcome("status") == "ok")       # article stage: status 200 only
    assert [r.title for r in ok.collect()] == ["A"]
    assert arts.where(Q.outcome("status") == "error").count() == 1


def test_named_text_and_ensure_table(spark, scratch):
    df = spark.createDataFrame([("w1", "t1"), ("w1", "t2"), ("w2", "t3")], "worker string, title string")
    path = os.path.join(scratch, "named")
    sinks.write_named_text(df, path, "worker", "title")
    assert {"worker=w1", "worker=w2"} <= set(os.listdir(path))
    back = spark.read.text(path)
    assert sorted((r.worker, r.value) for r in back.collect()) == [("w1", "t1"), ("w1", "t2"), ("w2", "t3")]
    sinks.ensure_table(spark, "pl_urls_t", os.path.join(scratch, "urls_tbl"))
    sinks.ensure_table(spark, "pl_urls_t", os.path.join(scratch, "urls_tbl"))  # idempotent
    assert spark.table("pl_urls_t").columns == ["url", "status", "seq"]
    spark.sql("DROP TABLE IF EXISTS pl_urls_t")


def test_binary_landing_presence(spark, scratch):
    land = os.path.join(scratch, "img")
    os.makedirs(land)
    with open(os.path.join(land, "2020_05_x.jpg"), "wb") as f:
        f.write(b"\xff\xd8\xff")
    manifest = spark.createDataFrame([("2020_05_x.jpg",), ("missing.jpg",)], "file_name string")
    files = read_landing(spark, land).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")
    present = manifest.join(files, "file_name", "left").select("file_name", F.col("length").isNotNull().alias("ok"))
    assert {r.file_name: r.ok for r in present.collect()} == {"2020_05_x.jpg": True, "missing.jpg": False}


def test_url_length_check(spark):
    import pytest
    ok = spark.createDataFrame([("https://a/" + "x" * 10,)], "url string")
    assert sinks.check_url_lengths(ok).count() == 1
    bad = spark.createDataFrame([("https://a/" + "x" * 3000,)], "url string")
    with pytest.raises(Exception):
        sinks.check_url_lengths(bad).collect()


def test_listing_harvest_follows_page_count(spark):
    from presslake.operators.harvest import listing_harvest
    base = "https://ed.example/numere/nr-01-ianuarie-2014"
    p1 = ('<span class="pages">Page 1 of 3</span><h3><a href="/a1">a1</a></h3><h3><a href="/a2">a2</a></h3>')
    p2 = '<h3><a href="/a3">a3</a></h3><h3><a href="/a1">dup</a></h3>'
    p3 = '<h3><a href="/a4">a4</a></h3>'
    bad = '<span class="pages">Page 1 of x</span><a href="/only">o</a>'
    pages = spark.createDataFrame(
        [(1, base, p1), (2, base + "/page/2", p2), (3, base + "/page/3", p3),
         (4, "https://ed.example/numere/nr-02", bad), (5, "https://ed.example/numere/nr-02/page/2", p3)],
        "page_id long, url string, html string")
    seeds = spark.createDataFrame([(base,), ("https://ed.example/numere/nr-02",)], "url string")
    out = listing_harvest(seeds, pages).orderBy("seed_url", "page_no", "pos").collect()
    got = [(r.seed_url[-6:], r.page_no, r.link.rsplit("/", 1)[-1]) for r in out]
    assert got == [("e-2014", 1, "a1"), ("e-2014", 1, "a2"), ("e-2014", 2, "a3"), ("e-2014", 3, "a4"),
                   ("/nr-02", 1, "only")]                                  # unparsable count → first page only
    skip = listing_harvest(seeds.limit(1), pages, skip_last=True).count()
    assert skip == 3                                                        # range(2, n) never visits page n


def test_cli_commands(spark, scratch):
    from presslake.__main__ import main
    from presslake.sources.tables import table
    from conftest import SF_SMALL
    urls = os.path.join(scratch, "articles-demo.txt")
    with open(urls, "w") as f:
        for r in table(spark, SF_SMALL, "pages").select("url").collect():
            f.write(r.url + "\n")
        f.write("https://lost.example/x\n")
    out = os.path.join(scratch, "out")
    main(["harvest", "--urls", urls, "--pages", f"{SF_SMALL}/pages.parquet", "--out", out])
    arts = spark.read.json(os.path.join(out, "articles"))
    assert arts.where("outcome = 'lost'").count() == 1
    from presslake.functions.urls import normalize_url
    # one record per distinct normalised URL
    assert arts.where("outcome = 'ok'").count() == table(spark, SF_SMALL, "pages").select(normalize_url("url")).distinct().count()
    main(["links", "--pages", f"{SF_SMALL}/pages.parquet", "--out", os.path.join(scratch, "links")])
    assert spark.read.text(os.path.join(scratch, "links")).count() > 0
    main(["report", "--pages", f"{SF_SMALL}/pages.parquet", "--docs", f"{SF_SMALL}/documents.parquet",
          "--out", os.path.join(scratch, "rep")])
    assert spark.read.json(os.path.join(scratch, "rep", "languages")).count() >= 1


def test_multi_megabyte_page_does_not_overflow(spark):
    """Token path and shredder on one 4 MB page: no regex stack overflow,
    the whole text is processed (no prefix)."""
    body = "<p>" + ("word &amp; more text " * 40 + "<b>bold</b> ") * 4000
    html = ("<html><head><title>Big</title><script>var t='</p>';</script></head><body><nav><a href='/x'>x</a></nav>"
            "<article><h1>H</h1>" + body + "<p>last</p></article></body></html>")
    pages = pages_df(spark, html)
    r = X.extract_articles(pages).first()
    assert (r.n_paragraphs, r.n_links, r.headline, r.title) == (2, 1, "H", "Big")
    one = ("word & more text " * 40 + "bold ") * 4000
    assert r.content_chars == len(one.strip()) + len("last")
    assert N.shred(pages).where("tag = 'b'").count() == 4000
