"""Harvest outcomes, traversal, positions, links and the upsert table on cases
that the test data lack."""

import os
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from presslake.functions import html as H
from presslake.functions.urls import absolutize, absolutize_all, base_parts
from presslake.operators.extract import page_links
from presslake.operators.harvest import harvest, harvest_report, listing_harvest
from presslake.operators.pagination import follow_next
from presslake.operators.planning import host_waves, plateau_stop
from presslake.operators.windows import dense_index
from presslake.sources import sinks

PAGE = "<article><h1>{}</h1><p>body</p></article>"


def test_harvest_outcomes(spark):
    urls = spark.createDataFrame([(f"https://h/{x}", i) for i, x in enumerate(("a", "b", "c", "d", "a/", "e"))], "url string, pos int")
    pages = spark.createDataFrame([(1, "https://h/a", 200, PAGE.format("first")), (2, "https://h/a/", 200, PAGE.format("second")),
                                   (3, "https://h/b", None, PAGE.format("no status")), (4, "https://h/c", 404, PAGE.format("404 not found")),
                                   (5, "https://h/e", 200, None)], "page_id long, url string, status int, html string")
    got = {r.url[-1]: r for r in harvest(urls, pages).collect()}
    assert {k: (r.outcome, r.status, r.title) for k, r in got.items()} == {
        "a": ("ok", 200, "second"), "b": ("ok", 200, "no status"), "c": ("error", 404, None), "d": ("lost", None, None), "e": ("ok", 200, None)}
    assert got["c"].content is None and got["a"].content == ["body"]
    r = harvest_report(harvest(urls, pages)).first()
    assert (r.n_urls, r.n_ok, r.n_error, r.n_lost, r.n_with_title) == (5, 3, 1, 1, 2)


def test_harvest_of_the_readme(spark):
    """Every landed page counts, whether or not the landing table has a status."""
    from presslake.sources.tables import read_pages
    pages = read_pages(spark, "/root/testdata/sf0.001")
    got = harvest(pages.select("url", F.col("page_id").alias("pos")), pages)
    assert {r.outcome for r in got.collect()} == {"ok"}


def test_lost_listing_pages_stay(spark):
    pages = spark.createDataFrame([(1, "https://h/l", '<span class="pages">Page 1 of 3</span><a href="/x">x</a>'), (3, "https://h/l/page/3", '<a href="/y">y</a>')],
                                  "page_id long, url string, html string")
    got = listing_harvest(spark.createDataFrame([("https://h/l",), ("https://gone/l",)], "url string"), pages).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("https://h/l", 1, 0, "https://h/x"), ("https://h/l", 3, 0, "https://h/y"),
                                                        ("https://h/l", 2, None, None), ("https://gone/l", 1, None, None)], key=repr)


@pytest.mark.parametrize("n", [1, 130, 1440])
def test_follow_next_has_no_cap(spark, n):
    edges = spark.createDataFrame([("s", i, i + 1) for i in range(n)] + [("t", 5, 6), (None, 1, 2)], "src_key string, src long, dst long")
    start = spark.createDataFrame([("s", 0), ("t", 5), (None, 1), ("u", 9)], "src_key string, src long")
    got = {(r.src_key, r.node, r.depth) for r in follow_next(edges, start).collect()}
    assert got == {("s", i, i) for i in range(n + 1)} | {("t", 5, 0), ("t", 6, 1), (None, 1, 0), (None, 2, 1), ("u", 9, 0)}


def test_follow_next_cycle_is_an_error(spark):
    edges = spark.createDataFrame([("s", 0, 1), ("s", 1, 2), ("s", 2, 0)], "src_key string, src long, dst long")
    with pytest.raises(ValueError, match="cycle"):
        follow_next(edges, spark.createDataFrame([("s", 0)], "src_key string, src long"))


def test_a_short_cycle_among_many_links_is_found_at_once(spark):
    import time
    links = [("s", i, i + 1) for i in range(5000)] + [("c", 0, 1), ("c", 1, 0), ("d", 9, 8), ("d", 8, 9)]
    edges = spark.createDataFrame(links, "src_key string, src long, dst long")
    t0 = time.time()
    with pytest.raises(ValueError, match="cycle.*'c'"):
        follow_next(edges, spark.createDataFrame([("s", 4990), ("c", 0)], "src_key string, src long"))
    assert time.time() - t0 < 15
    # a cycle that no start leads to, two starts that meet, a repeated start
    got = {(r.src_key, r.node, r.depth) for r in follow_next(edges, spark.createDataFrame([("s", 4997), ("s", 4998), ("s", 4998)], "src_key string, src long")).collect()}
    assert got == {("s", 4997 + i, i) for i in range(4)} | {("s", 4998 + i, i) for i in range(3)}


@pytest.mark.parametrize("kind", ["id", "text", "struct"])
def test_positions_do_not_depend_on_the_ranges(spark, kind):
    order = {"id": F.col("id"), "text": F.lpad(F.col("id").cast("string"), 6, "0"), "struct": F.struct((F.col("id") % 7).alias("a"), F.col("id").alias("b"))}[kind]
    df = spark.range(20_000).select("id", order.alias("o"), F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"))
    got = [sorted((r.id, r.idx, r.n, r.prev_id) for r in dense_index(df, "o", ["g"], ranges=n, total_col="n", lag_cols=["id"]).collect()) for n in (1, 5, 64)]
    assert got[0] == got[1] == got[2]
    plan = dense_index(df, "o", ["g"], ranges=64)._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 20_000      # no bounds as literals


def test_positions_keep_null_groups_and_any_order(spark):
    rows = [(None, "b"), (None, "a"), ("x", "c"), ("x", None), ("y", "d")]
    df = spark.createDataFrame(rows, "g string, o string")
    got = {(r.g, r.o): (r.idx, r.n, r.prev_o) for r in dense_index(df, "o", ["g"], total_col="n", lag_cols=["o"]).collect()}
    assert got == {(None, "a"): (0, 2, None), (None, "b"): (1, 2, "a"), ("x", None): (0, 2, None), ("x", "c"): (1, 2, None), ("y", "d"): (0, 1, None)}
    waves = host_waves(spark.createDataFrame([(None, i) for i in range(4)], "host string, id long"), "host", "id", 2)
    assert sorted((r.id, r.wave) for r in waves.collect()) == [(0, 0), (1, 0), (2, 1), (3, 1)]
    flat = plateau_stop(spark.createDataFrame([(None, 1, 5), (None, 2, 5)], "g string, o long, h long"), "g", "o", "h").collect()
    assert [(r.g, r.stop_pos, r.stop_height) for r in flat] == [(None, 1, 5)]


def test_an_outlier_does_not_fill_one_range(spark):
    df = spark.range(20_000).union(spark.createDataFrame([(1 << 60,)], "id long"))
    from presslake.operators.windows import in_ranges
    sizes = in_ranges(df, ["id"], 64).groupBy("_part").count().collect()
    assert len(sizes) == 64 and max(r["count"] for r in sizes) < 1000
    assert dense_index(df, "id", ranges=64).agg(F.max("idx"), F.count_distinct("idx")).first()[:] == (20_000, 20_001)


HREFS = ["../up", "./a", "../../../z", "a/./b/../c", "..", ".", "/x/../y", "?q=../1", "g#../s", "x/..", "", "#f", "mailto:a@b", "//o.com/a", "http://k.com/b"]


def test_relative_links(spark):
    base = "https://h.com/d/e/f.html?x=1"
    df = spark.createDataFrame([(h,) for h in HREFS], "h string")
    want = {h: urljoin(base, h) for h in HREFS}
    assert {r.h: r.u for r in df.select("h", absolutize("h", F.lit(base)).alias("u")).collect()} == want
    both = df.groupBy().agg(F.collect_list("h").alias("h")).withColumn("p", base_parts(F.lit(base))).select("h", absolutize_all("h", "p").alias("u")).first()
    assert dict(zip(both.h, both.u)) == want


def test_links_of_a_page(spark):
    html = '<base href="/deep/er/"><a href="x?a=1&amp;b=2">1</a><a href="../y">2</a><script>var s = \'<a href="/leak">\''
    got = page_links(spark.createDataFrame([(1, "https://h/p", html)], "page_id long, url string, html string"), absolute=True).collect()
    assert [(r.href, r.abs_url) for r in sorted(got, key=lambda r: r.pos)] == [("x?a=1&b=2", "https://h/deep/er/x?a=1&b=2"), ("../y", "https://h/deep/y")]


@pytest.mark.parametrize("tail", ["<script>x <p>leak</p>", "<style>x <p>leak</p>", "<!-- x <p>leak</p>"])
def test_cut_off_raw_text_does_not_leak(spark, tail):
    df = spark.createDataFrame([("<article><p>a</p>" + tail,)], "html string")
    assert df.select(H.paragraphs(H.inner_first(H.clean_html("html"), "article")).alias("p")).first().p == ["a"]


def test_a_damaged_version_is_an_error_not_a_new_table(spark, scratch):
    path = os.path.join(scratch, "t")
    rows = lambda *r: spark.createDataFrame(list(r), "url string, status string, seq long")
    assert sinks.upsert_table(spark, path, rows(("a", "NEW", 1))) == 1
    assert sinks.upsert_table(spark, path, rows(("b", "NEW", 2))) == 2
    part = next(f for f in sorted(os.listdir(f"{path}/v=2")) if f.endswith(".parquet"))
    for f in (part, f".{part}.crc"):
        if os.path.exists(f"{path}/v=2/{f}"):
            with open(f"{path}/v=2/{f}", "wb") as out:
                out.write(b"damaged")
    with pytest.raises(Exception):
        sinks.upsert_table(spark, path, rows(("c", "NEW", 3)))
    assert sorted(os.listdir(path))[-1] != "v=3"


def test_shredder_keeps_text_runs_and_odd_declarations(spark):
    from presslake.operators.nodes import shred
    from presslake.operators.selectors import Sel, children_text, select
    pages = spark.createDataFrame([(1, "u", "<div>3 < 4 &amp; 5<b>x</b>y</div>"), (2, "u", "<p>a</p><![foo[x]]><p>b</p>"), (3, "u", "<div>a<!-- c -->b</div>")], "page_id long, url string, html string")
    nodes = shred(pages)
    kids = children_text(nodes, Sel.tag("div")).orderBy("page_id", "pre").collect()
    assert [(r.page_id, r.text) for r in kids] == [(1, "3 < 4 & 5"), (1, "x"), (1, "y"), (3, "a"), (3, "b")]
    assert [r.text for r in select(nodes, Sel.tag("p")).orderBy("pre").collect()] == ["a", "b"]


def test_a_tokenizer_error_keeps_the_nodes_before_it(monkeypatch):
    from presslake.operators import nodes as N

    class Broken(N._Tree):
        def handle_endtag(self, tag):
            if tag == "i":
                raise AssertionError("odd")
            super().handle_endtag(tag)

    monkeypatch.setattr(N, "_Tree", Broken)
    cols = [[] for _ in N._COLS]
    N._shred_one(7, "<p>a</p><i>b</i><p>c</p>", cols)
    kinds, tags = cols[N._COLS.index("kind")], cols[N._COLS.index("tag")]
    assert kinds.count("error") == 1 and tags.count("p") == 1 and tags.count("i") == 1
