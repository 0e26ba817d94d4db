"""Operators 3 and 5: rules, host ranks against plain iteration, page text."""

import pytest
from pyspark.sql import functions as F

from presslake.llm import hostrank, htmltext

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"


def split(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]


def rule_of(host, path):
    best = None
    for verdict, rule in hostrank.RULES:
        suffix, prefix = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == suffix or host.endswith("." + suffix)) and path.startswith(prefix) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best


def ranks(edges, seeds, damping, iterations):
    """The same walk by dictionaries: edges {src: {dst: n}}, seeds {host: share}."""
    rank = dict(seeds)
    for _ in range(iterations if any(edges.values()) else 0):
        new = {h: (1 - damping) * s for h, s in seeds.items()}
        for src, to in edges.items():
            for dst, n in to.items():
                if src in rank:
                    new[dst] = new.get(dst, 0) + damping * rank[src] * n / sum(to.values())
        rank = new
    return rank


URLS = ["http://A.example.NET/en/x?q", "https://example.com/de/", "https://example.com/de", "ftp://x.org/fr/a#b", "http://a.net", "http://a.net/", "http://badnet/", "x://y://z",
        "no scheme", "", None, "http://", "://h/p", "http://h?x=/en/", "http://B.example.net/EN/", "http://É.Org/fr/"]


def test_urls_and_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)]
    got = {r.page_id: r for r in hostrank.judge_urls(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, u, _ in rows:
        host, path = split(u)
        best = rule_of(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best and best[0]), u
        if best:
            assert got[i].verdict == best[1]


def page(*links):
    return "".join(f'<a class="x" href="{u}">t</a>' for u in links)


def test_ranks_decide_the_rest(spark):
    """good.example.net (allowed) links to friend; spam and fan link to bad.net."""
    rows = [(1, "http://good.example.net/en/1", page("https://friend.com/a", "/local", "http://GOOD.example.net/en/2")),
            (2, "http://bad.net/", page("http://victim.com/")),
            (3, "http://spam.com/1", page("http://bad.net/x", "//bad.net/y")),
            (4, "http://fan.com/1", page("http://spam.com/")),
            (5, "http://friend.com/1", page("http://bad.net/", "http://victim.com/")),
            (6, "http://victim.com/1", None), (7, "http://quiet.com/1", "<p>text</p>")]
    got = {r.host: r for r in hostrank.judge_urls(spark.createDataFrame(rows, SCHEMA)).collect()}
    forward = {"good.example.net": {"friend.com": 1}, "bad.net": {"victim.com": 1}, "spam.com": {"bad.net": 2}, "fan.com": {"spam.com": 1}, "friend.com": {"bad.net": 1, "victim.com": 1}}
    backward = {}
    for a, to in forward.items():
        for b, n in to.items():
            backward.setdefault(b, {})[a] = n
    trust = ranks(forward, {"good.example.net": 1.0}, hostrank.DAMPING, hostrank.ITERATIONS)
    distrust = ranks(backward, {"bad.net": 1.0}, hostrank.DAMPING, hostrank.ITERATIONS)
    for h, r in got.items():
        assert r.trust == pytest.approx(trust.get(h, 0), abs=1e-12) and r.distrust == pytest.approx(distrust.get(h, 0), abs=1e-12)
    assert [got[h].verdict for h in ("good.example.net", "bad.net", "spam.com", "fan.com", "friend.com", "victim.com", "quiet.com")] == ["allow", "block", "block", "block", "allow", "allow", "allow"]


def test_url_edge_cases(spark):
    rows = [(None, None, None), (1, "http://a.net/x", ""), (1, "http://a.net/x", ""), (2, "http://" + "h" * 100_000 + "/p", "<a href=" * 10_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("host", F.lit("x")).withColumn("rule", F.lit(1)).withColumn("kind", F.lit("z"))
    got = hostrank.judge_urls(df).collect()
    assert len(got) == 4 and {(r.page_id, r.host[:2], r.verdict) for r in got} == {(None, "", "allow"), (1, "a.", "block"), (2, "hh", "allow")}
    assert hostrank.judge_urls(spark.createDataFrame([], SCHEMA)).collect() == []


def test_native_plan(spark):
    plan = hostrank.judge_urls(spark.read.parquet(f"{SF}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><a href="/">Home</a></nav>
<div class="ad">Buy</div><div class="col col-12"><article class="post-7"><h1>A &amp; B</h1><p>one<br>two  three<p>four <b>bold</p>
<ul><li>x<li>y</ul><script>if(a<b){"</p>"}</script><div class="share-box">Share</div><table><tr><td>1<td>2</table><p>3 < 4&nbsp;&#537;</p>
<form><input><p>Write</p></form><section id="comments"><p>First!</p></section></article></div><aside><p>Side text that is long enough to count</p></aside>
<div class="footer">F</div><footer>&copy; me</footer></body></html>"""
TEXT = "A & B\none two three\nfour bold\nx\ny\n1 2\n3 < 4 ș"


def test_page_text():
    page = htmltext.Page(PAGE)
    path = ">html>body>div.col.col-0>article.post-0"
    assert page.shares()[path] == 1.0 and page.text(path) == TEXT
    assert htmltext.extract(PAGE, [">html>body>div.none", path]) == TEXT == htmltext.extract(PAGE, [])


@pytest.mark.parametrize("source,text", [("", ""), ("plain", "plain"), ("<", "<"), ("<p", ""), ("a<!-- b", "a"), ("a<script>b", "a"), ("<![foo[x]]>abc", "abc"), ("a</p></div>b", "a\nb"),
                                         ("<p>a</p", "a"), ("x &am", "x &am"), ("&amp", "&"), ("<p hidden>a</p>b", "b"), ("<a href='x>y", "y"), ("a\r\n\tb", "a b"), ("<P>A<DIV>B", "A\nB")])
def test_broken_pages(source, text):
    assert htmltext.extract(source, []) == text


@pytest.mark.parametrize("source", ["<b>" * 100_000 + "x", "<div>" * 60_000 + "x", "<p>a" * 50_000, "</x>" * 100_000, "<div class=q>" * 20_000 + "<p>x" * 20_000, "<a href='" * 30_000])
def test_deep_pages_take_linear_time(source):
    import time
    began = time.process_time()
    htmltext.extract(source, [">x"])
    htmltext.Page(source).shares()
    assert time.process_time() - began < 10


def test_hosts_agree_on_paths(spark):
    """One page of a host has more text in its menu block than in its story;
    the host's other pages settle where the story is."""
    def of(story, links):
        return f'<body><div class="top">{links}</div><div class="story s{len(story)}"><p>{story}</p></div></body>'

    rows = [(i, f"http://h.com/{i}", of("A long story is told here, word by word. " * 5, "short")) for i in range(9)]
    rows += [(9, "http://h.com/9", of("Brief.", "A teaser that is longer than the story itself, much longer")), (10, "http://other.com/", of("Brief.", "Other words"))]
    got = {r.page_id: r.text for r in htmltext.extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[9] == "Brief." and got[0] == ("A long story is told here, word by word. " * 5).strip()


def test_every_page(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in htmltext.extract_pages(rows).collect()}
    import html
    import re
    for r in rows.collect():
        body = r.html[r.html.index("<article>") + 9:r.html.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert got[r.page_id].text == "\n".join(b for b in blocks if b) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_page_edge_cases(spark):
    rows = [(None, None, None), (1, None, "<p>a</p>"), (2, "http://h/", None), (2, "http://h/", None), (3, "http://h/", ""), (4, "http://g/", "<p>" + "word " * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("text", F.lit("x")).withColumn("paths", F.lit(1)).withColumn("_h", F.lit(1))
    got = htmltext.extract_pages(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 1), (2, 0), (2, 0), (3, 0), (4, 1_499_999)]
    assert htmltext.extract_pages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_headings_beside_the_winner(spark):
    """Most of the text is in a container within the article."""
    body = "A long story is told here, word by word. " * 6

    def texts(shape):
        rows = [(i, f"http://h.com/{i}", f"<html><body><div class='top'>teaser</div>{shape}</body></html>") for i in range(4)]
        return {r.text for r in htmltext.extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()}

    for shape in ("<article><h1>T</h1><p>lead</p><section><p>{}</p></section></article>", "<article><div class='head'><h1>T</h1></div><div class='l'>lead</div><section>{}</section></article>",
                  "<div class='post'><h1>T</h1><p>lead</p><p><a href='/'>All stories</a></p><div class='entry'>{}</div></div>", "<h1>T</h1><p>lead</p><div>{}</div>",
                  "<div class='post'><div><h1>T</h1></div><div class='l'><p>lead</p></div><div class='entry'>{}</div></div>"):
        assert texts(shape.format(body)) == {f"T\nlead\n{body.strip()}"}, shape


def test_every_template_of_a_host_votes(spark):
    """Twelve templates, each of under a tenth of the host's pages; one page of
    each has more text in its teaser than in its story."""
    story, teaser = "A long story is told here, word by word. " * 5, "A teaser that is longer than the story itself, much longer"
    rows = []
    for t in "abcdefghijkl":
        for i in range(5):
            rows.append((len(rows), "http://h.com/x", f"<body><div class='top'>{teaser if i == 4 else 'short'}</div><div class='t{t}'>{'Brief.' if i == 4 else story}</div></body>"))
    got = {r.page_id: r.text for r in htmltext.extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: "Brief." if i % 5 == 4 else story.strip() for i in range(60)}


STORY = "A long story is told here, word by word. " * 5


@pytest.mark.parametrize("page", [
    "<form id='aspnetForm'><div class='post'><h1>T</h1><p>{}</p></div></form>", "<div class='content-sidebar-wrap'><article><h1>T</h1><p>{}</p></article></div>",
    "<div id='header-and-main'><article><h1>T</h1><p>{}</p></article></div>", "<div class='no-sidebar'><h1>T</h1><p>{}</p></div>",
    "<article title='The hidden coast'><h1>T</h1><p>{}</p></article>", "<article><h1>T</h1><p class='text hidden md:block'>{}</p></article>",
    "<article data-x='display:none'><h1>T</h1><p>{}</p></article>", "<div class='search'><h1>T</h1><div class='widget'>{}</div></div>"])
def test_names_of_wrappers_lose_no_article(page):
    page = f"<html><body><nav>Home</nav>{page.format(STORY)}<div class='sidebar'>Side</div><p style='color:red; display: none'>x</p><p HIDDEN=''>y</p></body></html>"
    assert htmltext.extract(page, []) == f"T\n{STORY.strip()}"


def test_long_comments_are_dropped():
    assert htmltext.extract(f"<div><p>{STORY}</p></div><div class='comments'><p>{'First! ' * 80}</p></div>", []) == STORY.strip()


@pytest.mark.parametrize("page", ["<div class='sidebar'><a href='/'>Only links</a></div>", "<form>a</form>", "<div class='ad'>a</div><div class='menu'>b</div>", "<nav><a href='/'>Home</a></nav>"])
def test_pages_with_text_are_never_empty(page):
    assert htmltext.extract(page, []) and htmltext.extract(page, [">div.sidebar", ">nav"])


def test_hosts_that_rules_fit_in_part(spark):
    """A block rule fits one page of four of a host, an allow rule one of five of another: the
    host's free pages are not blocked for it, but hosts that link there and that nothing trusts are."""
    rows = [(i, f"http://shop.example.com/{'de' if i == 0 else 'x'}/{i}", page("http://other.com/")) for i in range(4)]
    rows += [(10 + i, f"http://news.org/{'fr' if i == 0 else 'x'}/{i}", page("http://friend.com/")) for i in range(5)]
    rows += [(20, "http://fan.com/", page("http://shop.example.com/")), (21, "http://friend.com/", page("http://shop.example.com/")), (22, "http://quiet.com/", None)]
    got = {r.host: r for r in hostrank.judge_urls(spark.createDataFrame(rows, SCHEMA)).where("rule is null").collect()}
    assert {h: r.verdict for h, r in got.items()} == {"shop.example.com": "allow", "news.org": "allow", "fan.com": "block", "friend.com": "allow", "quiet.com": "allow"}
    assert got["news.org"].trust == pytest.approx(0.15) and got["shop.example.com"].distrust == pytest.approx(0.15)


@pytest.mark.parametrize("blocked,verdict", [(1, "allow"), (5, "allow"), (6, "block"), (10, "block")])
def test_own_blocked_pages_speak_for_the_host_from_half_of_them_on(spark, blocked, verdict):
    rows = [(i, f"http://h.example.com/{'de' if i < blocked else 'x'}/{i}", page("http://h.example.com/")) for i in range(11)]
    rows += [(20 + i, f"http://spam.net/{i}", page("http://elsewhere.com/")) for i in range(3)]
    got = hostrank.judge_urls(spark.createDataFrame(rows, SCHEMA))
    assert {r.verdict for r in got.where("host = 'h.example.com' and rule is null").collect()} == {verdict}
    assert {r.verdict for r in got.where("rule = 'example.com/de/'").collect()} == {"block"}


def test_hub_cycle_and_chain_equal_the_walk(spark):
    """A hub of 300 links, a cycle back to it and a chain, against a dictionary walk."""
    links = [("hub", f"s{i}") for i in range(300)] + [("s0", "s1"), ("s1", "s2"), ("s2", "hub")] + [("s9", "c0")] + [(f"c{i}", f"c{i + 1}") for i in range(6)]
    out = {}
    for a, b in links:
        out.setdefault(a, []).append(b)
    want, step = {"hub": 0.15}, {"hub": 0.15}
    for _ in range(200):
        moved = {}
        for a, x in step.items():
            for b in out.get(a, ()):
                moved[b] = moved.get(b, 0) + 0.85 * x / len(out[a])
        for b, x in moved.items():
            want[b] = want.get(b, 0) + x
        step = moved
    edges = spark.createDataFrame([("allow", a, b, 1 / len(out[a])) for a, b in links], "kind string, src string, dst string, w double")
    seeds = spark.createDataFrame([("allow", "hub", 1.0)], "kind string, host string, s double")
    got = {r.host: r["rank"] for r in hostrank.propagate(edges, seeds).collect()}
    assert got.keys() == want.keys() and all(got[h] == pytest.approx(want[h], rel=1e-4) for h in want)


def test_long_attributes_end_where_their_quotes_do():
    import time
    long = "x" * 9000 + ' > <p>not text</p> '
    assert htmltext.extract(f"<article><p title=\"{long}\">{STORY}</p><p data-a='{long}'>End.</p></article>", []) == f"{STORY.strip()}\nEnd."
    t0 = time.time()
    assert STORY.strip() in htmltext.extract("<a href='x>" * 1 + f"<article><p>{STORY}</p></article>" + "<b title=\"q>" * 20_001, [])
    assert time.time() - t0 < 20


def test_winners_that_travel_and_winners_that_are_joined_give_the_same(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    a = sorted(tuple(r) for r in htmltext.extract_pages(pages).collect())
    monkeypatch.setattr(htmltext, "WINNER_ROWS", 0)
    assert a == sorted(tuple(r) for r in htmltext.extract_pages(pages).collect())


def test_long_walks(spark):
    """Distrust fifteen links on, and of a loop."""
    seeds = spark.createDataFrame([("block", "s0", 0.5), ("block", "s1", 0.5)], "kind string, host string, s double").coalesce(1)
    links = [("s0", "c0")] + [(f"c{i}", f"c{i + 1}") for i in range(14)] + [("s1", "l0"), ("l0", "l1"), ("l1", "l0")]
    edges = spark.createDataFrame([("block", a, b, 1.0) for a, b in links], "kind string, src string, dst string, w double").coalesce(1)
    got = {r.host: r["rank"] for r in hostrank.propagate(edges, seeds, tolerance=0.01).collect()}
    unit = 0.15 / 2
    assert got["c14"] == pytest.approx(unit * 0.85 ** 15) and got["l0"] == pytest.approx(unit * 0.85 / (1 - 0.85 ** 2), rel=0.07)


def test_weak_distrust_blocks(spark):
    """A host that links to one blocked host among 40,000 others."""
    seeds = spark.range(40_000, numPartitions=2).select(F.col("id").alias("page_id"), F.concat(F.lit("http://b"), "id", F.lit(".net/")).alias("url"), F.lit(None).cast("string").alias("html"))
    ids = [f"http://w{i}.com/" for i in range(8)]
    rows = [(100_000 + i, u, page("http://b0.net/")) for i, u in enumerate(ids)]
    got = hostrank.judge_urls(seeds.unionByName(spark.createDataFrame(rows, SCHEMA))).where("host like 'w%'").collect()
    assert len(got) == 8 and all(r.verdict == "block" and 0 < r.distrust < 1e-6 for r in got)
