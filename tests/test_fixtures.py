"""Unit cases of the reference (FIXTURES §1, §3) as Column / DataFrame checks."""

import pytest
from pyspark.sql import functions as F

from presslake.functions.text import path_tail_name, py_strip, splitlines
from presslake.functions.urls import normalize_url
from presslake.operators import pagination as PG
from presslake.operators import planning as P
from presslake.operators.quality import classify_value
from presslake.sources.readers import read_url_list


def _one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(col(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("value,expected", [
    ('"Coca Shefa"', None), ('"Baba cu cireshe in gaoaza"', None), ('"x Æ a-12"', None),
    ('""', "ValueError"),
    ("19", "TypeError"), ('{"ana":"mere"}', "TypeError"), ("[]", "TypeError"),
])
def test_validate_values(spark, value, expected):
    assert _one(spark, classify_value, value) == expected


@pytest.mark.parametrize("text,has_next", [
    ("Afisare stiri de la 811 la 825 din 840", True),
    ("Afisare stiri de la 826 la 840 din 840", False),
    ("", False), (None, False), ("a b c", False),
])
def test_pagination_counter(spark, text, has_next):
    assert _one(spark, PG.has_next_page, text) is has_next


def test_page_label(spark):
    assert _one(spark, PG.page_count, "Page 1 of 7") == 7
    assert _one(spark, PG.page_count, "") == 0
    with pytest.raises(Exception):
        _one(spark, lambda c: PG.page_count(c, strict=True), "")


def test_image_name(spark):
    url = "https://h/wp-content/uploads/2020/05/x.jpg?fit=810%2C456&ssl=1"
    assert _one(spark, lambda c: path_tail_name(c, 5), url) == "2020_05_x.jpg"
    assert _one(spark, lambda c: path_tail_name(c, 5, strip_query=False), url) == "2020_05_x.jpg?fit=810%2C456&ssl=1"
    assert _one(spark, lambda c: path_tail_name(c, 5), "https://h/a") == ""


@pytest.mark.parametrize("workers", [7, 15, 30])
def test_remainder_split_conserves(spark, workers):
    df = spark.range(100).withColumnRenamed("id", "i")
    out = P.remainder_split(df, "i", workers)
    sizes = {r["chunk"]: r["count"] for r in out.groupBy("chunk").count().collect()}
    assert sum(sizes.values()) == 100
    assert len(sizes) == workers
    per = 100 // workers
    assert all(sizes[c] == per for c in range(workers - 1))


def test_chunk_assign_rejects_zero(spark):
    with pytest.raises(ValueError):
        P.chunk_assign(spark.range(3), "id", 0)


def test_chunk_assign_sizes(spark):
    out = P.chunk_assign(spark.range(10).withColumnRenamed("id", "i"), "i", 3)
    sizes = sorted(r["count"] for r in out.groupBy("chunk").count().collect())
    # chunk_size = 10 // 3 = 3 → chunks of 3,3,3,1 (chunk count can exceed workers)
    assert sizes == [1, 3, 3, 3]


def test_py_strip_unicode(spark):
    assert _one(spark, py_strip, "\n  a b  \t") == "a b"


def test_splitlines_extra_breaks(spark):
    assert _one(spark, splitlines, "a\x0bb\nc\n") == ["a", "b", "c"]


@pytest.mark.parametrize("raw,key", [
    ("https://press.example//arhiva/x/", "https://press.example/arhiva/x"),
    ("HTTPS://H.Example/a#frag", "https://h.example/a"),
    ("  https://h.example/list?page=2  ", "https://h.example/list?page=2"),
    ("https://h.example/", "https://h.example"),
])
def test_normalize_url(spark, raw, key):
    assert _one(spark, normalize_url, raw) == key


def test_read_url_list_edge_cases(spark, scratch):
    import os
    p = os.path.join(scratch, "articles-demo-small.txt")
    with open(p, "w", newline="") as f:
        f.write("https://a.example/x\n\nhttps://b.example/y\x0bhttps://c.example/z\r\nhttps://a.example/x")
    df = read_url_list(spark, p).orderBy("pos")
    rows = [(r["site"], r["url"]) for r in df.collect()]
    assert rows == [("demo", "https://a.example/x"), ("demo", "https://b.example/y"),
                    ("demo", "https://c.example/z"), ("demo", "https://a.example/x")]
    blanks = read_url_list(spark, p, keep_blank=True).where(F.col("url") == "").count()
    assert blanks == 1


def test_expand_pages_guard(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 0)], "k long, n long")
    out = PG.expand_pages(df, "n").orderBy("k", "page_no").collect()
    assert [(r.k, r.page_no) for r in out] == [(2, 2), (2, 3)]
    skip = PG.expand_pages(df, "n", skip_last=True).collect()
    assert [(r.k, r.page_no) for r in skip] == [(2, 2)]


def test_read_categories(spark, scratch):
    import os
    from presslake.sources.readers import read_categories
    p = os.path.join(scratch, "categories-demo.txt")
    with open(p, "w") as f:
        f.write("https://site.example/categorie/actualitate/\nhttps://site.example/categorie/sport\n"
                "https://m.example/index.php?option=x&limit=36&catid=12:local&Itemid=7\n")
    rows = {r.url: r.category_slug for r in read_categories(spark, p).collect()}
    assert rows["https://site.example/categorie/actualitate/"] == "actualitate"
    assert rows["https://site.example/categorie/sport"] == "sport"
    assert rows["https://m.example/index.php?option=x&limit=36&catid=12:local&Itemid=7"] == "12:local"
    q = os.path.join(scratch, "categories-html.txt")
    with open(q, "w") as f:
        f.write("https://b.example/stiri/politica.html\n")
    assert read_categories(spark, q, slug_part=None).first().category_slug == "politica"


def test_href_and_attr_quoting(spark):
    from presslake.functions import html as H
    page = """<a href="/d">d</a><A HREF='/s'>s</A><a class=x href=/u>u</a><a name=n>no</a><img src='/i.png'>"""
    assert _one(spark, H.hrefs, page) == ["/d", "/s", "/u"]
    assert _one(spark, lambda c: H.attr_first(c, "img", "src"), page) == "/i.png"
    assert _one(spark, lambda c: H.attr_first(c, "img", "alt"), page) is None


@pytest.mark.parametrize("href,expected", [
    ("https://other.example/x", "https://other.example/x"),
    ("mailto:a@b.example", "mailto:a@b.example"),
    ("//cdn.example/i.png", "https://cdn.example/i.png"),
    ("/root", "https://h.example/root"),
    ("#frag", "https://h.example/dir/page?q=1#frag"),
    ("?p=2", "https://h.example/dir/page?p=2"),
    ("", "https://h.example/dir/page?q=1"),
    ("rel/x.html", "https://h.example/dir/rel/x.html"),
])
def test_absolutize_shapes(spark, href, expected):
    from presslake.functions.urls import absolutize
    df = spark.createDataFrame([(href, "https://h.example/dir/page?q=1#top")], "h string, b string")
    assert df.select(absolutize("h", "b").alias("u")).first().u == expected


def test_absolutize_host_only_base(spark):
    from presslake.functions.urls import absolutize
    df = spark.createDataFrame([("x", "https://h.example")], "h string, b string")
    assert df.select(absolutize("h", "b").alias("u")).first().u == "https://h.example/x"
