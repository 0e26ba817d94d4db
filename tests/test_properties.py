"""Property tests: the Python-compatible helpers agree with Python itself on
generated strings (one Spark job per property, many examples)."""

import html as pyhtml
from html.entities import html5

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presslake.functions.text import decode_entities, py_strip, splitlines
from presslake.functions.urls import normalize_url

SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0       　"
text = st.text(alphabet=st.sampled_from(list(SPACES) + list("ab é-çx")), max_size=12)
REFERENCES = [f"&{n}" for n in sorted(html5) if n.endswith(";")][::7] + ["&#8211;", "&#537;", "&#x219;", "&#128;", "&#0;", "&#xD800;", "&#1114112;", "&#x1F600;", "&nosuch;"]
SETTINGS = dict(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))


def _run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


@settings(**SETTINGS)
@given(st.lists(text, min_size=200, max_size=200))
def test_strip_matches_python(spark, values):
    assert _run(spark, values, py_strip) == [v.strip() for v in values]


@settings(**SETTINGS)
@given(st.lists(text, min_size=200, max_size=200))
def test_splitlines_matches_python(spark, values):
    assert _run(spark, values, splitlines) == [v.splitlines() for v in values]


@settings(**SETTINGS)
@given(st.lists(st.lists(st.sampled_from(REFERENCES + ["&amp;", "&lt;", "&quot;", "&nbsp;", "&copy;"] * 20 + ["a", " ", "& ", ";"] * 20), max_size=6)
                .map("".join), min_size=200, max_size=200))
def test_entities_match_python(spark, values):
    assert _run(spark, values, decode_entities) == [pyhtml.unescape(v) for v in values]


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["http", "HTTPS"]), st.sampled_from(["a.example", "B.Example"]),
                          st.lists(st.sampled_from(["x", "", "y"]), max_size=4),
                          st.sampled_from(["", "?p=1", "#f", "?q=2#g"]))
                .map(lambda t: f"{t[0]}://{t[1]}/{'/'.join(t[2])}{t[3]}"), min_size=100, max_size=100))
def test_normalize_is_idempotent(spark, values):
    once = _run(spark, values, normalize_url)
    assert _run(spark, once, normalize_url) == once
    assert all("#" not in u and "//" not in u.split("://", 1)[1] for u in once)
