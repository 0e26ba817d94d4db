"""DuckDB SQL text for the oracle side.

These builders write the *same semantics* as the Spark helpers in plain SQL,
independently of Catalyst, so a Spark result can be checked against them.
"""

from __future__ import annotations

# ---- fixed values, stated here anew: the oracle shares no pattern with the engine
_CLEAN = r"(?is)<(?:script\b.*?(?:</script>|\z)|style\b.*?(?:</style>|\z)|!--.*?(?:-->|\z))"
_VALUE = r"""[ \t\n\f\r]*=[ \t\n\f\r]*("[^"]*"|'[^']*'|[^"'\t\n\f\r >]+)"""
_ORIGIN = "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)"
# The references that occur in the test pages ('&amp;' last).
_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&"))
# What Python's str.strip() removes.
_SPACES = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
# ---------------------------------------------------------------------------


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean(x: str = "html") -> str:
    return f"regexp_replace({x}, {lit(_CLEAN)}, '', 'g')"


def strip(x: str) -> str:
    return f"trim({x}, {lit(_SPACES)})"


def decode(x: str) -> str:
    for ent, ch in _REFERENCES:
        x = f"replace({x}, {lit(ent)}, {lit(ch)})"
    return x


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]*>', '', 'g')"


def text_of(x: str) -> str:
    return decode(strip_tags(x))


def inner_first(x: str, tag: str, attrs: str = "[^>]*") -> str:
    pat = f"(?is)<{tag}\\b{attrs}>(.*?)(?:</{tag}>|\\z)"
    return f"CASE WHEN regexp_matches({x}, {lit(f'(?is)<{tag}\\b{attrs}>')}) THEN regexp_extract({x}, {lit(pat)}, 1) END"


def outer_first(x: str, tag: str, attrs: str = "[^>]*") -> str:
    pat = f"(?is)(<{tag}\\b{attrs}>.*?(?:</{tag}>|\\z))"
    return f"CASE WHEN regexp_matches({x}, {lit(f'(?is)<{tag}\\b{attrs}>')}) THEN regexp_extract({x}, {lit(pat)}, 1) END"


def first_text(x: str, tag: str) -> str:
    return strip(text_of(inner_first(x, tag)))


def unquote(v: str) -> str:
    return f"CASE WHEN left({v}, 1) IN ('\"', '\'\'') THEN {v}[2:-2] ELSE {v} END"


def attr_first(x: str, tag: str, attr: str) -> str:
    pat = f"(?is)<{tag}\\b[^>]*?\\b{attr}{_VALUE}"
    return f"CASE WHEN regexp_matches({x}, {lit(pat)}) THEN {unquote(f'regexp_extract({x}, {lit(pat)}, 1)')} END"


def hrefs(x: str) -> str:
    return f"list_transform(regexp_extract_all({x}, {lit('(?i)<a\\b[^>]*?\\bhref' + _VALUE)}, 1), lambda v: {unquote('v')})"


def paragraphs(article: str) -> str:
    parts = f"regexp_split_to_array(coalesce({article}, ''), '(?i)<p\\b[^>]*>')"
    return f"list_transform(({parts})[2:], lambda s: {strip(text_of("regexp_extract(s, '(?is)^(.*?)(?:</p>|$)', 1)"))})"


def host(url: str) -> str:
    return f"lower(regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1))"


def scheme_host(url: str) -> str:
    return f"regexp_extract({url}, {lit(_ORIGIN)}, 1)"


def normalize_url(x: str) -> str:
    """SQL twin of ``functions.urls.normalize_url`` (single expression)."""
    s = f"regexp_replace({strip(x)}, '#.*$', '')"
    sh = f"regexp_extract({s}, {lit(_ORIGIN)}, 1)"
    rest = f"substring({s}, length({sh}) + 1)"
    path = f"regexp_replace(regexp_extract({rest}, '^([^?]*)', 1), '/{{2,}}', '/', 'g')"
    path = f"regexp_replace({path}, '(.)/$', '\\1')"
    query = f"regexp_extract({rest}, '(\\?.*)$', 1)"
    return f"(lower({sh}) || CASE WHEN {path} = '/' THEN '' ELSE {path} END || {query})"
