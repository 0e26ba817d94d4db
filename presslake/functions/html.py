"""Token path: HTML field extraction as Catalyst expressions (no Python).

Harvested markup is broken (unclosed ``<p>``/``<b>``, cut-off tails, ``</p>``
inside script strings), so nothing here pairs tags by regex.  The page is
cleaned once (script, style and comments removed), then every field is a
``regexp_extract`` / ``split`` over the cleaned text.  Presence is tested
separately from the value (Q7): a present-but-empty element gives ``''``, an
absent one gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions.text import col_, decode_entities, py_strip, strip_tags

# ---- fixed values -------------------------------------------------------
# common "<" prefix factored out: only "<" positions try the alternatives
# (no repeated groups: Java's regex engine recurses on those and overflows
# its stack on multi-MB pages)
CLEAN_RE = r"(?is)<(?:script\b.*?(?:</script>|\z)|style\b.*?(?:</style>|\z)|!--.*?(?:-->|\z))"
# attribute value: double-quoted, single-quoted or bare (same text in Java
# regex and RE2: explicit white-space class, no \s)
_WS = "[ \\t\\n\\f\\r]"
_VAL = f"""{_WS}*={_WS}*("[^"]*"|'[^']*'|[^"'\\t\\n\\f\\r >]+)"""
UNQUOTE_RE = """^"(.*)"$|^'(.*)'$"""  # used with (?s): quoted values may span lines
HREF_RE = r"(?i)<a\b[^>]*?\bhref" + _VAL
# -------------------------------------------------------------------------


def clean_html(c) -> Column:
    """Drop script, style and comments (the only places markup-like text hides)."""
    return F.regexp_replace(col_(c), CLEAN_RE, "")


def inner_first(c, tag: str, attrs: str = r"[^>]*") -> Column:
    """Raw inner markup of the first ``<tag …>`` up to its close tag or the end
    of the text (cut-off pages), NULL when the tag is absent."""
    pat = f"(?is)<{tag}\\b{attrs}>(.*?)(?:</{tag}>|\\z)"
    c = col_(c)
    return F.when(c.rlike(f"(?is)<{tag}\\b{attrs}>"), F.regexp_extract(c, pat, 1))


def outer_first(c, tag: str, attrs: str = r"[^>]*") -> Column:
    """O-X19: outer markup of the first match (start tag to close tag)."""
    pat = f"(?is)(<{tag}\\b{attrs}>.*?(?:</{tag}>|\\z))"
    c = col_(c)
    return F.when(c.rlike(f"(?is)<{tag}\\b{attrs}>"), F.regexp_extract(c, pat, 1))


def text_of(markup) -> Column:
    """O-X18: ``get_text()`` of a markup fragment: tags removed, entities decoded."""
    return decode_entities(strip_tags(markup))


def first_text(c, tag: str, default: str | None = None, strip: bool = True) -> Column:
    """O-X1/O-X2: text of the first ``tag`` or ``default`` when absent."""
    t = text_of(inner_first(c, tag))
    if strip:
        t = py_strip(t)
    return F.coalesce(t, F.lit(default)) if default is not None else t


def attr_pattern(tag: str, attr: str) -> str:
    return f"(?is)<{tag}\\b[^>]*?\\b{attr}{_VAL}"


def unquote(v) -> Column:
    """Drop the quotes around an attribute value (``"x"`` / ``'x'`` → ``x``)."""
    return F.regexp_replace(col_(v), "(?s)" + UNQUOTE_RE, "$1$2")


def attr_first(c, tag: str, attr: str) -> Column:
    """Value of ``attr`` on the first ``tag`` carrying it (NULL when none);
    the value may be double-, single- or un-quoted."""
    pat = attr_pattern(tag, attr)
    c = col_(c)
    return F.when(c.rlike(pat), decode_entities(unquote(F.regexp_extract(c, pat, 1))))


def hrefs(c) -> Column:
    """O-X14: every ``href`` of ``<a>`` in document order (array); values may
    be double-, single- or un-quoted, character references are decoded."""
    raw = F.regexp_extract_all(col_(c), F.lit(HREF_RE), 1)
    # one pass over the page; only values that start with a quote need work
    return F.transform(raw, lambda v: decode_entities(F.when(v.rlike("^[\"']"), unquote(v)).otherwise(v)))


def paragraphs(article_markup, drop_blank: bool = False) -> Column:
    """O-X16: paragraph texts in order.

    A ``<p>`` starts a paragraph and ends at the next ``<p>``, ``</p>`` or the
    end of the fragment (implied end tags), which is how a browser closes the
    unclosed ``<p><b>…<br><p>`` pattern.  Missing body → empty array (Q6).

    Written as whole-string regex steps (no per-element lambda), so it stays
    inside whole-stage codegen: each ``<p>`` becomes a separator, text after a
    ``</p>`` up to the next separator is cut, tags are stripped, entities
    decoded, white space stripped around separators, then one ``split``.
    """
    sep = "\u0001"
    a = F.replace(F.coalesce(col_(article_markup), F.lit("")), F.lit(sep), F.lit(""))
    s = F.regexp_replace(a, r"(?i)<p\b[^>]*>", sep)
    s = F.substr(s, F.instr(s, sep))                           # drop text before the first <p>
    # one pass: text after a </p> (up to the next paragraph) and tags inside a paragraph
    s = F.regexp_replace(s, r"(?i)</p>[^\x{01}]*|<[^>\x{01}]*>", "")
    s = decode_entities(F.substr(s, F.lit(2)))                  # drop the leading separator
    # split, then strip each paragraph (btrim looks only at its two ends)
    texts = F.when(a.rlike(r"(?i)<p\b"), F.transform(F.split(s, "\\x{01}"), py_strip)).otherwise(
        F.array().cast("array<string>"))
    if drop_blank:
        texts = F.array_remove(texts, "")
    return texts


def html_lang(c) -> Column:
    return attr_first(c, "html", "lang")
