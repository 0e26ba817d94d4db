"""Column -> Column string helpers (all Catalyst built-ins, codegen friendly)."""

from __future__ import annotations

from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------
# Characters Python's str.strip()/str.isspace() treat as white space.  Spark's
# trim removes only ' ', so this class is used instead (written with \x{..}
# escapes so the same pattern text runs in Java regex and in RE2).
PY_SPACE = (r"[ \t\n\x{0b}\x{0c}\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
PY_STRIP_RE = f"^{PY_SPACE}+|{PY_SPACE}+\\z"
# The same set as characters, for ``btrim`` (looks only at the two ends).
PY_SPACE_CHARS = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
                  + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")

# Character references by number that HTML reads as Windows-1252 (or replaces).
C1_BYTES = range(0x80, 0xA0)
# Line separators of Python's str.splitlines() beyond \n, \r, \r\n.
SPLITLINES_RE = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"
# -------------------------------------------------------------------------


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """O-F5 / Q10: Python ``str.strip()`` (all Unicode white space).

    ``btrim`` with the explicit character set: it inspects only the two
    ends, where an end-anchored regex would be tried at every white-space
    position of a long text."""
    return F.btrim(col_(c), F.lit(PY_SPACE_CHARS))


REFERENCE_RE = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


@cache
def _named() -> str:
    """Name and text of every HTML entity that ends in ``;`` (the standard
    library's table), as one constant for ``str_to_map``."""
    return "\x01".join(f"{k[:-1]}\x02{v}" for k, v in html5.items() if k.endswith(";"))


@cache
def _c1() -> str:
    """What the numbers 128 to 159 stand for in HTML, likewise."""
    return "\x01".join(f"{b}\x02{bytes([b]).decode('cp1252', 'ignore') or chr(b)}" for b in C1_BYTES)


def _in_map(table: str, key: Column) -> Column:
    return F.try_element_at(F.str_to_map(F.lit(table), F.lit("\x01"), F.lit("\x02")), key)


def _referred(ref: Column) -> Column:
    """The text of one reference (without ``&`` and ``;``); unknown names stay."""
    hexed = F.when(F.substr(ref, F.lit(2), F.lit(1)).isin("x", "X"), F.substr(ref, F.lit(3)))
    code = F.coalesce(F.conv(hexed, 16, 10), F.substr(ref, F.lit(2))).try_cast("int")
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    number = (F.when(code.between(0x80, 0x9F), _in_map(_c1(), code.cast("string")))
              .when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("\ufffd")).otherwise(char))
    name = (F.when(ref == "amp", F.lit("&")).when(ref == "quot", F.lit('"')).when(ref == "lt", F.lit("<")).when(ref == "gt", F.lit(">"))
            .when(ref == "nbsp", F.lit("\u00a0")).otherwise(_in_map(_named(), ref)))
    return F.when(ref.startswith("#"), number).otherwise(F.coalesce(name, F.concat(F.lit("&"), ref, F.lit(";"))))


def decode_entities(c) -> Column:
    """O-F21: decode every character reference that ends in ``;`` — all named
    ones of HTML and those by decimal or hexadecimal number — in one pass
    (``&amp;lt;`` gives ``&lt;``).  Text without one is returned as it is."""
    t = col_(c)
    refs = F.transform(F.regexp_extract_all(t, F.lit(REFERENCE_RE), 1), _referred)
    pieces = F.split(t, REFERENCE_RE)
    joined = F.array_join(F.zip_with(pieces, refs, lambda p, r: F.concat(p, F.coalesce(r, F.lit("")))), "")
    return F.when(t.rlike(REFERENCE_RE), joined).otherwise(t)


def strip_tags(c) -> Column:
    return F.regexp_replace(col_(c), r"<[^>]*>", "")


def split_last(c, sep: str) -> Column:
    """O-F1: ``x.split(sep)[-1]`` (sep taken literally)."""
    import re
    return F.element_at(F.split(col_(c), re.escape(sep)), -1)


def split_get(c, sep: str, idx: int) -> Column:
    """O-F2: ``x.split(sep)[idx]``, NULL when out of range (``get`` is NULL-safe)."""
    import re
    return F.get(F.split(col_(c), re.escape(sep)), idx)


def path_tail_name(c, start: int = 5, strip_query: bool = True) -> Column:
    """O-F3/O-F4 and Q9: ``"_".join(url.split("/")[start:])`` with the query cut."""
    parts = F.split(col_(c), "/")
    name = F.array_join(F.slice(parts, start + 1, F.greatest(F.size(parts) - start, F.lit(1))), "_")
    name = F.when(F.size(parts) > start, name).otherwise(F.lit(""))
    if strip_query:
        name = F.split_part(name, F.lit("?"), F.lit(1))
    return name


def remove_prefix(c, prefix: str) -> Column:
    """O-F8: ``x.removeprefix(prefix)``."""
    c = col_(c)
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def strip_chars(c, chars: str) -> Column:
    """O-F6: ``x.strip(chars)``."""
    return F.btrim(col_(c), F.lit(chars))


def try_int(c, strict: bool = False) -> Column:
    """O-F12: ``int(text)``; lenient → NULL, strict → error (ANSI cast)."""
    c = py_strip(c)
    return c.cast("int") if strict else c.try_cast("int")


def last_word(c) -> Column:
    """Last blank-separated word (``split(' ')[-1]``)."""
    return F.element_at(F.split(col_(c), " "), -1)


def splitlines(c) -> Column:
    """Q14: Python ``str.splitlines()`` as an array (trailing break adds no item)."""
    c = col_(c)
    body = F.regexp_replace(c, f"({SPLITLINES_RE})\\z", "")
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(body, SPLITLINES_RE))
