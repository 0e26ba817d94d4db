"""Column -> Column URL helpers (regex only, so the DuckDB oracle can mirror them)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions.text import col_, py_strip

# ---- fixed values -------------------------------------------------------
DOTS_RE = r"(^|/)\.\.?(/|$|[?#])"
SCHEME_HOST_RE = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)"
HOST_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)"
# -------------------------------------------------------------------------


def host(c) -> Column:
    """Lower-cased host of an absolute URL ('' when not absolute)."""
    return F.lower(F.regexp_extract(col_(c), HOST_RE, 1))


def scheme_host(c) -> Column:
    return F.regexp_extract(col_(c), SCHEME_HOST_RE, 1)


def strip_fragment(c) -> Column:
    return F.regexp_replace(col_(c), r"#.*$", "")


def strip_query(c) -> Column:
    return F.regexp_replace(col_(c), r"\?.*$", "")


def normalize_url(c, keep_query: bool = True) -> Column:
    """O-F14: the key used for dedup / resume / upsert.

    Trims white space, lower-cases scheme and host, drops the fragment,
    collapses doubled slashes in the path (Q20: ``https://h//arhiva``), and
    drops a trailing slash.  The query is kept by default: ``?page=2`` names a
    different listing page.
    """
    u = strip_fragment(py_strip(col_(c)))
    if not keep_query:
        u = strip_query(u)
    sh = F.regexp_extract(u, SCHEME_HOST_RE, 1)
    rest = F.substr(u, F.length(sh) + 1)
    path = F.regexp_extract(rest, r"^([^?]*)", 1)
    query = F.regexp_extract(rest, r"(\?.*)$", 1)
    path = F.regexp_replace(path, "/{2,}", "/")
    path = F.regexp_replace(path, "(.)/$", "$1")
    path = F.when(path == "/", F.lit("")).otherwise(path)
    return F.concat(F.lower(sh), path, query)


def base_parts(base_url) -> Column:
    """The parts of a base URL that link resolution needs, as one struct —
    computed once per page, before its links are exploded."""
    b = col_(base_url)
    sh = scheme_host(b)
    nofrag = strip_fragment(b)
    path = strip_query(nofrag)
    # directory of the base path, taken after scheme+host ("" → "/")
    rest_dir = F.regexp_replace(F.substr(path, F.length(sh) + 1), r"[^/]*$", "")
    bdir = F.concat(sh, F.when(rest_dir == "", F.lit("/")).otherwise(rest_dir))
    return F.struct(sh.alias("sh"), F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1).alias("scheme"),
                    nofrag.alias("nofrag"), path.alias("path"), bdir.alias("dir"))


def remove_dots(url) -> Column:
    """Resolve the ``.`` and ``..`` segments of an absolute URL's path, as
    browsers do; URLs without such segments are returned as they are."""
    u = col_(url)
    sh = scheme_host(u)
    rest = F.substr(u, F.length(sh) + 1)
    path = F.regexp_extract(rest, r"^([^?#]*)", 1)
    tail = F.substr(rest, F.length(path) + 1)
    parts = F.slice(F.split(path, "/"), 2, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(1)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, x: (
        F.when(x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).when(x == ".", a).otherwise(F.array_append(a, x))))
    closed = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    done = F.concat(sh, F.lit("/"), F.array_join(kept, "/"), closed, tail)
    return F.when((sh != "") & path.rlike(r"/\.\.?(/|$)"), done).otherwise(u)


def absolutize_with(href, parts) -> Column:
    """O-X15 with precomputed :func:`base_parts`: browser-style ``a.href``.

    absolute → as is; ``//h/x`` → base scheme; ``/x`` → scheme+host; ``#f`` →
    base without fragment + ``#f``; ``?q`` → base path + ``?q``; relative →
    base directory + href; ``./`` and ``../`` are resolved."""
    h = col_(href)
    full = _joined(h, parts)
    return F.when(h.rlike(DOTS_RE), remove_dots(full)).otherwise(full)


def absolutize_all(hrefs, parts) -> Column:
    """:func:`absolutize_with` of every element of an array.  Joining and
    resolving dots are two passes, so neither repeats the other's expression."""
    full = F.transform(col_(hrefs), lambda h: F.struct(h.rlike(DOTS_RE).alias("dots"), _joined(h, parts).alias("u")))
    return F.transform(full, lambda x: F.when(x["dots"], remove_dots(x["u"])).otherwise(x["u"]))


def _joined(h: Column, parts) -> Column:
    p = col_(parts)
    return (F.when(h.isNull(), F.lit(None).cast("string"))
            .when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
            .when(h.startswith("//"), F.concat(p["scheme"], F.lit(":"), h))
            .when(h.startswith("/"), F.concat(p["sh"], h))
            .when(h.startswith("#"), F.concat(p["nofrag"], h))
            .when(h.startswith("?"), F.concat(p["path"], h))
            .when(h == "", p["nofrag"])
            .otherwise(F.concat(p["dir"], h)))


def with_page_base(df, url: str = "url", clean: str = "clean", out: str = "_base"):
    """``df`` with :func:`base_parts` of each page as column ``out``: of its
    ``<base href>`` if it has one (itself relative to the page's URL), else of
    its URL.  Each step is a column of its own, so no expression is repeated
    inside another."""
    from presslake.functions.html import attr_first
    own = df.withColumn("_own", attr_first(clean, "base", "href")).withColumn("_from", base_parts(url))
    base = F.when(F.col("_own").isNull(), F.col(url)).otherwise(absolutize_with("_own", "_from"))
    return own.withColumn("_base_url", base).withColumn(out, base_parts("_base_url")).drop("_own", "_from", "_base_url")


def absolutize(href, base_url) -> Column:
    """O-X15 for a single (href, base) pair; see :func:`absolutize_with`."""
    return absolutize_with(href, base_parts(base_url))
