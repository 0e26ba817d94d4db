"""Operator 5, HTML extraction: consensus host paths.

A page's containers (body, article, div and their like) are scored by the share
of the page's running text that they hold; links, menus and their like don't
count.  Containers are named by their path of tags and classes, generalised:
digits become ``0``.  Each page's shares are votes that Spark adds up by host,
template (the page's outer containers) and path, and by host and path.  Winning
paths are those that hold most of the text of the pages where they occur,
deepest first; a template's own come before its host's.  Every page is then
read again: its text is taken from the containers at the first winning path
that it has, with the article around them and the headings and paragraphs
beside them.

Two passes over the pages, without a shuffle of page contents as long as the
winning paths are few enough to broadcast (which is checked); beyond, pages
are read a third time for their templates and joined with the winners.
"""

from __future__ import annotations

import hashlib
import html as _html
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslake.llm.common import BROADCAST_ROWS, importable, stage
from presslake.llm.hostrank import host_of

HOLDS = 0.7         #: share of a page's text that a winning path holds on average
SEEN = 0.1          #: share of a host's pages in which it occurs
WINNERS = 8         #: winning paths of a host or template that are kept, deepest first
OUTER = 4           #: containers down to this depth make up a page's template
ALIKE = 3           #: pages from which a template's winners come before its host's
SALTS = 16
WINNER_ROWS = 20_000    #: hosts and templates whose winning paths travel to the tasks; more are joined
DEPTH = 512         #: elements nested deeper are not told apart

CONTAINERS = frozenset("html body main article section div td center form fieldset details".split())
#: Elements that end a block where they begin and end.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option
p pre section select summary table tbody tfoot thead title tr ul""".split())
#: Elements within which nothing is running text.
DROPPED = frozenset("""head title script style noscript template iframe object svg math canvas audio video select
button textarea""".split())
#: Elements that are dropped unless the page has no other text.
ASIDE = frozenset("nav header footer aside menu dialog".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of classes, ids and roles of what isn't the article.
HINTS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu
nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert
comment comments disqus respond reply replies share sharing social related recommended newsletter subscribe subscription
signup login popup modal overlay search widget pagination pager toolbar complementary contentinfo""".split())
#: Elements whose text beside the winning containers belongs to the article.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre li dd dt figcaption caption".split())
#: Largest share of the page's text that is dropped with an element whose class,
#: id or role has a whole word of HINTS; with such an element around a heading or
#: an article, a hidden one or a form; and with one that only has such a word as
#: a part of another.
NAMED, SHARE, PART_SHARE = 0.9, 0.5, 0.2
#: Elements that end an open p.
ENDS_P = BLOCKS - {"body", "html", "head", "title", "option", "optgroup"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/><]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/><]*)(?P<attrs2>[^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*\Z", re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|[\"'/=>]")
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
_DIGITS = re.compile(r"\d+")


class Page:
    """One reading of a page: its elements and text runs, in page order.

    ``tags``, ``paths`` (of the innermost container), ``parents`` and
    ``dropped`` describe element i; ``limits`` has the largest share of the
    page's text with which element i is dropped (0: it isn't);
    ``runs`` holds (element, text, in a link), or None where a block ends."""

    def __init__(self, source: str):
        self.tags, self.paths, self.parents, self.dropped = [""], [""], [-1], [False]
        self.limits = [0.0]
        self.runs: list[tuple[int, str, bool] | None] = []
        self._read(source)
        if any(self.limits):
            self._drop()

    def _sizes(self) -> list[int]:
        """Characters of running text within each element."""
        own = [0] * len(self.tags)
        for r in self.runs:
            if r and not r[2]:
                own[r[0]] += sum(map(len, r[1].split()))
        for i in range(len(own) - 1, 0, -1):  # children come after their parents
            own[self.parents[i]] += own[i]
        return own

    def _drop(self) -> None:
        """Drop what isn't the article by its name, unless too much is in it."""
        every, off = self.runs, list(self.dropped)
        around = [False] * len(off)           # around a heading or an article
        for i in range(len(off) - 1, 0, -1):
            around[self.parents[i]] = around[self.parents[i]] or around[i] or self.tags[i] in ("h1", "main", "article")
        limits = [min(x, SHARE) if x < 1 and around[i] else x for i, x in enumerate(self.limits)]
        for least in (1.0, 0.0):              # shares are those of the text outside ASIDE
            sizes = self._sizes()
            for i in range(1, len(off)):
                off[i] = off[i] or off[self.parents[i]] or (limits[i] > 0 and limits[i] >= least and sizes[i] <= limits[i] * sizes[0])
            self.runs = [r for r in every if r is None or not off[r[0]]]
        if any(r and not r[1].isspace() for r in self.runs):
            self.dropped = off
        else:                                 # nothing would be left
            self.runs = every

    def _read(self, source: str) -> None:
        stack, links, at, runs = [0], 0, 0, self.runs
        tags = self.tags
        pos, n = 0, len(source)
        search = _TOKEN.search
        while pos < n:
            m = search(source, pos)
            if m is None:
                self._text(source[pos:], stack[-1], links)
                break
            if m.start() > pos:
                self._text(source[pos:m.start()], stack[-1], links)
            pos = m.end()
            tag = m["tag"] or m["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            if m["close"] or m["close2"]:
                if tag in BLOCKS:
                    runs.append(None)
                elif tag in ("td", "th"):
                    runs.append((stack[-1], " ", False))
                # Formatting left open ends with the element around it; an end tag never closes past a container of other kind.
                for k in range(len(stack) - 1, 0, -1):
                    t = tags[stack[k]]
                    if t == tag:
                        links -= sum(tags[i] == "a" for i in stack[k:])
                        del stack[k:]
                        break
                    if t in ("td", "th", "table", "article", "main") and tag not in ("body", "html", "table", "tr", "article", "main", "section", "div"):
                        break
                continue
            if tag in ENDS_P:
                for k in range(len(stack) - 1, 0, -1):
                    t = tags[stack[k]]
                    if t == "p" or (t == tag and tag in ("li", "dd", "dt", "tr")):
                        links -= sum(tags[i] == "a" for i in stack[k:])
                        del stack[k:]
                        break
                    if t in BLOCKS or t in ("td", "th"):
                        break
            elif tag in ("td", "th") and tags[stack[-1]] in ("td", "th"):
                stack.pop()
            if tag in BLOCKS:
                runs.append(None)
            elif tag in ("br", "td", "th"):
                runs.append((stack[-1], " ", False))
            if tag in VOID or len(stack) > DEPTH and tag not in RAW:
                continue                      # too deep: its content counts as the parent's, as in browsers
            attrs = m["attrs"] or m["attrs2"] or ""
            top = stack[-1]
            name, off = tag, self.dropped[top] or tag in DROPPED
            limit = 1.0 if tag in ASIDE else SHARE if tag == "form" else 0.0
            if attrs:
                kinds = []
                for a in _ATTR.finditer(attrs):
                    attr = (a[1] or "").lower()
                    if attr == "hidden" or (attr == "style" and _HIDDEN.search(a[2] or a[3] or a[4] or "")):
                        if tag not in ("html", "body"):
                            limit = max(limit, SHARE)
                    elif attr in ("class", "id", "role"):
                        words = (a[2] or a[3] or a[4] or "").lower().split()
                        if attr == "class":
                            kinds += words
                        if not off and tag not in ("html", "body", "main", "article"):
                            limit = max(limit, NAMED if not HINTS.isdisjoint(words) else PART_SHARE if any(not HINTS.isdisjoint(_WORD.findall(w)) for w in words) else 0.0)
                if kinds:
                    name += "." + ".".join(sorted({_DIGITS.sub("0", k) for k in kinds}))
            if attrs.rstrip().endswith("/") and tag not in CONTAINERS and tag not in BLOCKS:
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, pos)
                pos = end.end() if end else n
                continue
            tags.append(tag)
            self.paths.append(f"{self.paths[top]}>{name}" if tag in CONTAINERS else self.paths[top])
            self.parents.append(top)
            self.dropped.append(off)
            self.limits.append(limit)
            stack.append(len(tags) - 1)
            links += tag == "a"

    def _text(self, text: str, element: int, links: int) -> None:
        if not self.dropped[element]:
            self.runs.append((element, _html.unescape(text) if "&" in text else text, links > 0))

    def shares(self) -> dict[str, float]:
        """The share of the page's running text under each container path."""
        own = self._sizes()
        total = own[0]
        if not total:
            return {}
        out: dict[str, float] = {}
        for i, n in enumerate(own):
            if n and (i == 0 or self.tags[i] in CONTAINERS):
                out[self.paths[i]] = out.get(self.paths[i], 0) + n / total
        return out

    def template(self) -> str:
        """Names the set of the page's outer containers."""
        outer = sorted({p for p in set(self.paths) if p.count(">") <= OUTER})
        return hashlib.blake2b("\n".join(outer).encode("utf-8", "replace"), digest_size=12).hexdigest()

    def text(self, path: str) -> str | None:
        """The text under the elements at ``path``; None if there are none."""
        inside = self._under([i for i, p in enumerate(self.paths) if p == path and (i == 0 or self.tags[i] in CONTAINERS)])
        return self._joined(inside) if any(inside) else None

    def article(self, path: str) -> str | None:
        """The text under the elements at ``path``, under the articles that
        they are in, and of the headings and paragraphs beside them: those of
        the containers around, those of other containers in the same one, and
        first headings in containers further out, but for the body's."""
        at = [i for i, p in enumerate(self.paths) if p == path and (i == 0 or self.tags[i] in CONTAINERS)]
        inside = self._under(at)
        if not any(inside) or not self._joined(inside):
            return None
        around: set[int] = set()
        next_to: set[int] = set()
        whole = set(at)
        for i in at:
            j = self.parents[i]
            near = True
            while j >= 0 and j not in around:
                if self.tags[j] in CONTAINERS:
                    around.add(j)
                    if near and self.tags[j] not in ("html", "body"):
                        next_to.add(j)
                    near = False
                    if self.tags[j] == "article":
                        whole.add(j)
                j = self.parents[j]
        inside = self._under(whole)
        if not around - whole:
            return self._joined(inside)
        # What each element is in: prose, a first heading, and the containers around.
        n = len(self.tags)
        prose, first, home, near = [False] * n, [False] * n, [0] * n, [False] * n
        below = [False] * n               # in a container around, but for the page and its body
        for i in range(1, n):
            up, tag = self.parents[i], self.tags[i]
            box = tag in CONTAINERS
            prose[i] = tag in PROSE or (prose[up] and not box)
            first[i] = tag == "h1" or (first[up] and not box)
            home[i] = i if box else home[up]
            near[i] = near[up] or i in next_to
            below[i] = below[up] or (i in around and tag not in ("html", "body"))
        beside = [not inside[i] and prose[i] and (home[i] in around or near[i] or (first[i] and below[i])) for i in range(n)]
        return self._joined(inside, beside)

    def _under(self, elements) -> list[bool]:
        inside = [False] * len(self.tags)
        for i in elements:
            inside[i] = True
        for i in range(1, len(inside)):
            inside[i] = inside[i] or inside[self.parents[i]]
        return inside

    def _joined(self, inside: list[bool], beside: list[bool] | None = None) -> str:
        """The blocks of text in the elements ``inside``, and those in elements
        ``beside`` unless all of the block is links."""
        blocks, parts, running = [], [], False
        for r in [*self.runs, None]:
            if r is None:
                if running and (block := " ".join("".join(parts).split())):
                    blocks.append(block)
                parts, running = [], False
            elif inside[r[0]]:
                parts.append(r[1])
                running = True
            elif beside and beside[r[0]]:
                parts.append(r[1])
                running = running or not (r[2] or r[1].isspace())
        return "\n".join(blocks)


def extract(source: str | Page, winners: list[str]) -> str:
    """The text of a page at the first of the paths at which it has text, else
    all its running text; what was dropped by its name counts again if the
    page would have no text without it."""
    page = source if isinstance(source, Page) else Page(source)
    for path in winners:
        if text := page.article(path):
            return text
    return page.text("") or ""


def vote(pages: DataFrame) -> DataFrame:
    """host, template, path, votes (sum of shares, in millionths) and pages,
    added up over all pages."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            hosts, kinds, paths, shares = [], [], [], []
            for h, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not s:
                    continue
                page = Page(s)
                kind = page.template()
                for p, v in page.shares().items():
                    hosts.append(h)
                    kinds.append(kind)
                    paths.append(p)
                    shares.append(round(v * 1_000_000))  # whole numbers: the sum is the same in any order
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(kinds, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.int64())], names=["host", "template", "path", "share"])

    importable(pages.sparkSession)
    ballots = pages.select(host_of(F.coalesce(F.col("url"), F.lit(""))).alias("host"), "html").mapInArrow(run, "host string, template string, path string, share long")
    return ballots.groupBy("host", "template", "path").agg(F.sum("share").alias("votes"), F.count("*").alias("pages"))


def winning_paths(votes: DataFrame, holds: float = HOLDS, seen: float = SEEN, most: int = WINNERS) -> DataFrame:
    """host, template (null: of all the host's pages) and their winning
    ``paths``, deepest first (at most ``most``; the page as a whole is always
    the last resort), and ``alike``: whether the template has ALIKE pages."""
    of_host = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("pages").alias("pages"))
    # A template's paths occur on all its pages or are rare in it: none is left out for that.
    both = votes.select("host", "template", "path", "votes", "pages").unionByName(
        of_host.select("host", F.lit(None).cast("string").alias("template"), "path", "votes", "pages"))
    of = both.where("path = ''").select(F.col("host").alias("h"), F.coalesce("template", F.lit("")).alias("t"), F.col("pages").alias("all"))
    good = (both.withColumn("_k", F.coalesce("template", F.lit(""))).where((F.col("votes") >= holds * 1e6 * F.col("pages")) & (F.col("path") != ""))
            .join(of, (F.col("host") == F.col("h")) & (F.col("_k") == F.col("t")))
            .where(F.col("template").isNotNull() | (F.col("pages") >= seen * F.col("all"))))
    depth = F.size(F.split("path", ">"))
    order = Window.partitionBy("host", "_k").orderBy(depth.desc(), F.desc("votes"), "path")
    return (good.withColumn("k", F.row_number().over(order)).where(F.col("k") <= most)
            .groupBy("host", "template").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "path"))), lambda x: x["path"]).alias("paths"),
                                             (F.max("all") >= ALIKE).alias("alike")))


def _with_paths(rows: DataFrame, winners: DataFrame, keys: list[str]) -> DataFrame:
    """Join rows with winners on ``keys``: broadcast if the winners are few,
    else by a salt too, so that a hot host's pages spread over the salts."""
    if winners.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(winners), keys, "left")
    salted = winners.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("_t", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return rows.join(salted, [*keys, "_t"], "left").drop("_t")


def _templated(pages: DataFrame) -> DataFrame:
    """page_id, url, html, _host and _template of every page (no html: none)."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            kinds = [Page(s).template() if s else None for s in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(kinds, pa.string())], names=[*b.schema.names, "_template"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return (pages.select("page_id", "url", "html", host_of(F.coalesce(F.col("url"), F.lit(""))).alias("_host"))
            .mapInArrow(run, f"page_id {kind}, url string, html string, _host string, _template string"))


def _extract_known(pages: DataFrame, winners: DataFrame) -> DataFrame:
    """The texts of all pages, each read once: the winning paths (at most
    WINNER_ROWS rows) travel to the tasks."""
    spark = pages.sparkSession
    known = {(r["host"], r["template"]): (r["paths"], r["alike"]) for r in winners.collect()}
    sent = spark.sparkContext.broadcast(known)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = []
            for h, s in zip(b.column(3).to_pylist(), b.column(2).to_pylist(), strict=True):
                if not s:
                    texts.append("")
                    continue
                page = Page(s)
                host, _ = sent.value.get((h, None), ([], False))
                own, alike = sent.value.get((h, page.template()), ([], False))
                texts.append(extract(page, [*own, *host] if alike else [*host, *own]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    importable(spark)
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", "url", "html", host_of(F.coalesce(F.col("url"), F.lit(""))).alias("_host"))
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def extract_pages(pages: DataFrame) -> DataFrame:
    """The main text of every row of ``pages`` (page_id, url, html).

    Returns page_id, url, text and n_chars (code points).  Null or empty html
    and pages without running text give empty text; pages without a host vote
    together; repeated rows are read alike; an empty table gives none."""
    winners = stage(winning_paths(stage(vote(pages), "votes")), "winning-paths")
    if winners.count() <= WINNER_ROWS:
        return _extract_known(pages, winners)
    of_host = winners.where("template is null").select(F.col("host").alias("_host"), F.col("paths").alias("_h_paths"))
    of_template = winners.where("template is not null").select(F.col("host").alias("_host"), F.col("template").alias("_template"), F.col("paths").alias("_t_paths"), "alike")
    rows = _with_paths(_templated(pages), of_host, ["_host"])
    rows = _with_paths(rows, of_template, ["_host", "_template"])
    none = F.array().cast("array<string>")
    host, own = F.coalesce("_h_paths", none), F.coalesce("_t_paths", none)
    rows = rows.withColumn("paths", F.when(F.col("alike"), F.concat(own, host)).otherwise(F.concat(host, own)))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = [extract(s, p or []) if s else "" for s, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.select("page_id", "url", "html", "paths").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
