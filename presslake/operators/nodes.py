"""Node path: shred pages, and match compiled selectors, inside the tasks that read them.

One ``mapInArrow`` pass runs the standard-library HTML tokenizer per page
(with HTML's implied end tags) and keeps the page as flat columns: a node has
its pre-order number ``pre``, its last descendant ``end`` (so "A contains B" is
``A.pre < B.pre <= A.end``), its ``parent``, its place among its element
siblings, and offsets into one text of the page.  Nothing is repeated per
ancestor, so a page costs time and memory in proportion to its size, however
deep it nests.

Selectors are matched in that pass by one automaton for all of them
(:class:`Program`): a node's state follows from its parent's and its previous
sibling's, by a few operations on bit sets.  Only matches leave the task —
or, for a record spec, one row per page — so selectors need no shuffle.

``shred`` gives the node table itself: page_id, pre, end, parent, depth, kind
('element' | 'text' | 'error'), tag, attrs MAP, sib (1-based place among
element siblings), is_last, prev (the element sibling before it), text_start /
text_end (the span of ``get_text()`` in the page's text, script / style
excluded), text (of a text node; the page's text is their concatenation) and
src_start / src_end (the element's markup in the page).
"""

from __future__ import annotations

import re
import sys
from html.parser import HTMLParser

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ship this module's code inside the task closure (pickle by value), so
# executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- fixed values -------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Start tags that close an open <p> (HTML's "close a p element").
CLOSES_P = frozenset(("address article aside blockquote details dialog div dl fieldset figcaption "
                      "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre "
                      "section table ul li").split())
# Elements that bound the search for an open <p>, and for the other tags that are closed by implication.
P_SCOPE = frozenset("applet caption html table td th marquee object template button".split())
SCOPES = {"p": P_SCOPE, "li": P_SCOPE | {"ol", "ul"}, "dl": P_SCOPE | {"dl"}, "row": frozenset(("table", "tr")),
          "table": frozenset(("table",)), "select": frozenset(("select",))}
# Start tag -> the open elements that it closes, and the scope of the search.
IMPLIED = {"li": (("li",), "li"), "dd": (("dd", "dt"), "dl"), "dt": (("dd", "dt"), "dl"), "tr": (("tr",), "table"),
           "td": (("td", "th"), "row"), "th": (("td", "th"), "row"), "option": (("option",), "select")}
RAW_TEXT = frozenset(("script", "style"))
# -------------------------------------------------------------------------
_IN_SCOPES = {tag: [name for name, tags in SCOPES.items() if tag in tags] for tags in SCOPES.values() for tag in tags}
_NL = re.compile("\n")
_CLASS_SPACE = re.compile("[ \t\n\x0b\f\r]+")
# output batch bounds of a task (pages or rows / characters per batch)
FLUSH_ROWS, FLUSH_BYTES = 20_000, 8 << 20

NODE_SCHEMA = ("page_id long, pre int, `end` int, parent int, depth int, kind string, tag string, "
               "attrs map<string,string>, sib int, is_last boolean, prev int, text_start int, text_end int, "
               "text string, src_start int, src_end int")
_COLS = ["page_id", "pre", "end", "parent", "depth", "kind", "tag", "attrs", "sib", "is_last", "prev",
         "text_start", "text_end", "text", "src_start", "src_end"]


class _Nodes:
    """A page as columns, one entry per node in pre-order."""

    def __init__(self):
        self.end, self.parent, self.depth, self.tag, self.attrs = [], [], [], [], []   # tag None: a text node
        self.sib, self.prev, self.last_kid = [], [], []
        self.t0, self.t1, self.s0, self.s1 = [], [], [], []
        self.root_sib, self.root_last = 0, -1
        self.pieces, self.length, self._text, self.error = [], 0, None, None

    def add(self, tag, attrs, parent, depth, s0, s1) -> int:
        pre = len(self.tag)
        if tag is None:
            sib = prev = None
        elif parent < 0:
            sib, prev = self.root_sib + 1, self.root_last
            self.root_sib, self.root_last = sib, pre
        else:
            prev = self.last_kid[parent]
            sib = self.sib[prev] + 1 if prev >= 0 else 1
            self.last_kid[parent] = pre
        for column, value in ((self.end, pre), (self.parent, parent), (self.depth, depth), (self.tag, tag),
                              (self.attrs, attrs), (self.sib, sib), (self.prev, prev), (self.last_kid, -1),
                              (self.t0, self.length), (self.t1, self.length), (self.s0, s0), (self.s1, s1)):
            column.append(value)
        return pre

    @property
    def text(self) -> str:
        if self._text is None:
            self._text = "".join(self.pieces)
        return self._text

    def text_of(self, i: int) -> str:
        return self.text[self.t0[i]:self.t1[i]]

    def is_last(self, i: int) -> bool:
        p = self.parent[i]
        return i == (self.last_kid[p] if p >= 0 else self.root_last)

    def children(self, i: int):
        """Child nodes in order, text included."""
        k = i + 1
        while k <= self.end[i]:
            yield k
            k = self.end[k] + 1

    def own_text(self, i: int) -> str:
        if self.last_kid[i] < 0:      # text is all that is in it
            return self.text_of(i)
        return "".join(self.text_of(k) for k in self.children(i) if self.tag[k] is None)


class _Tree(HTMLParser):
    """Reads one page into :class:`_Nodes`."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.html = html
        self.line_starts = [0] + [m.end() for m in _NL.finditer(html)]
        self.nodes = _Nodes()
        self.stack = []       # open elements
        self.places = {}      # tag -> places in the stack
        self.scopes = {name: [] for name in SCOPES}    # places of elements that bound a search
        self.in_text = -1     # the text node that the last event belongs to

    def _abs(self):
        line, col = self.getpos()
        return self.line_starts[line - 1] + col

    # -- helpers ---------------------------------------------------------
    def _open(self, pre, tag):
        at = len(self.stack)
        self.stack.append(pre)
        self.places.setdefault(tag, []).append(at)
        for name in _IN_SCOPES.get(tag, ()):
            self.scopes[name].append(at)

    def _close_top(self, at):
        n, i = self.nodes, self.stack.pop()
        tag = n.tag[i]
        self.places[tag].pop()
        for name in _IN_SCOPES.get(tag, ()):
            self.scopes[name].pop()
        n.end[i], n.t1[i], n.s1[i] = len(n.tag) - 1, n.length, at

    def _close_open(self, tags, scope, at):
        """Close the innermost open one of ``tags``, unless an element of the
        scope lies within it."""
        k = max((of[-1] for t in tags if (of := self.places.get(t))), default=-1)
        bounds = self.scopes[scope]
        if k >= 0 and (not bounds or bounds[-1] < k):
            while len(self.stack) > k:
                self._close_top(at)

    # -- parser callbacks ------------------------------------------------
    def handle_comment(self, data):
        self.in_text = -1

    handle_decl = handle_pi = unknown_decl = handle_comment

    def parse_marked_section(self, i, report=1):
        """``<![x[ ... ]]>`` outside XML is a comment up to the next ``>``."""
        self.in_text = -1
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def handle_starttag(self, tag, attrs):
        self.in_text = -1
        at = self._abs()
        if tag in CLOSES_P:
            self._close_open(("p",), "p", at)
        if tag in IMPLIED:
            self._close_open(*IMPLIED[tag], at)
        a = {}
        for k, v in attrs:
            if k not in a:
                a[k] = "" if v is None else v
        start_text = self.get_starttag_text() or ""
        pre = self.nodes.add(tag, a, self.stack[-1] if self.stack else -1, len(self.stack), at, at + len(start_text))
        if tag not in VOID:
            self._open(pre, tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack and self.nodes.tag[self.stack[-1]] == tag:
            self._close_top(self.nodes.s1[self.stack[-1]])

    def handle_endtag(self, tag):
        self.in_text = -1
        of = self.places.get(tag)
        if not of:
            return
        start = self._abs()
        gt = self.html.find(">", start)
        k = of[-1]
        while len(self.stack) > k + 1:
            self._close_top(start)
        self._close_top(len(self.html) if gt < 0 else gt + 1)

    def handle_data(self, data):
        n = self.nodes
        parent = self.stack[-1] if self.stack else -1
        if parent >= 0 and n.tag[parent] in RAW_TEXT:
            return
        if self.in_text < 0:       # else the tokenizer cut a run of text at a bare "<"
            self.in_text = n.add(None, None, parent, len(self.stack), None, None)
        n.pieces.append(data)
        n.length += len(data)
        n.t1[self.in_text] = n.length

    def finish(self):
        self.close()
        while self.stack:
            self._close_top(len(self.html))


def read_page(html: str | None) -> _Nodes:
    """The nodes of a page; one that breaks the tokenizer keeps those before it and says why."""
    t = _Tree(html or "")
    try:
        t.feed(html or "")
        t.finish()
    except Exception as e:
        t.nodes.error = f"{type(e).__name__}: {e}"
        while t.stack:
            t._close_top(len(html))
    return t.nodes


# ---------------------------------------------------------------------------
# selectors as one automaton


class Program:
    """All compounds of a list of selectors, one bit each.

    ``chains``: a selector is a list of (combinator, compound as a dict).  Bit
    k of a node is set if the chain up to compound k ends at that node.
    """

    def __init__(self, chains):
        self.first = self.descendant = self.child = self.adjacent = 0
        self.of_tag, self.of_any, self.tests, self.last_bits = {}, 0, [], []
        bit = 1
        for chain in chains:
            for k, (_, c) in enumerate(chain):
                if k == 0:
                    self.first |= bit
                if k + 1 < len(chain):        # the next compound's combinator is kept at this bit
                    comb = chain[k + 1][0]
                    name = {" ": "descendant", ">": "child", "+": "adjacent"}[comb]
                    setattr(self, name, getattr(self, name) | bit)
                else:
                    self.last_bits.append(bit)
                tags = [c["tag"]] if c.get("tag") else list(c.get("tags_in") or ())
                if c.get("tag") and c.get("tags_in"):
                    tags = [t for t in tags if t in c["tags_in"]]
                for t in tags:
                    self.of_tag[t] = self.of_tag.get(t, 0) | bit
                if not tags and not c.get("tags_in") and not c.get("tag"):
                    self.of_any |= bit
                if any(c.get(x) for x in ("id", "classes", "attr_eq", "attr_prefix", "has_attr", "lacks_attr", "nth", "last")):
                    self.tests.append((bit, c))
                bit <<= 1
        self.tested = sum(b for b, _ in self.tests)

    @staticmethod
    def _holds(c, nodes, i) -> bool:
        a = nodes.attrs[i]
        if c.get("id") and a.get("id") != c["id"]:
            return False
        if c.get("classes"):
            have = _CLASS_SPACE.split(a.get("class") or "")
            if any(k not in have for k in c["classes"]):
                return False
        return (all(a.get(k) == v for k, v in c.get("attr_eq") or ())
                and all((a.get(k) or "").startswith(v) and k in a for k, v in c.get("attr_prefix") or ())
                and all(k in a for k in c.get("has_attr") or ())
                and not any(k in a for k in c.get("lacks_attr") or ())
                and (c.get("nth") is None or nodes.sib[i] == c["nth"])
                and (not c.get("last") or nodes.is_last(i)))

    def run(self, nodes: _Nodes) -> list[list[int]]:
        """For each selector its matches, in document order."""
        n = len(nodes.tag)
        here, above = [0] * n, [0] * n       # bits that end at a node; at it or an ancestor
        out = [[] for _ in self.last_bits]
        ends = sum(self.last_bits)
        parent, prev, tag = nodes.parent, nodes.prev, nodes.tag
        for i in range(n):
            if tag[i] is None:
                continue
            p, before = parent[i], prev[i]
            state = 0
            if p >= 0:
                state = (above[p] & self.descendant) | (here[p] & self.child)
            if before >= 0:
                state |= here[before] & self.adjacent
            state = (state << 1 | self.first) & (self.of_any | self.of_tag.get(tag[i], 0))
            if state & self.tested:
                for bit, c in self.tests:
                    if state & bit and not self._holds(c, nodes, i):
                        state &= ~bit
            here[i] = state
            above[i] = state | above[p] if p >= 0 else state
            if state & ends:
                for k, bit in enumerate(self.last_bits):
                    if state & bit:
                        out[k].append(i)
        return out


# ---------------------------------------------------------------------------
# from DataFrames of pages to DataFrames of rows


def _shred_one(page_id, html, cols):
    """Append the node rows of one page to the column lists ``cols``."""
    n = read_page(html)
    if n.error is not None:
        for c, v in zip(cols, (page_id, -1, -1, -1, 0, "error", None, [], None, None, None, None, None, n.error, None, None), strict=True):
            c.append(v)
    for i in range(len(n.tag)):
        element = n.tag[i] is not None
        row = (page_id, i, n.end[i], n.parent[i], n.depth[i], "element" if element else "text", n.tag[i],
               list(n.attrs[i].items()) if element else [], n.sib[i], n.is_last(i) if element else None,
               n.prev[i] if element else None, n.t0[i], n.t1[i], None if element else n.text_of(i), n.s0[i], n.s1[i])
        for c, v in zip(cols, row, strict=True):
            c.append(v)


def _arrow(schema: str):
    """The Arrow schema of a DDL string of the types used here."""
    import pyarrow as pa
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
             "map<string,string>": pa.map_(pa.string(), pa.string()), "array<string>": pa.list_(pa.string()),
             "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name.strip("`"), kinds[kind]) for name, kind in (x.rsplit(" ", 1) for x in schema.split(", "))])


def _emitter(schema: str):
    """Collects rows as columns; ``add`` returns a batch when enough are held."""
    import pyarrow as pa
    arrow = _arrow(schema)

    class Out:
        def __init__(self):
            self.cols, self.size = [[] for _ in arrow], 0

        def add(self, row, size=0):
            for c, v in zip(self.cols, row, strict=True):
                c.append(v)
            self.size += size
            return self.flush() if len(self.cols[0]) >= FLUSH_ROWS or self.size >= FLUSH_BYTES else None

        def flush(self):
            batch = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(self.cols, arrow, strict=True)], schema=arrow)
            self.cols, self.size = [[] for _ in arrow], 0
            return batch
    return Out()


def _shred_arrow(it):
    out = _emitter(NODE_SCHEMA)
    for batch in it:
        for pid, html in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist(), strict=True):
            _shred_one(pid, html, out.cols)
            out.size += len(html or "")
            if len(out.cols[0]) >= FLUSH_ROWS or out.size >= FLUSH_BYTES:
                yield out.flush()
    if out.cols[0]:
        yield out.flush()


def shred(pages: DataFrame, with_text: bool = True) -> DataFrame:
    """``pages(page_id, html)`` → node table.  Narrow (no shuffle).

    The table remembers the pages that it comes from, so selectors on it are
    matched in one pass over those pages.  ``with_text=False``: matches carry
    no text (counts, attributes and positions only)."""
    nodes = pages.select("page_id", "html").mapInArrow(_shred_arrow, NODE_SCHEMA)
    nodes._shred_of, nodes._with_text = pages, with_text
    return nodes


def materialize_nodes(pages: DataFrame, path: str) -> DataFrame:
    """Shred once, write the node table, read it back.  Selectors on a table
    that was read back group its rows by page: one shuffle, whatever their
    number.  ``path`` must be a shared folder on a cluster."""
    shred(pages).write.mode("overwrite").parquet(path)
    return pages.sparkSession.read.parquet(path)


def _pages_of_rows(rows):
    """(page_id, nodes, html None) of node rows sorted by page and ``pre``."""
    at, n = None, None
    for r in rows:
        if r["page_id"] != at or n is None:
            if n is not None:
                yield at, n, None
            at, n = r["page_id"], _Nodes()
        if r["kind"] == "error":
            n.error = r["text"]
            continue
        element = r["kind"] == "element"
        i = n.add(r["tag"] if element else None, dict(r["attrs"]) if element else None, r["parent"], r["depth"], r["src_start"], r["src_end"])
        n.end[i], n.t0[i], n.t1[i] = r["end"], r["text_start"], r["text_end"]
        if not element:
            n.pieces.append(r["text"])
    if n is not None:
        yield at, n, None


def per_page(nodes: DataFrame, rows, schema: str, carry=()) -> DataFrame:
    """Run ``rows(page_id, nodes, html, carried)`` on every page and return what
    it yields: (row, characters).  ``nodes``: what :func:`shred` gave, a table
    of pages (page_id, html and the columns ``carry``), or a stored node table.
    """
    source = getattr(nodes, "_shred_of", nodes)
    if "html" in source.columns:
        def run(it):
            out = _emitter(schema)
            for batch in it:
                for pid, html, *more in zip(*(batch.column(c).to_pylist() for c in ("page_id", "html", *carry)), strict=True):
                    for row, size in rows(pid, read_page(html), html or "", more):
                        if (full := out.add(row, size)) is not None:
                            yield full
            if out.cols[0]:
                yield out.flush()
        return source.select("page_id", "html", *carry).mapInArrow(run, schema)

    def run_rows(it):
        out = _emitter(schema)
        for pid, n, html in _pages_of_rows(r for batch in it for r in batch.to_pylist()):
            for row, size in rows(pid, n, html, ()):
                if (full := out.add(row, size)) is not None:
                    yield full
        if out.cols[0]:
            yield out.flush()
    grouped = source.select(*_COLS).repartition(F.col("page_id")).sortWithinPartitions("page_id", "pre")
    return grouped.mapInArrow(run_rows, schema)


MATCH_SCHEMA = ("page_id long, pre int, `end` int, parent int, depth int, kind string, tag string, "
                "attrs map<string,string>, sib int, is_last boolean, text string, own_text string, src_start int, src_end int, which array<int>")


def matches(nodes: DataFrame, chains: list, with_text: bool | None = None) -> DataFrame:
    """Every node that one of the selectors matches, once, with ``which`` of
    them (indices) match it."""
    program = Program(chains)
    text = getattr(nodes, "_with_text", True) if with_text is None else with_text

    def rows(pid, n, html, _):
        which = {}
        for k, found in enumerate(program.run(n)):
            for i in found:
                which.setdefault(i, []).append(k)
        for i in sorted(which):
            whole = n.text_of(i) if text else None
            yield (pid, i, n.end[i], n.parent[i], n.depth[i], "element", n.tag[i], list(n.attrs[i].items()), n.sib[i], n.is_last(i),
                   whole, n.own_text(i) if text else None, n.s0[i], n.s1[i], which[i]), len(whole or "")
    return per_page(nodes, rows, MATCH_SCHEMA)


def match_counts(nodes: DataFrame, chains: list, names: list[str], every_page: bool = False) -> DataFrame:
    """page_id and how many nodes each selector matches; a page without any
    match has no row, or zeros if ``every_page``."""
    program = Program(chains)

    def rows(pid, n, html, _):
        counts = [len(found) for found in program.run(n)]
        if every_page or any(counts):
            yield (pid, *counts), 0
    return per_page(nodes, rows, "page_id long, " + ", ".join(f"`{c}` long" for c in names))


CHILD_SCHEMA = "page_id long, parent_pre int, pre int, kind string, text string"


def child_rows(nodes: DataFrame, chain: list) -> DataFrame:
    """The children of every node that the selector matches, bare text included."""
    program = Program([chain])

    def rows(pid, n, html, _):
        for i in program.run(n)[0]:
            for k in n.children(i):
                yield (pid, i, k, "text" if n.tag[k] is None else "element", n.text_of(k)), n.t1[k] - n.t0[k]
    return per_page(nodes, rows, CHILD_SCHEMA)


def _value(kind: str, n: _Nodes, found: list[int], html):
    """The value of a field from the nodes that its selector matches."""
    if kind == "all":
        return [n.text_of(i) for i in found]
    if kind.startswith("attrs:"):
        name = kind.split(":", 1)[1]
        return [n.attrs[i][name] for i in found if name in n.attrs[i]]
    if kind == "children":
        return [n.text_of(k) for i in found[:1] for k in n.children(i)]
    if not found:
        return None
    if kind == "first":
        return n.text_of(found[0])
    if kind == "own":
        return n.own_text(found[0])
    if kind == "outer":
        if html is None:
            raise ValueError("markup is cut from pages, not from a stored node table")
        return html[n.s0[found[0]]:n.s1[found[0]]]
    return n.attrs[found[0]].get(kind.split(":", 1)[1])


def field_type(kind: str) -> str:
    """A list or a text; ``attrs:x`` are the attributes of all matches."""
    if kind not in ("first", "all", "children", "outer", "own") and not kind.startswith(("attr:", "attrs:")):
        raise ValueError(f"unknown field kind {kind!r}")
    return "array<string>" if kind in ("all", "children") or kind.startswith("attrs:") else "string"


class _Fields:
    """Fields (name, kind, selectors) read from a page with one program; a
    field with several selectors reads the union of their matches."""

    def __init__(self, fields):
        self.kinds = [kind for _, kind, _ in fields]
        self.names = [name for name, _, _ in fields]
        chains, self.parts = [], []
        for _, _, alternatives in fields:
            self.parts.append(range(len(chains), len(chains) + len(alternatives)))
            chains += alternatives
        self.program = Program(chains)

    def read(self, n, html) -> dict:
        got = self.program.run(n)
        return {name: _value(kind, n, got[part[0]] if len(part) == 1 else sorted({i for k in part for i in got[k]}), html)
                for name, kind, part in zip(self.names, self.kinds, self.parts, strict=True)}


def record_rows(pages: DataFrame, specs: dict, site: str | None = None, carry=("url",)) -> DataFrame:
    """One row per page: page_id, the carried columns, ``parse_error`` and the
    fields of the page's spec.

    ``specs``: {site: [(field, kind, selectors)]}; a page's spec is chosen by
    its column ``site`` (without it there is one spec).  A field that is not
    in the page's spec, and all fields of a page of an unknown site, are NULL."""
    types = {}
    for spec in specs.values():
        for field, kind, _ in spec:
            if types.setdefault(field, field_type(kind)) != field_type(kind):
                raise ValueError(f"field {field!r} is a list in one spec and a text in another")
    readers = {name: _Fields(spec) for name, spec in specs.items()}
    names = list(types)
    only = next(iter(readers)) if site is None else None
    carried = [*carry, *([site] if site else [])]

    def rows(pid, n, html, more):
        reader = readers.get(more[-1] if site else only)
        values = reader.read(n, html) if reader else {}
        yield (pid, *more, n.error, *(values.get(f) for f in names)), len(html)
    schema = ", ".join(["page_id long", *_carried(pages, carried), "parse_error string", *(f"`{f}` {t}" for f, t in types.items())])
    return per_page(pages, rows, schema, carried)


def _carried(pages: DataFrame, names) -> list[str]:
    return [f"`{c}` {'long' if (t := pages.schema[c].dataType.simpleString()) == 'bigint' else t}" for c in names]


def nested_rows(pages: DataFrame, page_fields: list, scope: list, scope_fields: list, item: list, item_fields: list, carry=("url",)) -> DataFrame:
    """One row per item inside a scope: page_id, carried columns, the page's
    fields, scope_pos and the scope's fields, item_pos and the item's fields.

    Fields are (name, kind, chain): of the page by chains from its top; of a
    scope or item by chains inside it, or of itself with chain None.  An item
    belongs to the innermost scope around it; items outside have no row, and a
    scope without items has one with NULL items."""
    inner = [c for _, _, c in (*scope_fields, *item_fields) if c is not None]
    program = Program([*(c for _, _, c in page_fields), scope, item, *inner])
    n_page = len(page_fields)

    def inside(n, found, i):
        """Of sorted ``found`` those within node i."""
        from bisect import bisect_right
        return found[bisect_right(found, i):bisect_right(found, n.end[i])]

    def rows(pid, n, html, more):
        got = program.run(n)
        page = [_value(kind, n, found, html) for (_, kind, _), found in zip(page_fields, got, strict=False)]
        scopes, items, rest = got[n_page], got[n_page + 1], iter(got[n_page + 2:])
        found_of = [next(rest) if c is not None else None for _, _, c in (*scope_fields, *item_fields)]
        at, open_, held = 0, [], {s: [] for s in scopes}
        for i in items:
            while at < len(scopes) and scopes[at] < i:
                open_.append(scopes[at])
                at += 1
            while open_ and n.end[open_[-1]] < i:
                open_.pop()
            if open_:
                held[open_[-1]].append(i)
        for pos, s in enumerate(scopes):
            of_scope = [_value(kind, n, [s] if f is None else inside(n, f, s), html) for (_, kind, _), f in zip(scope_fields, found_of, strict=False)]
            for k, i in enumerate(held[s]) if held[s] else ((None, None),):
                of_item = [None if i is None else _value(kind, n, [i] if f is None else inside(n, f, i), html)
                           for (_, kind, _), f in zip(item_fields, found_of[len(scope_fields):], strict=True)]
                yield (pid, *more, *page, pos, *of_scope, k, *of_item), 200
    of = lambda fields: [f"`{f}` {field_type(kind)}" for f, kind, _ in fields]
    schema = ", ".join(["page_id long", *_carried(pages, carry), *of(page_fields), "scope_pos int", *of(scope_fields), "item_pos int", *of(item_fields)])
    return per_page(pages, rows, schema, tuple(carry))
