"""Selector operators over the node table (O-X3..O-X13, O-J6, O-W4).

A selector is built from Python combinators, not parsed from text::

    S.tag("article").descendant(S.tag("p"))          # article p
    S.tag("ul").child(S.tag("li"))                   # ul > li
    S.tag("h1").adjacent(S.tag("p", cls="price"))    # h1 + p.price
    S.tag("li").nth_child(2)                         # li:nth-child(2)
    S.any().is_("h1", "p")                           # *:is(h1,p)
    S.tag("div").without_attr("class")               # div:not([class])
    S.tag("a").attr_prefix("href", "/t")             # a[href^="/t"]

How they run on Spark: all selectors of a call are compiled into one automaton
(:class:`presslake.operators.nodes.Program`) that is run in the task that reads
and shreds the page, so every combinator, positional ones included, costs one
pass over the page and no shuffle.  On a node table that was stored and read
back, its rows are grouped by page first (one shuffle for all selectors).
:func:`contained_in` is the interval join on the node table itself.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.operators import nodes as N


@dataclass(frozen=True)
class Compound:
    tag: str | None = None
    id: str | None = None
    classes: tuple = ()
    attr_eq: tuple = ()          # ((name, value), ...)
    attr_prefix: tuple = ()      # ((name, prefix), ...)
    has_attr: tuple = ()
    lacks_attr: tuple = ()
    tags_in: tuple = ()          # :is(a, b)
    nth: int | None = None       # :nth-child(n)
    last: bool = False           # :last-child


@dataclass(frozen=True)
class Sel:
    """A chain ``c0 <comb1> c1 <comb2> ... cN``; ``steps[i] = (comb, Compound)``
    with comb in {None, ' ', '>', '+'}."""
    steps: tuple = field(default_factory=tuple)

    # -- constructors ----------------------------------------------------
    @staticmethod
    def tag(name: str | None = None, cls: str | tuple | None = None, id: str | None = None) -> "Sel":
        classes = (cls,) if isinstance(cls, str) else tuple(cls or ())
        return Sel(((None, Compound(tag=name, id=id, classes=classes)),))

    @staticmethod
    def any() -> "Sel":
        return Sel(((None, Compound()),))

    # -- compound refinements (apply to the last step) -------------------
    def _with(self, **kw) -> "Sel":
        comb, c = self.steps[-1]
        for k in ("classes", "attr_eq", "attr_prefix", "has_attr", "lacks_attr"):
            if k in kw:
                kw[k] = getattr(c, k) + kw[k]
        return Sel(self.steps[:-1] + ((comb, replace(c, **kw)),))

    def cls(self, *names) -> "Sel":
        return self._with(classes=tuple(names))

    def attr_equals(self, name, value) -> "Sel":
        return self._with(attr_eq=((name, value),))

    def attr_prefix(self, name, prefix) -> "Sel":
        return self._with(attr_prefix=((name, prefix),))

    def with_attr(self, name) -> "Sel":
        return self._with(has_attr=(name,))

    def without_attr(self, name) -> "Sel":
        return self._with(lacks_attr=(name,))

    def is_(self, *tags) -> "Sel":
        return self._with(tags_in=tuple(tags))

    def nth_child(self, n: int) -> "Sel":
        return self._with(nth=n)

    def last_child(self) -> "Sel":
        return self._with(last=True)

    # -- combinators -----------------------------------------------------
    def _join(self, comb, other: "Sel") -> "Sel":
        first_comb, first = other.steps[0]
        return Sel(self.steps + ((comb, first),) + other.steps[1:])

    def descendant(self, other: "Sel") -> "Sel":
        return self._join(" ", other)

    def child(self, other: "Sel") -> "Sel":
        return self._join(">", other)

    def adjacent(self, other: "Sel") -> "Sel":
        return self._join("+", other)


def plain(sel: Sel) -> list:
    """The selector as data that tasks compile: (combinator, compound)."""
    return [(comb, {k: v for k, v in asdict(c).items() if v not in (None, (), False)}) for comb, c in sel.steps]


def contained_in(ctx: DataFrame, nodes: DataFrame, direct: bool = False) -> DataFrame:
    """O-J6 interval join: ``nodes`` inside some ``ctx`` node of the same page
    (``ctx.pre < n.pre <= ctx.end``; ``direct`` → ``n.parent = ctx.pre``).
    Equi-key ``page_id`` plus a range residual — never a cartesian product;
    the result is de-duplicated per node."""
    c = ctx.select(F.col("page_id").alias("_cpage"), F.col("pre").alias("_cpre"), F.col("end").alias("_cend"))
    within = F.col("parent") == F.col("_cpre") if direct else (F.col("pre") > F.col("_cpre")) & (F.col("pre") <= F.col("_cend"))
    return nodes.join(c, (F.col("page_id") == F.col("_cpage")) & within, "left_semi")


def select(nodes: DataFrame, sel: Sel) -> DataFrame:
    """All nodes matching ``sel`` (each node once)."""
    return N.matches(nodes, [plain(sel)]).drop("which")


def first_per_page(matches: DataFrame, value: str = "text") -> DataFrame:
    """O-X1 / O-L4: first match in document order per page (``min_by``)."""
    return matches.groupBy("page_id").agg(F.min_by(value, "pre").alias(value))


def select_union(nodes: DataFrame, *sels: Sel) -> DataFrame:
    """O-X13: ``A, B`` — each node once, in document order by ``pre``."""
    return N.matches(nodes, [plain(s) for s in sels]).select("page_id", "pre", "tag", "text")


def children_text(nodes: DataFrame, parent_sel: Sel, drop_blank: bool = False) -> DataFrame:
    """O-X17: text of each direct child of the matched parents, bare text
    included, in document order: ``(page_id, parent_pre, pre, kind, text)``."""
    out = N.child_rows(nodes, plain(parent_sel))
    return out.where(F.regexp_replace("text", r"\s", "") != "") if drop_blank else out


def count_matches(nodes: DataFrame, sels: dict, every_page: bool = False) -> DataFrame:
    """Per page, how many nodes match each named selector:
    ``(page_id, <name>...)``; pages without any match produce no row, or one
    of zeros if ``every_page``."""
    return N.match_counts(nodes, [plain(s) for s in sels.values()], list(sels), every_page)
