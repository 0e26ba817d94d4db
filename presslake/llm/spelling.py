"""Operator 11, spelling variants: k-d trees over letter-count vectors.

One edit (a code point inserted, deleted or replaced) changes a word's letter
counts by an L1 distance of at most two, and more exactly by at most one up
and one down.  So near words lie in each other's neighbourhood in the space of
letter counts, where k-d trees find them: for each word two range searches,
among the words of its own length and among those one longer.

Words are counted in Spark.  A top tree per length, split at a sample of its
words, deals them into cells of about CELL words; a word is sent to its own
cell and, as a query, to every cell whose box is within reach.  A task holds
the words of one cell in a k-d tree with tight boxes, streams the queries
through it in blocks, prunes by boxes, then by the words' own vectors, and
verifies the order of the letters of what is left.  Cells return one row per
word and cell (how many near words, the most frequent), never pairs.

Letters are folded into 32 counts, at most 255 each; both keep every distance
or make it smaller, so no near word is missed.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import importable, stage, worker_store

MIN_LENGTH = 7
MIN_COUNT = 2
FACTOR = 10             #: a form is so many times as frequent as its variant
THIN = 31               #: one in so many runs loses a code point
CELL = 2048             #: words per cell of a top tree
CELLS = 20_000          #: cells of all lengths at most; beyond, cells are larger
PER_CELL = 64           #: sampled words per cell
LEAF = 16               #: words per leaf of a cell's tree
BLOCK = 2048            #: queries that are searched at once
PAIRS = 1 << 20         #: candidate pairs that are looked at once
DIMS = 32

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Folded coordinate of a Latin-1 byte: a letter's own, or of six for the rest.
_FOLD = np.array([b - 97 if 97 <= b < 123 else 26 + b % 6 for b in range(256)], np.int64)
_ONES = np.uint64(0x0101010101010101)


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, thin: int = THIN) -> DataFrame:
    """word and n of the words of at least ``min_length`` code points that occur
    at least ``min_count`` times in all whole texts.

    A run of letters (A-Z, a-z, U+00C0 to U+00FF) is lower-cased in A-Z; if
    ``thin`` divides h, the unsigned CRC-32 of ``<key>:<run>``, the run loses
    its code point h % length.  Null texts have no runs; a null key counts as
    empty text; repeated rows are counted like others."""
    run = F.explode_outer(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[A-Za-z\u00C0-\u00FF]{{{min_length},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"), run.alias("r")).where("r is not null")
    rows = rows.select("k", F.translate("r", _UPPER, _LOWER).alias("w"))
    rows = rows.select("w", F.crc32(F.concat("k", F.lit(":"), "w")).alias("h"))
    at = F.expr("cast(h % length(w) as int)")
    cut = F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.length("w")))
    words = rows.select(F.when(F.col("h") % thin == 0, cut).otherwise(F.col("w")).alias("word"))
    return words.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def matrix(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of Latin-1 bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def vectors(letters: np.ndarray) -> np.ndarray:
    """Folded letter counts of words given as rows of bytes."""
    n = len(letters)
    out = np.empty((n, DIMS), np.uint8)
    step = max(1, (1 << 22) // max(letters.shape[1], 1))
    for i in range(0, n, step):
        part = _FOLD[letters[i:i + step]]
        cells = (np.arange(len(part))[:, None] * DIMS + part).ravel()
        out[i:i + step] = np.minimum(np.bincount(cells, minlength=len(part) * DIMS), 255).reshape(-1, DIMS)
    return out


def _at_most_one(excess: np.ndarray) -> np.ndarray:
    """Whether the bytes of each row of 32 sum to at most one."""
    x = np.minimum(excess, 2).view(np.uint64).reshape(-1, DIMS // 8)
    s = x[:, 0] + x[:, 1] + x[:, 2] + x[:, 3]      # bytes of at most 8: no carry
    return ((s & _ONES) == s) & ((s & (s - np.uint64(1))) == 0)


def in_reach(v: np.ndarray, low: np.ndarray, high: np.ndarray, longer: bool) -> np.ndarray:
    """Whether one edit can lead from each vector into its box: one count up
    and, unless the target is ``longer``, one down (L1 distance two or one)."""
    up = _at_most_one(np.maximum(low, v) - v)
    if longer:
        return up & (np.maximum(v, high) == high).all(axis=1)
    return up & _at_most_one(np.maximum(v, high) - high)


class Tree:
    """A k-d tree: inner nodes split one count at a threshold, leaves number
    from 0.  ``tight`` boxes hold the points; else a box is what the splits
    leave of the whole space, for points that were not seen."""

    def __init__(self, v: np.ndarray, leaf: int, tight: bool):
        self.low, self.high, self.left, self.right, self.leaf, self.members, self.split = [], [], [], [], [], [], []
        todo = [(np.arange(len(v)), np.zeros(DIMS, np.uint8), np.full(DIMS, 255, np.uint8), -1, 0)]
        while todo:
            rows, low, high, parent, side = todo.pop()
            me = len(self.left)
            if parent >= 0:
                (self.left, self.right)[side][parent] = me
            part = v[rows]
            box = (part.min(axis=0), part.max(axis=0)) if tight and len(rows) else (low, high)
            self.low.append(box[0])
            self.high.append(box[1])
            self.left.append(-1)
            self.right.append(-1)
            at = np.floor(part.mean(axis=0)).astype(np.int64) if len(rows) else np.zeros(DIMS, np.int64)
            below = (part <= at).sum(axis=0)
            even = np.minimum(below, len(rows) - below)
            d = int(even.argmax()) if len(rows) else 0
            if len(rows) <= leaf or not even[d]:       # few, or all alike
                self.leaf.append(len(self.members))
                self.split.append((0, 0))
                self.members.append(rows)
                continue
            self.leaf.append(-1)
            t = int(at[d])
            self.split.append((d, t))
            goes = part[:, d] <= t
            up, down = low.copy(), high.copy()
            up[d], down[d] = t + 1, t
            todo += [(rows[~goes], up, high, me, 1), (rows[goes], low, down, me, 0)]
        self.low, self.high, self.left, self.right, self.leaf = np.array(self.low), np.array(self.high), np.array(self.left), np.array(self.right), np.array(self.leaf)

    def home(self, v: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        node = np.zeros(len(v), np.int64)
        dim, at = np.array([s[0] for s in self.split]), np.array([s[1] for s in self.split])
        while (inner := np.flatnonzero(self.leaf[node] < 0)).size:
            k = node[inner]
            goes = v[inner, dim[k]] <= at[k]
            node[inner] = np.where(goes, self.left[k], self.right[k])
        return self.leaf[node]

    def search(self, v: np.ndarray, longer: bool) -> tuple[np.ndarray, np.ndarray]:
        """(vector, leaf) pairs of all leaves whose boxes are in reach."""
        q, node = np.arange(len(v)), np.zeros(len(v), np.int64)
        out = []
        while len(q):
            near = in_reach(v[q], self.low[node], self.high[node], longer)
            q, node = q[near], node[near]
            done = self.leaf[node] >= 0
            out.append((q[done], self.leaf[node[done]]))
            q, node = q[~done], node[~done]
            q, node = np.concatenate((q, q)), np.concatenate((self.left[node], self.right[node]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (q, node)


def _halves(letters: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for the first ``length // 2`` letters and for as many last ones
    as make up ``length``: equal for equal letters."""
    def number(part):
        total = np.zeros(len(part), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(part.shape[1]):
                total = total * np.uint64(0x100000001B3) + part[:, j]
        return total
    k = length // 2
    return number(letters[:, :k]), number(letters[:, letters.shape[1] - (length - k):])


def _one_edit(a: np.ndarray, b: np.ndarray, longer: bool) -> np.ndarray:
    """Whether rows differ by one letter: replaced, or inserted into ``a``."""
    if not longer:
        return (a != b).sum(axis=1) == 1
    n = a.shape[1]
    front = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= n


class Cell:
    """The words of a cell, all of one length, ready to be searched."""

    def __init__(self, words: list[str], n: list[int], length: int):
        self.words, self.n, self.length = np.array(words, object), np.array(n, np.int64), length
        self.letters = matrix(words, length)
        self.v = vectors(self.letters)
        self.tree = Tree(self.v, LEAF, True)
        self.size = np.array([len(m) for m in self.tree.members])
        self.start = np.cumsum(self.size) - self.size
        self.order = np.concatenate(self.tree.members)
        self.half = {False: _halves(self.letters, length), True: _halves(self.letters, length - 1)}

    def near(self, words: list[str], longer: bool):
        """Pairs (i, j): word i of ``words`` is one edit from word j of the cell.
        ``longer``: the cell's words are one letter longer than ``words``."""
        length = self.length - longer
        letters = matrix(words, length)
        v, half, theirs = vectors(letters), _halves(letters, length), self.half[longer]
        q, leaf = self.tree.search(v, longer)
        total = np.cumsum(self.size[leaf])
        i = 0
        while i < len(q):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PAIRS, "right")))
            size = self.size[leaf[i:j]]
            a = np.repeat(q[i:j], size)
            b = self.order[np.arange(len(a)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.start[leaf[i:j]], size)]
            # One edit leaves the first or the last half as it was.
            keep = (half[0][a] == theirs[0][b]) | (half[1][a] == theirs[1][b])
            a, b = a[keep], b[keep]
            keep = in_reach(v[a], self.v[b], self.v[b], longer)
            a, b = a[keep], b[keep]
            keep = _one_edit(letters[a], self.letters[b], longer)
            yield a[keep], b[keep]
            i = j


def summed(of: np.ndarray, other_words: np.ndarray, other_n: np.ndarray, other: np.ndarray):
    """Per distinct ``of``: how many others, and the n and word of the most
    frequent (ties: the smallest word)."""
    order = np.lexsort((other_words[other].astype("U"), -other_n[other], of))
    of, other = of[order], other[order]
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    return of[first], np.diff(np.append(first, len(of))), other_n[other[first]], other_words[other[first]]


_NEAR = "word string, n_near long, best_n long, best string"


def top_trees(words: DataFrame, cell: int = CELL) -> dict[int, tuple[int, Tree]]:
    """{length: (number of its first cell, tree over cells)} of staged words.
    The driver holds PER_CELL sampled words per cell, for CELLS at most."""
    sizes = {r["k"]: r["c"] for r in words.groupBy(F.length("word").alias("k")).agg(F.count("*").alias("c")).collect()}
    total = sum(sizes.values())
    cell = max(cell, -(-total // CELLS))
    large = [k for k, c in sizes.items() if c > cell]
    seen: dict[int, list[str]] = {}
    if large:
        part = words.where(F.length("word").isin(large)).sample(min(1.0, PER_CELL / cell), seed=7).select("word")
        for r in part.collect():
            seen.setdefault(len(r["word"]), []).append(r["word"])
    out, first = {}, 0
    for k in sorted(sizes):
        some = seen.get(k, [])
        v = vectors(matrix(some, k)) if some else np.zeros((0, DIMS), np.uint8)
        tree = Tree(v, max(1, round(len(some) * cell / max(sizes[k], 1))) if some else 1, False)
        out[k] = (first, tree)
        first += len(tree.members)
    return out


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """For ``words`` (word, n; staged, words distinct): rows of word, n_near,
    best_n and best, several per word, whose n_near add up to the number of
    near words and whose best ones hold the most frequent of them."""
    spark = words.sparkSession
    importable(spark)
    trees = top_trees(words, cell)
    cells = sum(len(t.members) for _, t in trees.values())
    sent = spark.sparkContext.broadcast({k: (first, _slim(t)) for k, (first, t) in trees.items()})   # at most CELLS boxes

    def deal(batches):
        import pyarrow as pa
        for b in batches:
            names, n = b.column("word").to_pylist(), b.column("n").to_numpy(zero_copy_only=False)
            by: dict[int, list[int]] = {}
            for i, w in enumerate(names):
                by.setdefault(len(w), []).append(i)
            for length, rows in by.items():
                rows = np.array(rows)
                part = [names[i] for i in rows]
                v = vectors(matrix(part, length))
                first, tree = sent.value[length]
                home = tree.home(v)
                q, leaf = tree.search(v, False)
                away = leaf != home[q]
                found = [(rows, home + first, 0), (rows[q[away]], leaf[away] + first, 1)]
                if length + 1 in sent.value:
                    first, tree = sent.value[length + 1]
                    q, leaf = tree.search(v, True)
                    found.append((rows[q], leaf + first, 2))
                row, cell_, role = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]), np.concatenate([np.full(len(x[0]), x[2], np.int8) for x in found])
                for i in range(0, len(row), 10_000):
                    k = row[i:i + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array(cell_[i:i + 10_000], pa.int32()), pa.array(role[i:i + 10_000]), pa.array([names[j] for j in k]), pa.array(n[k], pa.int64())], names=["cell", "role", "word", "n"])

    def run(batches):
        import pyarrow as pa
        worker_store("spelling")

        def out(word, count, best_n, best):
            return pa.RecordBatch.from_arrays([pa.array(list(word), pa.string()), pa.array(count, pa.int64()), pa.array(best_n, pa.int64()), pa.array(list(best), pa.string())], names=["word", "n_near", "best_n", "best"])

        def ask(cell, names, n, longer):
            pairs = list(cell.near(names, longer))
            a, b = (np.concatenate(c) for c in zip(*pairs, strict=True)) if pairs else (np.zeros(0, int), np.zeros(0, int))
            if not len(a):
                return
            names, n = np.array(names, object), np.array(n, np.int64)
            of, *rest = summed(a, cell.words, cell.n, b)
            yield out(names[of], *rest)
            if longer:
                of, *rest = summed(b, names, n, a)
                yield out(cell.words[of], *rest)

        at, role, names, n, cell = None, None, [], [], None

        def flush():
            nonlocal cell, names, n
            if role == 0:
                cell = Cell(names, n, len(names[0]))
                for i in range(0, len(names), BLOCK):
                    yield from ask(cell, names[i:i + BLOCK], n[i:i + BLOCK], False)
            elif names and cell is not None:
                yield from ask(cell, names, n, role == 2)
            names, n = [], []

        for b in batches:
            for k, r, w, c in zip(*(b.column(x).to_pylist() for x in ("cell", "role", "word", "n")), strict=True):
                if (k, r) != (at, role) or (role and len(names) >= BLOCK):
                    yield from flush()
                    if k != at:
                        cell = None          # a cell without words of its own answers nothing
                    at, role = k, r
                names.append(w)
                n.append(c)
        yield from flush()

    parts = min(cells, int(spark.conf.get("spark.sql.shuffle.partitions"))) or 1
    dealt = words.select("word", "n").mapInArrow(deal, "cell int, role byte, word string, n long")
    return dealt.repartitionById(parts, F.col("cell") % parts).sortWithinPartitions("cell", "role").mapInArrow(run, _NEAR)


def _slim(tree: Tree) -> Tree:
    tree.members = [()] * len(tree.members)
    return tree


def variants(words: DataFrame, factor: int = FACTOR, cell: int = CELL) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``words`` (word,
    n): words are distinct, of lower-case letters up to U+00FF.

    A word's form is the most frequent word one edit away (ties: smallest), if
    at least ``factor`` times as frequent; root is where forms lead.  Forms grow
    by ``factor`` each, so chains are short: pointers are doubled as often as
    the largest n allows.  An empty table gives none."""
    words = stage(words.select("word", "n"), "words")
    none = F.lit(None).cast("struct<less:bigint,word:string>")
    known = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.alias("best"))
    found = near_words(words, cell).select("word", F.lit(None).cast("long").alias("n"), "n_near", F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")).alias("best"))
    joined = known.unionByName(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    is_form = -F.col("best.less") >= factor * F.col("n")
    rows = stage(joined.select("word", "n", "n_near", F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "forms")
    steps = rows.where("form is not null").select("word", F.col("form").alias("to"))
    most = rows.agg(F.max("n")).first()[0] or 1
    hops = int(math.log(max(most, 1), factor)) if factor > 1 else 0
    for _ in range(math.ceil(math.log2(hops)) if hops > 1 else 0):
        further = steps.select(F.col("word").alias("to"), F.col("to").alias("next"))
        steps = stage(steps.join(further, "to", "left").select("word", F.coalesce("next", "to").alias("to")), "roots")
    return rows.join(steps, "word", "left").select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n")


def document_variants(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of ``documents``."""
    return variants(count_words(docs.select("doc_id", "text")))
