"""Operator 12, benchmark decontamination: a broadcast set of test n-grams.

Test items are normalised to words (A-Z lower-cased); every run of ``window``
words of an item, or all its words if it has fewer, is an entry of the set.
The set travels to every task as sorted 64-bit hashes with the entries' words
and items.  Tasks scan the word windows of whole texts: hash every window from
its words' hashes, look the hashes up, and compare the words of the hits.  A
word within a verified window is hit.

Equal words have equal hashes, so no window is missed, and every hit is
verified, so none is invented.  Documents never shuffle.  The set is bounded
by ``SET_BYTES`` of item text; more items are taken in blocks of that size,
one pass over the documents each, and the hit words are joined per document.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import blocks, importable, stage, utf8, worker_store

WINDOW = 10
SET_BYTES = 16 << 20    #: item text whose windows are broadcast at once
BLOCK = 1 << 20         #: bytes of text that are scanned at once
MEMO = 50_000           #: verified raw windows that a task remembers

#: Bytes of words: digits, letters and all of a code point beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += np.uint64(32)
#: What separates words, once A-Z are lower-cased.
_SPLIT = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(4096, 0xD6E8FEB86659FD93, np.uint64))
    _PLACE = np.cumprod(np.full(64, 0xA0761D6478BD642F, np.uint64))


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, hash and text number of every word of texts, given their
    UTF-8 bytes and offsets."""
    word = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1] | edge[1:-1]
    end[:-1] &= ~word[1:] | edge[1:-1]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    if not len(s):
        return s, e, np.zeros(0, np.uint64), s
    doc = np.searchsorted(off, s, "right") - 1
    at = np.flatnonzero(word)
    size = e - s
    first = np.cumsum(size) - size
    place = np.arange(len(at)) - np.repeat(first, size)
    with np.errstate(over="ignore"):
        h = np.add.reduceat((_LOWER[data[at]] + np.uint64(1)) * _POWERS[place & 4095], first)
        h = (h ^ (h >> np.uint64(29))) * _ODD
    return s, e, h ^ (h >> np.uint64(32)), doc


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` neighbouring words."""
    total = np.zeros(max(len(h) - n + 1, 0), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n if len(total) else 0):
            total += h[k:k + len(total)] * _PLACE[k % 64] * np.uint64(2 * (k // 64) + 1)
        return (total ^ (total >> np.uint64(31))) * _ODD


class WindowSet:
    """Windows of items, per length in words: their hashes in order, and for
    each the place of its words in ``text`` (normalised items) and its item."""

    def __init__(self, items, window: int):
        """``items``: (item_id as text or None, text as bytes)."""
        if window < 1:
            raise ValueError("a window has at least one word")
        self.names, texts, found, size = [], [], {}, 0
        for name, text in items:
            data = np.frombuffer(text, np.uint8)
            s, e, h, _ = words_of(data, np.array([0, len(data)]))
            n = min(window, len(s))
            if not n:
                continue
            after = size + np.cumsum(e - s + 1) - 1          # in text, where one blank follows each word
            x = window_hashes(h, n)
            found.setdefault(n, []).append((x, (after - (e - s))[:len(x)], after[n - 1:], np.full(len(x), len(self.names))))
            texts.append(b"".join(text[a:b].lower() + b" " for a, b in zip(s.tolist(), e.tolist(), strict=True)))  # bytes.lower: A-Z only
            size += len(texts[-1])
            self.names.append(name)
        self.text, self.lengths = b"".join(texts), {}
        for n, parts in found.items():
            hashes, start, after, item = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(hashes, kind="stable")
            bits = max(12, len(hashes).bit_length() + 3)
            shift = np.uint64(64 - bits)
            seen = np.zeros(1 << bits, bool)
            seen[hashes >> shift] = True
            self.lengths[n] = (hashes[order], start[order], after[order], item[order].astype(np.int32), seen, shift)

    def lookup(self, n: int, x: np.uint64, words: bytes) -> tuple | None:
        """The ids of the items that have this window of ``n`` words and hash
        ``x``; None if none has it."""
        hashes, start, after, item, _, _ = self.lengths[n]
        lo, hi = np.searchsorted(hashes, x, "left"), np.searchsorted(hashes, x, "right")
        same = [k for k in range(lo, hi) if self.text[start[k]:after[k]] == words]
        return tuple({self.names[item[k]] for k in same} - {None}) if same else None

    def scan(self, data: np.ndarray, off: np.ndarray, memo: dict, known=None):
        """For texts given by bytes and offsets: yields per text its number of
        words, the word runs that are hit (sorted, disjoint, as first and after
        last; those ``known`` included), the runs' byte ranges, and the items."""
        s, e, h, doc = words_of(data, off)
        n_words = np.bincount(doc, minlength=len(off) - 1)
        start = np.concatenate(([0], np.cumsum(n_words))).tolist()
        raw = data.tobytes()
        hits: dict[int, list] = {d: [(a + start[d], b + start[d]) for a, b in runs] for d, runs in enumerate(known or ()) if runs}
        items: dict[int, set] = {}
        for n, (hashes, _, _, _, seen, shift) in self.lengths.items():
            x = window_hashes(h, n)
            at = np.flatnonzero(seen[x >> shift])
            at = at[doc[at] == doc[at + n - 1]]
            at = at[hashes[np.minimum(np.searchsorted(hashes, x[at]), len(hashes) - 1)] == x[at]]
            for i in at.tolist():
                piece = raw[s[i]:e[i + n - 1]]
                names = memo.get((n, piece), False)
                if names is False:
                    names = self.lookup(n, x[i], _SPLIT.sub(b" ", piece.lower()))
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[n, piece] = names
                if names is not None:
                    d = int(doc[i])
                    hits.setdefault(d, []).append((i, i + n))
                    items.setdefault(d, set()).update(names)
        for d in range(len(off) - 1):
            runs = merged(hits.get(d, ()))
            yield (int(n_words[d]), [(a - start[d], b - start[d]) for a, b in runs],
                   [(int(s[a] - off[d]), int(e[b - 1] - off[d])) for a, b in runs], items.get(d, set()))


def merged(runs) -> list[tuple[int, int]]:
    """Sorted disjoint runs that cover the same places."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_RUN = "array<struct<first:int,after:int>>"
SCAN = f"_n_words long, _runs {_RUN}, _bytes {_RUN}, _items array<string>"


def _scan_block(rows: DataFrame, windows: WindowSet, text: str) -> DataFrame:
    """``rows`` with the columns of SCAN; what these hold already is joined."""
    spark = rows.sparkSession
    importable(spark)
    sent = spark.sparkContext.broadcast(windows)
    sent_id = uuid.uuid4().hex
    kept = [f for f in rows.schema if f.name not in ("_n_words", "_runs", "_bytes", "_items")]
    again = len(kept) < len(rows.schema)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", " + SCAN

    def run(batches):
        import pyarrow as pa
        memo = worker_store(f"decontaminate {sent_id}").setdefault("memo", {})
        pair = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))
        for b in batches:
            if not b.num_rows:
                continue
            data, off = utf8(b.column(b.schema.get_field_index(text)))
            known = [[(r["first"], r["after"]) for r in x] for x in b.column(b.schema.get_field_index("_runs")).to_pylist()] if again else [()] * b.num_rows
            found = [x for i, j in blocks(off, BLOCK) for x in sent.value.scan(data[off[i]:off[j]], off[i:j + 1] - off[i], memo, known[i:j])]
            n, runs, places, items = (list(c) for c in zip(*found, strict=True))
            if again:
                items = [x.union(y) for x, y in zip(items, b.column(b.schema.get_field_index("_items")).to_pylist(), strict=True)]
            as_runs = [pa.array([[{"first": a, "after": z} for a, z in x] for x in c], pair) for c in (runs, places)]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(f.name)) for f in kept), pa.array(n, pa.int64()), *as_runs, pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                                             names=[*(f.name for f in kept), "_n_words", "_runs", "_bytes", "_items"])

    return rows.mapInArrow(run, schema)


def item_blocks(items: DataFrame, item_id: str, text: str, window: int, set_bytes: int):
    """The items as WindowSets of about ``set_bytes`` bytes of text each."""
    one = items.select(F.col(f"`{item_id}`").cast("string").alias("name"), F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "utf-8").alias("text"))
    size = one.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-size // set_bytes) or 1
    if parts > 1:
        one = stage(one.withColumn("part", F.pmod(F.xxhash64("name", "text"), F.lit(parts))), "benchmark-items")
    for k in range(parts):
        rows = one.where(F.col("part") == k) if parts > 1 else one
        yield WindowSet(((r["name"], bytes(r["text"])) for r in rows.select("name", "text").collect()), window)  # at most set_bytes


def scan(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = WINDOW, set_bytes: int = SET_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc`` (a struct of all its columns, so
    that their names can't clash), n_words, n_hit, runs (hit words, from 0),
    bytes (the UTF-8 byte ranges of the runs) and items (sorted ids as text).

    A null or empty text has no words and no hits.  Items without words have no
    windows; repeated items count once; an item with a null id hits words but
    is not named.  Without items nothing is hit; an empty table gives none.
    Very long texts are scanned whole."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{text}`").alias("_text"))
    many = False
    for windows in item_blocks(items, item_id, item_text, window, set_bytes):
        if many:
            rows = stage(rows, "scanned")
        rows, many = _scan_block(rows, windows, "_text"), True
    hit = F.aggregate("_runs", F.lit(0).cast("long"), lambda a, r: a + r["after"] - r["first"])
    return rows.select("doc", "_text", F.col("_n_words").alias("n_words"), hit.alias("n_hit"), F.col("_runs").alias("runs"),
                       F.col("_bytes").alias("bytes"), F.col("_items").alias("items"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", remove: str = "spans", max_share: float = 1.0, **how) -> DataFrame:
    """``docs`` without test passages, in its own columns.

    ``remove="documents"`` drops every row with a hit.  ``remove="spans"`` cuts
    the hit runs out of the text (from a run's first to its last word, with
    what lies between) and puts one blank between what remains; rows of which
    more than ``max_share`` of the words is hit are dropped.  Other rows keep
    their texts unchanged, null ones too.  ``how``: as for :func:`scan`."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove is spans or documents")
    found = scan(docs, items, text, **how)
    if remove == "documents":
        return found.where("n_hit = 0").select("doc.*")
    found = found.where(F.col("n_hit") <= F.lit(max_share) * F.col("n_words"))
    raw = F.encode("_text", "utf-8")
    # What lies before, between and behind the cut ranges.
    ends = F.concat(F.array(F.lit(0)), F.transform("bytes", lambda r: r["after"]))
    starts = F.concat(F.transform("bytes", lambda r: r["first"]), F.array(F.octet_length("_text").cast("int")))
    left = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda p: F.decode(F.substring(raw, p["e"] + 1, p["s"] - p["e"]), "utf-8"))
    clean = F.when(F.size("bytes") > 0, F.concat_ws(" ", F.filter(F.transform(left, lambda x: F.btrim(x)), lambda x: x != ""))).otherwise(F.col("_text"))
    return found.select(*[(clean if c == text else F.col("doc")[c]).alias(c) for c in docs.columns])


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every
    row of ``documents``."""
    found = scan(docs.select("doc_id", "text"), benchmark)
    return found.select("doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
