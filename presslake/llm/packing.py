"""Operator 6, packing: first-fit decreasing with a tournament tree.

Documents become token ids and an end mark; ids are cut into pieces of at most
a sequence's length.  Pieces are dealt into random groups; within a group the
longest piece goes first, each into the first sequence that still has room.  A
tournament tree over the sequences' free room finds that one in log(n) steps.

Tokenizing needs no shuffle.  What is shuffled is a row of a few numbers for
each piece, not its ids.  Groups hold about GROUP pieces whatever the input's
size and are packed independently, so nothing is ever gathered in one place.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import blocks, importable, stage, utf8, worker_store

CAPACITY = 2048
END_ID = 1
GROUP = 8192             #: pieces of a group, about
BLOCK = 1 << 16          #: a group beyond this (identical rows only) is packed in blocks
CACHE_WORDS = 700_000    #: words whose ids a Python worker remembers
TEXT = 1 << 21           #: bytes of text whose words are looked up at once

#: Words that the normaliser leaves as they are and that are one pre-token, before a stop that is another.
_PLAIN = re.compile("([a-z\u00e0-\u00f6\u00f8-\u00ff]+)([.,]?)")
_STOPS = (".", ",")
_BLANKS = np.arange(256, dtype=np.uint8)
_BLANKS[[0x09, 0x0A, 0x0D]] = 0x20


class WordEncoder:
    """Ids of texts by a tokenizer whose tokens never reach across white space
    and for which white space yields no token: each word between blanks, tabs
    and line ends is encoded once and remembered.

    (Its normaliser changes no character because of a blank beside it, its
    pre-tokens hold no white space, its special strings none either.  Other
    white space stays inside a word and is left to the tokenizer.  Latin-1
    texts that can't hold a special string are lower-cased before, as the
    normaliser does anyway, and words of plain letters go to the same model
    without the normaliser and the pattern, which would change nothing.)"""

    def __init__(self, path: str, words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.bare = Tokenizer(self.tok.model)   # shares the model
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words = words
        self.ids: dict[str, bytes] = {}

    def _learn(self, tok, words: list[str], here: dict[str, bytes]) -> None:
        for i in range(0, len(words), 50_000):
            part = words[i:i + 50_000]
            for w, e in zip(part, tok.encode_batch_fast(part, add_special_tokens=False), strict=True):
                here[w] = self.ids[w] = array("I", e.ids).tobytes()

    def _known(self, words: list[str]) -> list[bytes]:
        """The ids of different words."""
        ids, here = self.ids, {}
        bare, other, stopped = [], [], []
        for w in (*_STOPS, *words):
            known = ids.get(w)
            if known is not None:
                here[w] = known
            elif (m := _PLAIN.fullmatch(w)) is None:
                other.append(w)
            elif m[2]:
                stopped.append(m)
            else:
                bare.append(w)
        here.update((w, b"") for w in bare)
        for c in {m[1] for m in stopped if m[1] not in here}:
            if c in ids:
                here[c] = ids[c]
            else:
                bare.append(c)
        if len(ids) + len(bare) + len(other) > self.words:
            self.ids = {}
        self._learn(self.bare, bare, here)
        self._learn(self.tok, other, here)
        here.update((m[0], here[m[1]] + here[m[2]]) for m in stopped)
        return [here[w] for w in words]

    def encode_column(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of an Arrow string array without nulls, in order, and the
        offsets of each text's."""
        import pyarrow as pa
        import pyarrow.compute as pc
        as_is = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, "[^\\x{00}-\\x{ff}]"))
        data, off = utf8(pc.if_else(as_is, texts, pc.utf8_lower(texts)))
        plain = pa.StringArray.from_buffers(len(texts), pa.py_buffer(off.astype(np.int32)), pa.py_buffer(_BLANKS[data]))
        words = pc.split_pattern(plain, " ")
        coded = words.flatten().dictionary_encode()
        known = self._known(coded.dictionary.to_pylist())
        size = np.array([len(x) // 4 for x in known], np.int64)
        flat = np.frombuffer(b"".join(known), "<u4")
        which = coded.indices.to_numpy()
        n = size[which]
        end = np.cumsum(n)
        ids = flat[np.repeat((np.cumsum(size) - size)[which] - (end - n), n) + np.arange(end[-1] if len(end) else 0)]
        return ids, np.concatenate(([0], end))[words.offsets.to_numpy() - words.offsets[0].as_py()]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        import pyarrow as pa
        ids, off = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(off[:-1], off[1:], strict=True)]


def _encoder(path: str) -> WordEncoder:
    store = worker_store("packing")
    if path not in store:
        store[path] = WordEncoder(path)
    return store[path]


def cut_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                  text: str = "text", keep: tuple = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """The pieces of each whole text: the columns ``keep``, start (the
    document's ids before it), length, ids_crc32, doc_tokens and, if wanted,
    ``ids``.  Null text is as empty: one piece that holds the end mark."""
    from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    names = ["start", "length", "ids_crc32", "doc_tokens"]

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        enc = _encoder(path)
        tail = np.array([end_id], "<u4").tobytes()
        for b in batches:
            row, cols, ids = [], [[], [], [], []], []
            texts = pc.fill_null(b.column(len(keep)), "")
            for i, j in blocks(utf8(texts)[1], TEXT):
                all_ids, off = enc.encode_column(texts.slice(i, j - i))
                for k in range(i, j):
                    data = all_ids[off[k - i]:off[k - i + 1]].tobytes() + tail
                    n = len(data) // 4
                    for s in range(0, n, capacity):
                        piece = data[4 * s:4 * (s + capacity)]
                        row.append(k)
                        for c, v in zip(cols, (s, len(piece) // 4, zlib.crc32(piece), n), strict=True):
                            c.append(v)
                        if with_ids:
                            ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
            took = pa.array(row, pa.int64())
            out = [*(b.column(i).take(took) for i in range(len(keep))), *(pa.array(c, pa.int64()) for c in cols)]
            if with_ids:
                out.append(pa.array(ids, pa.list_(pa.int32())))
            pa.default_memory_pool().release_unused()
            yield pa.RecordBatch.from_arrays(out, names=[*keep, *names, *(["ids"] if with_ids else [])])

    importable(docs.sparkSession)
    schema = StructType([src.schema[c] for c in keep])
    for c in names:
        schema = schema.add(c, LongType())
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))
    return src.mapInArrow(run, schema)


def first_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, in the order given (longest first for
    first-fit decreasing).  Leaf i of the tournament tree is bin i's free room,
    every node above holds the larger of its two."""
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for n in lengths:
        if not 0 <= n <= capacity:
            raise ValueError(f"a piece of {n} doesn't fit in {capacity}")
        i = 1
        while i < leaves:
            i *= 2
            if tree[i] < n:
                i += 1
        bins.append(i - leaves)
        offsets.append(capacity - tree[i])
        tree[i] -= n
        i >>= 1
        while i:
            top = max(tree[2 * i], tree[2 * i + 1])
            if tree[i] == top:
                break
            tree[i] = top
            i >>= 1
    return bins, offsets


def pack(pieces: DataFrame, content: tuple, capacity: int = CAPACITY, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """``pieces`` (with ``length``) with sequence_id and offset.

    ``pieces`` must be staged (it is read twice).  A piece's group is a hash of
    its ``content`` columns; equal pieces share a group, and a group beyond
    ``block`` pieces is packed block by block.  All columns stay."""
    from pyspark.sql.types import LongType, StructType
    groups = max(1, -(-pieces.count() // group))
    hashed = pieces.withColumn("_g", F.pmod(F.xxhash64(F.lit("pack"), *[F.col(f"`{c}`") for c in content]), F.lit(groups)))
    names = pieces.columns

    def run(batches):
        import pyarrow as pa
        held, rows, now, done = [], 0, None, 0

        def flush():
            t = pa.Table.from_batches(held)
            bins, offsets = first_fit(t.column("length").to_pylist(), capacity)
            # A group's number, then the sequence's number in it.
            ids = pa.array((np.array(bins, np.int64) + done) + (np.int64(now) << 32))
            out = pa.Table.from_arrays([*(t.column(c) for c in names), ids, pa.array(offsets, pa.int64())], names=[*names, "sequence_id", "offset"])
            return out.combine_chunks().to_batches(), max(bins) + 1

        for b in batches:
            g = b.column(b.schema.get_field_index("_g")).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else []
            for i, j in zip(cuts, [*cuts[1:], len(g)], strict=True):
                if now is not None and g[i] != now:
                    if held:
                        yield from flush()[0]
                    held, rows, done = [], 0, 0
                now = int(g[i])
                while i < j:
                    take = min(j - i, block - rows)
                    held.append(b.slice(int(i), int(take)))
                    rows += take
                    i += take
                    if rows == block:
                        out, used = flush()
                        yield from out
                        held, rows, done = [], 0, done + used
        if held:
            yield from flush()[0]

    importable(pieces.sparkSession)
    schema = StructType(list(pieces.schema.fields)).add("sequence_id", LongType()).add("offset", LongType())
    order = ["_g", F.desc("length"), *[F.col(f"`{c}`") for c in content]]
    return hashed.repartition("_g").sortWithinPartitions(*order).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """Tokenize, cut and pack every row of ``documents`` (doc_id, text).

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    of each piece.  Null and repeated rows are documents like any other; an
    empty table gives none."""
    pieces = stage(cut_documents(docs, path, capacity, end_id), "pieces")
    return pack(pieces, ("doc_id", "start", "ids_crc32", "length", "doc_tokens"), capacity, group)
