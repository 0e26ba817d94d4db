"""Operator 9, SentencePiece encoding and decoding: a weighted transducer.

A model file is compiled into three small machines: the normaliser (the model's
character map, blanks joined where it says so, a word mark before the text and
for every blank), the pieces, and byte fallback (a character that no piece
spells becomes its UTF-8 bytes' pieces).  A text is
composed with them: a lattice whose states are places in the text with the last
piece, and whose arcs are the pieces that spell what follows.  Its shortest
path in the tropical semiring is the encoding.

Weights.  In a unigram model an arc weighs the piece's negative log
probability.  In a BPE model a piece may follow another at weight zero if
merging the two pieces' characters by the model's merge order ends in just
these two, else at infinite weight.  That is exact: merges happen in order of
score, then from the left; the first merge across a boundary between two pieces
depends on those two alone, as it is up against their own merges only.  So a
sequence is the model's encoding exactly if each neighbouring pair is, and
every place of the text is reached by one path of finite weight.

No piece holds a visible character followed by a word mark, nor a letter
followed by a stop, and no merge involves a character that no piece holds.  The
lattice is therefore cut there (these facts are checked when compiling), and each worker remembers the shortest
paths of the stretches between.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import importable, worker_store

MARK = "▁"
MEMORY = 1_000_000     #: stretches whose path a worker remembers
PAIRS = 2_000_000      #: pairs whose weight a worker remembers
LETTERS = "".join(c for c in map(chr, range(0x24F)) if c.isalpha())
LONG = 64              #: longer stretches are not remembered

_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE, _UNUSED = 1, 2, 3, 4, 6, 5


def character_map(blob: bytes) -> dict[str, str]:
    """The keys of a model's character map and what replaces each.

    The file's form: the trie's length in bytes, the trie as a double array of
    32-bit units, and the replacements, each ended by a zero byte.  A unit's
    lowest byte is the byte that leads to it, bit 8 says that a key ends there,
    and the bits from 10 on (times 256 if bit 9 is set), xor its own place, tell
    where its children begin; a key's unit there holds the replacement's place."""
    size = int.from_bytes(blob[:4], "little")
    unit, values = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64), blob[4 + size:]
    label, offset = unit & 0x800000FF, (unit >> 10) << ((unit & 0x200) >> 6)
    letters = np.arange(1, 256)
    rules: dict[str, str] = {}
    todo = [(int(offset[0]), b"")] if len(unit) else []
    while todo:
        base, key = todo.pop()
        place = base ^ letters
        there = place < len(unit)
        for p in place[there][label[place[there]] == letters[there]].tolist():
            below, longer = p ^ int(offset[p]), key + bytes([p ^ base])
            if unit[p] & 0x100:
                v = int(unit[below]) & 0x7FFFFFFF
                rules[longer.decode()] = values[v:values.index(b"\0", v)].decode()
            todo.append((below, longer))
    return rules


def _any_of(chars) -> str:
    """A regular expression for one of the characters, written as ranges."""
    codes = sorted({ord(c) for c in chars})
    starts = [c for c, before in zip(codes, [-1, *codes], strict=False) if c != before + 1]
    ends = [c for c, after in zip(codes, [*codes[1:], -1], strict=True) if after != c + 1]
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends, strict=True)) + "]"


class Normaliser:
    """A model's character map: at each place the longest key is replaced, a
    character that begins none stays.  With ``squeeze`` a blank goes if the
    output before it ends in one, and blanks and marks go at the ends."""

    def __init__(self, blob: bytes, squeeze: bool):
        self.rules, self.squeeze = character_map(blob) if blob else {}, squeeze
        self.longest = max(map(len, self.rules), default=0)
        single, pairs = [k for k in self.rules if len(k) == 1], [k for k in self.rules if len(k) > 1]
        found = [_any_of(single)] if single else []
        if pairs:
            found.append(f"{_any_of(k[0] for k in pairs)}(?={_any_of(k[1] for k in pairs)})")
        #: Where a key may begin: nowhere else is a rule looked for.
        self.suspect = re.compile("|".join(found) or r"(?!)")

    def parts(self, text: str):
        """The pieces of the output in order: untouched stretches (True) and replacements (False)."""
        i = 0
        while m := self.suspect.search(text, i):
            k = m.start()
            if k > i:
                yield text[i:k], True
            for j in range(min(k + self.longest, len(text)), k, -1):
                if (new := self.rules.get(text[k:j])) is not None:
                    yield new, False
                    i = j
                    break
            else:
                yield text[k], True
                i = k + 1
        if i < len(text):
            yield text[i:], True

    def __call__(self, text: str) -> str:
        if not self.squeeze:
            return "".join(x for x, _ in self.parts(text))
        out, blank = [], True
        for x, untouched in self.parts(text):
            if untouched:
                x = re.sub("  +", " ", x)
            if blank:
                x = x.lstrip(" ")
            if x:
                out.append(x)
                blank = x.endswith(" ")
        return "".join(out).rstrip(" " + MARK)


class Transducer:
    """A compiled model."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only normalisers that mark blanks, in front of words, are compiled")
        if model.trainer_spec.model_type not in (1, 2) or any(p.type in (_USER, _UNUSED) for p in model.pieces):
            raise ValueError("only unigram and BPE models without user-defined pieces are compiled")
        self.bpe = model.trainer_spec.model_type == 2
        self.prefix, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        #: None if the model changes nothing but blanks.
        self.normal = Normaliser(norm.precompiled_charsmap, self.squeeze) if norm.precompiled_charsmap or self.squeeze else None
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.score = [p.score for p in model.pieces]
        self.piece = [p.piece for p in model.pieces]
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == _UNKNOWN)
        bytes_of = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.byte = [bytes_of[b] for b in range(256)] if len(bytes_of) == 256 else None
        #: What each id spells, for decoding.
        self.spell = [p.piece.replace(MARK, " ").encode() if p.type == _NORMAL else bytes([int(p.piece[3:5], 16)]) if p.type == _BYTE
                      else " ⁇ ".encode() if p.type == _UNKNOWN else b"" for p in model.pieces]
        #: Every beginning of a piece, with the piece's id if it is a whole one, else -1.
        self.stems = {p[:k]: self.ids.get(p[:k], -1) for p in self.ids for k in range(1, len(p) + 1)}
        #: A character that isn't a piece weighs more than any path of pieces.
        self.rare = -min([0.0, *(s for p, s in zip(self.piece, self.score, strict=True) if p in self.ids and s > -1e8)]) + 10.0
        held = set("".join(self.ids))
        cuts = "".join(c for c in "\n\t\r" if c not in held)
        cut = f"[{cuts}]|" if cuts else ""
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            self.stretch = re.compile(f"{cut}[^{cuts}]+" if cuts else r"(?s:.+)")
        else:
            # Nor does a piece hold a letter followed by one of these stops.
            beside = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
            stops = "".join(c for c in ",.;:!?" if not any(x[1] == c and x[0] in LETTERS for x in beside))
            word = f" *[{LETTERS}]+(?=[{stops}])|" if stops else ""
            self.stretch = re.compile(f"{cut}{word} +[^ {cuts}]*|[^ {cuts}]+")
        self.paths: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}   # keyed by a * 2**32 + b

    def merged(self, text: str) -> list[str]:
        """BPE by its definition: the best-scored mergeable neighbours first,
        then the leftmost (for pairs of pieces, so at most two pieces long)."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, a: int, b: int) -> bool:
        """Has piece ``b`` after piece ``a`` (-1: a fresh start) finite weight?"""
        first = self.piece[a] if a >= 0 else ""
        known = self.merged(first + self.piece[b]) == [*([first] if first else []), self.piece[b]]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[(a << 32) + b] = known
        return known

    def shortest(self, text: str) -> list[int]:
        """The shortest path through the lattice of a normalised text."""
        n = len(text)
        ids, stems = self.ids, self.stems
        last: list[int | None] = [-1] + [None] * n     # the last piece of the path to each place, -1 after bytes
        back = [0] * (n + 1)
        if self.bpe:                                   # weights are zero or infinite: a place is reached or not
            pairs, follows = self.pairs, self.follows
            for i in range(n):
                a = last[i]
                if a is None:
                    continue
                context = a << 32
                for j in range(i + 1, n + 1):
                    p = stems.get(text[i:j])
                    if p is None:
                        break
                    if p >= 0 and last[j] is None:
                        ok = pairs.get(context + p)
                        if ok or ok is None and follows(a, p):
                            last[j], back[j] = p, i
                if last[i + 1] is None and text[i] not in ids:    # fallback: merges with nothing
                    last[i + 1], back[i + 1] = -1, i
        else:
            weight = [0.0] + [float("inf")] * n
            for i in range(n):
                w = weight[i]
                for j in range(i + 1, n + 1):
                    p = stems.get(text[i:j])
                    if p is None:
                        break
                    if p >= 0 and w - self.score[p] < weight[j]:
                        weight[j], last[j], back[j] = w - self.score[p], p, i
                if text[i] not in ids and w + self.rare < weight[i + 1]:
                    weight[i + 1], last[i + 1], back[i + 1] = w + self.rare, -1, i
        out: list[int] = []
        j = n
        while j:
            p = last[j]
            if p >= 0:
                out.append(p)
            elif self.byte:
                out.extend(self.byte[b] for b in reversed(text[j - 1].encode("utf-8", "surrogatepass")))
            elif not (out and out[-1] == self.unknown):
                out.append(self.unknown)
            j = back[j]
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian signed 32-bit numbers."""
        if not text:
            return b""
        if self.normal:
            text = self.normal(text)
            if not text and self.squeeze:
                return b""
        text = text.replace(MARK, " ")
        paths, out = self.paths, []
        for s in self.stretch.findall(" " + text if self.prefix else text):
            p = paths.get(s)
            if p is None:
                p = np.array(self.shortest(s.replace(" ", MARK)), "<i4").tobytes()
                if len(s) <= LONG:
                    if len(paths) >= MEMORY:
                        paths.clear()
                    paths[s] = p
            out.append(p)
        if self.byte is None:    # unknown characters in a row have one id, across stretches too
            ids = np.frombuffer(b"".join(out), "<i4")
            return ids[~((ids == self.unknown) & (np.append(-1, ids[:-1]) == self.unknown))].tobytes()
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The (normalised) text that ids spell; bytes that aren't UTF-8 become U+FFFD."""
        if self.squeeze:         # each piece loses a mark while there is no text before it
            for k, i in enumerate(ids):
                x = self.spell[i]
                if x and self.piece[i] != MARK:
                    first = x[1:] if x.startswith(b" ") and self.piece[i].startswith(MARK) else x
                    return b"".join([first, *map(self.spell.__getitem__, ids[k + 1:])]).decode("utf-8", "replace")
            return ""
        text = b"".join(map(self.spell.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def compiled(path: str) -> Transducer:
    """The transducer of a model file, compiled once per Python worker."""
    store = worker_store("transducer")
    if path not in store:
        store[path] = Transducer(path)
    return store[path]


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``ids``, n_ids, ids_crc32 (unsigned, of the ids
    as little-endian 32-bit numbers) and round_trip (decoding gives the text,
    which it can't where the model's normaliser changes it) of every whole text,
    however long.  Null text is as empty: no ids.  Repeated rows stay, each with
    its ids; an empty table gives none.  No shuffle."""
    from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructType
    importable(docs.sparkSession)
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))

    def run(batches):
        import pyarrow as pa
        t = compiled(path)
        for b in batches:
            for s in range(0, b.num_rows, 512):
                part = b.slice(s, 512)
                data, sizes, crc, same = [], [0], [], []
                for x in part.column(len(keep)).to_pylist():
                    e = t.encode(x or "")
                    data.append(e)
                    sizes.append(sizes[-1] + len(e) // 4)
                    crc.append(zlib.crc32(e))
                    same.append(t.decode(np.frombuffer(e, "<i4").tolist()) == (x or ""))
                ids = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.frombuffer(b"".join(data), "<i4"), pa.int32()))
                n = pa.array(np.diff(sizes), pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), ids, n, pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
                                                 names=[*keep, "ids", "n_ids", "ids_crc32", "round_trip"])

    schema = StructType([src.schema[c] for c in keep]).add("ids", ArrayType(IntegerType())).add("n_ids", LongType()).add("ids_crc32", LongType()).add("round_trip", BooleanType())
    return src.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids", keep: tuple = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with the ``text`` that each row's ids spell (null
    ids: null)."""
    from pyspark.sql.types import StringType, StructType
    importable(rows.sparkSession)
    src = rows.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids}`").alias("_ids"))

    def run(batches):
        import pyarrow as pa
        t = compiled(path)
        for b in batches:
            texts = [None if x is None else t.decode(x) for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(texts, pa.string())], names=[*keep, "text"])

    return src.mapInArrow(run, StructType([src.schema[c] for c in keep]).add("text", StringType()))
