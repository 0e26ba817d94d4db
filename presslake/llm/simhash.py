"""Operator 2, SimHash near-dedup: pivot distance tables.

A fingerprint has a bit set if more than half of the text's shingle hashes
have.  Texts link if their fingerprints differ in few bits.

Every distinct fingerprint gets its Hamming distances to reference
fingerprints, the pivots: a base, the base with each single bit flipped, and
some unrelated ones.  Two fingerprints that differ in r bits differ by at most
r in each distance.  Distances to unrelated pivots alone all lie near 32 and
tell little; the difference between the distances to the base and to a
flipped pivot is a coordinate that r differing bits change in r pivots only.
These 64 coordinates are dealt into r + 2 parts: linked fingerprints agree in
at least two of them, so candidates are those that agree in all coordinates of
two parts.  Candidates whose distances differ too much at any unrelated pivot
are discarded, survivors are verified.

A candidate group of more than GROUP fingerprints (thousands of near copies)
is not paired: its fingerprints meet at the fingerprints next to them instead
(for r = 2, two fingerprints link exactly if both are within one bit of a
third), at most 65 of them at each, which costs 65 rows a fingerprint however
large the group is.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.llm.common import blocks, importable, stage, utf8, worker_store

SHINGLE = 3
SEED = 42
MAX_BITS = 2
SALTS = 16
GROUP = 48              #: largest candidate group that is paired
BLOCK = 1 << 19         #: bytes of text that are fingerprinted at once
BASE_PIVOT = 0x5DEECE66D1234567
#: Unrelated pivots.
OTHER_PIVOTS = tuple((0x9E3779B97F4A7C15 * (k + 1) ^ 0xC2B2AE3D27D4EB4F) & (1 << 64) - 1 for k in range(16))

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[_SPACE] = 0x20


def fingerprints(data: np.ndarray, off: np.ndarray, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The SimHash of texts, given their UTF-8 bytes and offsets (uint64)."""
    import xxhash
    n = len(off) - 1
    out = np.zeros(n, np.uint64)
    if not len(data):
        return out
    space = _SPACE[data]
    start = np.zeros(len(data) + 1, bool)
    start[off] = True
    begin, end = ~space, ~space
    begin[1:] &= space[:-1] | start[1:-1]
    end[:-1] &= space[1:] | start[1:-1]
    ws, we = np.flatnonzero(begin), np.flatnonzero(end) + 1
    if not len(ws):
        return out
    doc = np.searchsorted(off, ws, "right") - 1
    keep = ~space                         # and one blank after each word
    keep[1:] |= end[:-1] & ~start[1:-1] & space[1:]
    place = np.cumsum(keep) - 1
    s, e = place[ws], place[we - 1] + 1
    text = _LOWER[data[keep]].tobytes()
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    count = np.diff(np.append(first, len(doc)))
    # Shingle k of a text starts at its word k; a text of fewer words has one.
    number = np.maximum(count - shingle + 1, 1)
    which = np.repeat(np.arange(len(first)), number)
    at = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number) + first[which]
    last = np.minimum(at + shingle - 1, (first + count - 1)[which])
    lo, hi = s[at].tolist(), e[last].tolist()
    sums = np.zeros((len(first), 64), np.int64)
    digest = xxhash.xxh64_intdigest
    view = memoryview(text)
    step = 1 << 17
    for i in range(0, len(lo), step):
        h = np.array([digest(view[a:b], seed) for a, b in zip(lo[i:i + step], hi[i:i + step], strict=True)], np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        w = which[i:i + step]
        cut = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        sums[w[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    major = (2 * sums > number[:, None]).astype(np.uint8)
    out[doc[first]] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def add_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp",
                    shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``docs`` with each whole text's SimHash as a signed long column.  Null
    texts and texts without a word get 0."""
    from pyspark.sql.types import LongType, StructType
    kept = [c for c in docs.columns if c != out]

    def run(batches):
        import pyarrow as pa
        worker_store("simhash")
        for b in batches:
            data, off = utf8(b.column(b.schema.get_field_index(text)))
            fp = [fingerprints(data[off[i]:off[j]], off[i:j + 1] - off[i], shingle, seed) for i, j in blocks(off, BLOCK)]
            fp = np.concatenate(fp) if fp else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in kept), pa.array(fp.view(np.int64))], names=[*kept, out])

    importable(docs.sparkSession)
    return docs.mapInArrow(run, StructType([docs.schema[c] for c in kept]).add(out, LongType()))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _to(fp: Column, pivot: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(_signed(pivot)).cast("long")))


def pivot_table(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fp with its distances ``far`` to the unrelated pivots and its ``parts``:
    the coordinates from the base and flipped pivots, as bits of max_bits + 2
    numbers."""
    groups = max_bits + 2
    base = _to(F.col("fp"), BASE_PIVOT)
    parts = []
    for g in range(groups):
        number = None
        for k, bit in enumerate(range(g, 64, groups)):
            # base - flipped is +1 or -1
            cell = (base - _to(F.col("fp"), BASE_PIVOT ^ (1 << bit)) + 1).cast("long")
            number = F.shiftright(cell, 1) if number is None else number + F.shiftleft(F.shiftright(cell, 1), k)
        parts.append(number)
    return fps.select("fp", F.array(*[_to(F.col("fp"), p).cast("byte") for p in OTHER_PIVOTS]).alias("far"), F.array(*parts).alias("parts"))


def links(fps: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """Links (a, b), a < b, between distinct fingerprints ``fp``: among them a
    path joins any two fingerprints that differ in at most ``max_bits`` bits,
    and every link is one."""
    table = pivot_table(fps, max_bits)
    pairs = list(combinations(range(max_bits + 2), 2))
    keys = F.array(*[F.struct(F.lit(k).cast("byte").alias("slot"), F.col("parts")[i].alias("p"), F.col("parts")[j].alias("q")) for k, (i, j) in enumerate(pairs)])
    dealt = table.select("fp", "far", F.explode(keys).alias("k")).select("fp", "far", "k.*")
    dealt = stage(dealt, "pivot-keys")
    cell = ["slot", "p", "q"]
    sizes = stage(dealt.groupBy(*cell).agg(F.count("*").alias("n")).where("n > 1"), "group-sizes")
    small = dealt.join(sizes.where(F.col("n") <= group).select(*cell), cell)
    a, b = small.select(*cell, F.col("fp").alias("a"), F.col("far").alias("fa")), small.select(*cell, F.col("fp").alias("b"), F.col("far").alias("fb"))
    near = F.forall(F.zip_with("fa", "fb", lambda x, y: F.abs(x.cast("int") - y.cast("int"))), lambda d: d <= max_bits)
    alike = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    paired = a.join(b, cell).where((F.col("a") < F.col("b")) & near & alike).select("a", "b")
    if max_bits != 2:
        if not sizes.where(F.col("n") > group).isEmpty():
            raise ValueError("large groups are handled for max_bits = 2")
        return paired.distinct()
    crowded = dealt.join(sizes.where(F.col("n") > group).select(*cell), cell).select("fp").distinct()
    next_to = F.expr("transform(sequence(-1, 63), k -> if(k < 0, fp, fp ^ shiftleft(1L, greatest(k, 0))))")
    met = (crowded.select("fp", F.explode(next_to).alias("z")).groupBy("z")
           .agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all")).where(F.size("all") > 1))  # at most 65
    star = met.select("a", F.explode("all").alias("b")).where("a < b")
    return paired.unionByName(star).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): every node with ``root``, the
    smallest node that it reaches.

    Alternates large-star (a node's larger neighbours join its smallest one)
    and small-star (its smaller ones do) until nothing changes: about log(n)
    rounds, each two aggregations and joins keyed by node, written between."""
    edges = stage(edges.select("a", "b").distinct(), "edges")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(low, F.col("a") == F.col("n")).where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        large = stage(large, "large-star")
        # Small-star: of a node's smaller neighbours all but the smallest, and the node, join that one.
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.withColumnRenamed("b", "n").join(down.withColumnRenamed("b", "n"), "n")
        small = joined.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b").unionByName(down.select(F.col("m").alias("a"), "b")).distinct()
        edges = stage(small, "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.groupBy("b").agg(F.min("a").alias("root")).withColumnRenamed("b", "node")
    own = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return roots.unionByName(own)


def grouped(rows: DataFrame, key: str, max_bits: int = MAX_BITS) -> DataFrame:
    """Staged table of the distinct ``fp`` of ``rows`` (staged; key and fp):
    low (smallest key), rows, copies (rows of that key), linked, and of its
    component ``root``, component_id (smallest key) and best (the fingerprint,
    smallest if several, that has it)."""
    pairs = rows.groupBy("fp", F.col(f"`{key}`").alias("k")).agg(F.count("*").alias("n"))
    # Null keys come last.
    fps = stage(pairs.groupBy("fp").agg(F.min(F.struct(F.col("k").isNull().alias("none"), "k", "n")).alias("m"), F.sum("n").alias("rows"))
                .select("fp", F.col("m.k").alias("low"), F.col("m.n").alias("copies"), "rows"), "distinct-fingerprints")
    roots = components(links(fps.select("fp"), max_bits))
    named = stage(fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", "copies", "rows", F.col("node").isNotNull().alias("linked"), F.coalesce("root", "fp").alias("root")), "roots")
    best = named.groupBy(F.col("root").alias("r")).agg(F.min(F.struct(F.col("low").isNull().alias("none"), "low", "fp")).alias("b"))
    return stage(named.join(best, F.col("root") == F.col("r")).select("fp", "low", "copies", "rows", "linked", "root", F.col("b.low").alias("component_id"), F.col("b.fp").alias("best")), "components")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS,
                    shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: key, fp (long) and component_id (the
    smallest key that links reach).

    Equal fingerprints are one node, so copies are never paired.  Null keys are
    reached like others but never name a component (a component of null keys
    only has a null id).  Texts without words have fingerprint 0 and link as
    any other; an empty table gives none."""
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("_text"))
    rows = stage(add_fingerprint(rows, "_text", "fp", shingle, seed).drop("_text"), "fingerprints")
    of = grouped(rows, key, max_bits).select(F.col("fp").alias("f"), "component_id")
    return rows.join(of, F.col("fp") == F.col("f")).drop("f")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS,
             shingle: int = SHINGLE, seed: int = SEED, broadcast_rows: int = 500_000) -> DataFrame:
    """The rows of ``docs`` that near-dedup keeps: of each component the one
    with the smallest key (of repeated rows of that key and fingerprint one,
    the least by a hash of the row).  Null keys count as largest.

    Rows whose fingerprint is alone need no lookup.  The other fingerprints are
    broadcast while they are at most ``broadcast_rows`` (three numbers each),
    else joined by a shuffle."""
    kept = docs.columns
    fp, other, low, copies = "_simhash_fp", "_simhash_other", "_simhash_low", "_simhash_copies"
    rows = stage(add_fingerprint(docs, text, fp, shingle, seed), "with-fingerprints")
    all_fps = grouped(rows.select(F.col(f"`{key}`"), F.col(fp).alias("fp")), key, max_bits)
    some = stage(all_fps.where("linked or rows > 1").select(F.col("fp").alias(other), F.col("low").alias(low), F.when(F.col("fp") == F.col("best"), F.col("copies")).otherwise(F.lit(0)).alias(copies)), "crowded")
    if some.count() <= broadcast_rows:
        judged = rows.join(F.broadcast(some), F.col(fp) == F.col(other), "left")
    else:      # copies of one text are dealt over salts
        salt, salt_of = "_simhash_salt", "_simhash_salt_of"
        side = some.withColumn(salt_of, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn(salt, F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(SALTS)).cast("int"))
        judged = rows.join(side, (F.col(fp) == F.col(other)) & (F.col(salt) == F.col(salt_of)), "left")
    mine = judged.where(F.col(other).isNull() | ((F.col(copies) > 0) & F.col(f"`{key}`").eqNullSafe(F.col(low))))
    if some.where(F.col(copies) > 1).isEmpty():
        return mine.select(*[F.col(f"`{c}`") for c in kept])
    least = Window.partitionBy(F.col(f"`{key}`"), F.col(fp)).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in kept]))
    single = mine.where(F.coalesce(F.col(copies), F.lit(1)) == 1)
    several = mine.where(F.col(copies) > 1).withColumn("_simhash_row", F.row_number().over(least)).where("_simhash_row = 1")
    return single.select(*[F.col(f"`{c}`") for c in kept]).unionByName(several.select(*[F.col(f"`{c}`") for c in kept]))


def fingerprint_text(fp: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicate_documents(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of ``documents``."""
    return near_duplicates(docs).select("doc_id", fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")
