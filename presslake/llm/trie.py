"""Operator 13, conversation prefix trie: splitter skeleton and sorted shards.

A conversation is one record: its path (16 bytes of MD5 per turn, over role
and text) and the turns' lengths; the texts themselves never travel.  Bytes of
paths order like the sequences of turns, so a node's members are neighbours
when records are sorted by (path, conversation).

Sampled records split that order into shards.  The prefixes of the splitters'
paths, the skeleton, are the only nodes that can lie in several shards: each
shard finishes all its other nodes in one pass over its sorted records, with a
stack as deep as one path, and emits partial aggregates for its skeleton nodes.
These are combined by a ``groupBy``; the skeleton's totals are summed up its
tree, which has at most shards x SKELETON_DEPTH nodes, and given to the nodes
right below it.  Splitters hold the conversation, so copies of one path are
split among shards as well.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import bounded_broadcast, importable, stage, worker_store

STEP = 16               #: bytes of a path per turn
SAMPLE = 20             #: sampled records per shard
SKELETON_DEPTH = 512    #: turns of a splitter's path that are kept, at most
SKELETON_NODES = 200_000    #: bound on the skeleton, by fewer turns per splitter
CHUNK = 1 << 16         #: characters of a list of ending conversations per row
SPREAD = 100            #: a block of so many ids shares its first conversation's start
STARTS = 6              #: starts have fewer turns than this


def conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id and its ``turns`` in order, as structs
    of digest (hexadecimal) and n (code points of the text).

    Turns are ordered by ``turn``, null first; equal ones by their digest.  A
    null role or text is empty.  Rows without a conversation belong to none and
    are left out; repeated rows are repeated turns."""
    r, t = F.coalesce(F.col(f"`{role}`"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = F.md5(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t))
    rows = turns.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"), F.struct(F.col(f"`{turn}`").alias("turn"), digest.alias("digest"), F.char_length(t).alias("n")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda x: F.struct(x["digest"].alias("digest"), x["n"].alias("n"))).alias("turns"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversations that share starts: the first h turns of the block's first
    conversation (id - id % SPREAD; all if it has fewer, none if it is absent),
    then the conversation's own after its first h; h is the unsigned CRC-32 of
    the decimal id, modulo STARTS."""
    convs = stage(convs, "conversations")
    starts = convs.where(F.col("conv_id") % SPREAD == 0).select(F.col("conv_id").alias("first_id"), F.slice("turns", 1, STARTS - 1).alias("start"))
    own = convs.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % STARTS).cast("int")).withColumn("of", F.col("conv_id") - F.col("conv_id") % SPREAD)
    both = own.join(starts, F.col("of") == F.col("first_id"), "left")
    start = F.when(F.col("start").isNull() | (F.col("h") == 0), F.slice("turns", 1, 0)).otherwise(F.expr("slice(start, 1, greatest(h, 1))"))
    rest = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    return both.select("conv_id", F.concat(start, rest).alias("turns"))


def as_paths(convs: DataFrame) -> DataFrame:
    """conv_id, path (16 bytes a turn) and lens (code points per turn)."""
    return convs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda x: x["digest"]), "")).alias("path"),
                        F.transform("turns", lambda x: x["n"]).alias("lens"))


def splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards`` - 1 places (path, conversation) that split the sorted
    records evenly, from a sample of about SAMPLE records a shard."""
    rows = paths.count()
    depth = max(16, min(SKELETON_DEPTH, SKELETON_NODES // max(shards, 1)))
    some = paths if rows <= SAMPLE * shards else paths.sample(min(1.0, SAMPLE * shards / rows), seed=11)
    got = sorted((bytes(r[0]), r[1]) for r in some.select(F.substring("path", 1, depth * STEP), "conv_id").collect())
    return sorted({got[len(got) * k // shards] for k in range(1, shards)}) if got else []


def common_turns(a: bytes, b: bytes | None) -> int:
    """How many leading turns two paths share."""
    if b is None:
        return 0
    n = min(len(a), len(b)) // STEP * STEP
    if a[:n] == b[:n]:
        return n // STEP
    lo, hi = 0, n // STEP        # a and b share lo turns, not hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[:mid * STEP] == b[:mid * STEP]:
            lo = mid
        else:
            hi = mid
    return lo


class _Node:
    __slots__ = ("children", "convs", "ends", "first", "key", "leaves", "length", "saved", "waiting")

    def __init__(self, length: int, key: bytes | None):
        self.convs = self.children = self.leaves = self.saved = 0
        self.first, self.length, self.key = None, length, key
        self.ends = [] if key is not None else None
        self.waiting: list = []


_EMPTY = hashlib.sha256(b"").hexdigest()
#: Rows of a shard.  kind 0: a node below a node of the same shard; 1: a node
#: right below the skeleton (parent: that node); 2: a skeleton node's partial
#: aggregates; 3: conversations that end at a skeleton node, in order.
_ROWS = ("kind byte, node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, last_len long, ends string")


class Shard:
    """One pass over the records of a shard, sorted by (path, conversation)."""

    def __init__(self, low: bytes | None, high: bytes | None):
        self.low, self.high, self.stack, self.path, self.out = low, high, [_Node(0, b"")], b"", []

    def add(self, conv: int, path: bytes, lens) -> None:
        same = min(common_turns(path, self.path), len(self.stack) - 1)
        while len(self.stack) - 1 > same:
            self.close()
        depth = len(path) // STEP
        if depth > same:
            shared = max(common_turns(path, self.low), common_turns(path, self.high))
            for d in range(same + 1, depth + 1):
                key = hashlib.md5(self.stack[-1].key + path[(d - 1) * STEP:d * STEP]).digest() if d <= shared else None
                self.stack.append(_Node(lens[d - 1], key))
        self.path = path
        top = self.stack[-1]         # the nodes above learn of it when this one closes
        top.convs += 1
        top.first = conv if top.first is None else min(top.first, conv)
        if top.key is not None:
            top.ends.append(conv)
        else:
            if top.ends is None:
                top.ends = hashlib.sha256(str(conv).encode())
            else:
                top.ends.update(f",{conv}".encode())

    def close(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        above = self.stack[-1] if self.stack else None
        if above is not None:
            above.convs += node.convs
            above.first = node.first if above.first is None else min(above.first, node.first)
        if node.key is not None:
            self.out.append((2, node.key, above.key if above else None, depth, node.first, None, node.convs, node.children, node.leaves, node.saved, node.length, None))
            line, first = [], None
            for c in node.ends:
                first = c if first is None else first
                line.append(str(c))
                if len(line) * 20 >= CHUNK:
                    self.out.append((3, node.key, None, None, first, None, None, None, None, None, None, ",".join(line)))
                    line, first = [], None
            if line:
                self.out.append((3, node.key, None, None, first, None, None, None, None, None, None, ",".join(line)))
            return
        node.leaves += not node.children
        node.saved += (node.convs - 1) * node.length
        above.children += 1
        above.leaves += node.leaves
        above.saved += node.saved
        ends = _EMPTY if node.ends is None else node.ends.hexdigest()
        self.out.extend((0, None, None, *row, node.first, *rest) for (row, rest) in ((w[:2], w[2:]) for w in node.waiting))
        row = (depth, node.first, node.convs, node.children, node.leaves, node.saved, None, ends)
        if above.key is not None:
            self.out.append((1, None, above.key, depth, node.first, None, *row[2:]))
        else:
            above.waiting.append(row)

    def finish(self) -> list:
        while self.stack:
            self.close()
        return self.out


def _finish_shards(paths: DataFrame, cuts: list[tuple[bytes, int]]) -> DataFrame:
    """The rows (_ROWS) of all shards."""
    spark = paths.sparkSession
    importable(spark)
    sent = spark.sparkContext.broadcast(cuts)      # at most SKELETON_NODES turns

    def deal(batches):
        import pyarrow as pa
        for b in batches:
            path, conv = b.column("path").to_pylist(), b.column("conv_id").to_pylist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([bisect_right(sent.value, x) for x in zip(path, conv, strict=True)], pa.int32())], names=[*b.schema.names, "shard"])

    def run(batches):
        import pyarrow as pa
        types = {"byte": pa.int8(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
        schema = pa.schema([(name, types[kind]) for name, kind in (x.split() for x in _ROWS.split(", "))])
        worker_store("trie")
        at, now, old = None, None, None

        def flush(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            for shard, conv, path, lens in zip(*(b.column(c).to_pylist() for c in ("shard", "conv_id", "path", "lens")), strict=True):
                if shard != at:
                    old = now
                    at, now = shard, Shard(sent.value[shard - 1][0] if shard else None, sent.value[shard][0] if shard < len(sent.value) else None)
                    if old is not None:
                        yield flush(old.finish())
                now.add(conv, path, lens)
                if len(now.out) >= 10_000:
                    yield flush(now.out)
                    now.out = []
        if now is not None:
            yield flush(now.finish())

    dealt = paths.mapInArrow(deal, "conv_id long, path binary, lens array<int>, shard int")
    return dealt.repartitionById(len(cuts) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(run, _ROWS)


def _skeleton_ends(rows: DataFrame) -> DataFrame:
    """node and the SHA-256 of its ending conversations: the lists that shards
    made of them, hashed in order, a row at a time."""
    def run(batches):
        import pyarrow as pa
        node, sha = None, None
        for b in batches:
            done = []
            for k, text in zip(b.column("node").to_pylist(), b.column("ends").to_pylist(), strict=True):
                if k != node:
                    if node is not None:
                        done.append((node, sha.hexdigest()))
                    node, sha = k, hashlib.sha256(text.encode())
                else:
                    sha.update(("," + text).encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done])], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], names=["node", "ends_sha256"])

    ends = rows.where("kind = 3").select("node", "conv_id", "ends")
    return ends.repartition(F.col("node")).sortWithinPartitions("node", "conv_id").select("node", "ends").mapInArrow(run, "node binary, ends_sha256 string")


_SKELETON = "node binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _skeleton(rows: DataFrame) -> DataFrame:
    """The skeleton's nodes: shards' partial aggregates combined by node, then
    summed from the deepest nodes up (at most SKELETON_NODES, and the root)."""
    parts = rows.where("kind = 2").groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"), F.first("last_len").alias("last_len"))
    nodes = {bytes(r["node"]): {**r.asDict(), "parent": None if r["parent"] is None else bytes(r["parent"])} for r in parts.collect()}
    for r in sorted(nodes.values(), key=lambda r: -r["depth"]):
        r["n_leaves"] += not r["n_children"]
        r["saved"] += (r["n_convs"] - 1) * r["last_len"]
        if r["parent"] is not None:
            up = nodes[r["parent"]]
            up["n_children"] += 1
            up["n_leaves"] += r["n_leaves"]
            up["saved"] += r["saved"]
    out = [(k, r["depth"], r["conv_id"], nodes[r["parent"]]["conv_id"] if r["parent"] is not None else None, r["n_convs"], r["n_children"], r["n_leaves"], r["saved"]) for k, r in nodes.items()]
    return stage(rows.sparkSession.createDataFrame(out, _SKELETON), "skeleton")


def trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per distinct prefix of the paths of ``paths`` (conv_id, path,
    lens; conv_id is unique): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    A conversation without turns is a member of the root alone; without
    conversations there is no node.  ``shards``: as many as shuffle partitions,
    if not given.  A path must fit a task (16 bytes a turn)."""
    spark = paths.sparkSession
    paths = stage(paths, "paths")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stage(_finish_shards(paths, splitters(paths, shards)), "trie-rows")
    top = _skeleton(rows)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    ends = _skeleton_ends(rows)
    shared = top.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
    inner = rows.where("kind = 0").withColumn("ends_sha256", F.col("ends"))
    above = bounded_broadcast(top.select(F.col("node").alias("up"), F.col("conv_id").alias("up_conv")), SKELETON_NODES)
    below = rows.where("kind = 1").join(above, F.col("parent") == F.col("up")).withColumn("parent_conv_id", F.col("up_conv")).withColumn("ends_sha256", F.col("ends"))
    return inner.select(*names).unionByName(below.select(*names)).unionByName(shared.select(*names))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns``."""
    return trie(as_paths(rebuilt(conversations(turns))))
