"""Operator 13 against a plain reading of its definition."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from presslake.llm import trie as op


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def rebuilt(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            by[conv].append(((turn is not None, turn or 0), digest(role, text), role, text))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in by.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = tuple(list(own.get(first, []))[:h] + turns[h:])
    return out


def brute(rows):
    convs = rebuilt(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in sorted(convs.items()):
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    below = defaultdict(list)
    for p in members:
        if p:
            below[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in below[p]) if below[p] else 1
        saved[p] = sum(saved[q] for q in below[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(below[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
                  for p, m in members.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_definition(spark, sf):
    df = spark.read.parquet(f"/root/testdata/sf{sf}/conversations.parquet")
    assert rows_of(op.conversation_trie(df)) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def hostile(seed):
    """Few different turns, so that paths are shared, nested and repeated."""
    rng = random.Random(seed)
    ids = [*range(0, 40), *range(100, 130), *range(-5, 0), 250, 299, 10**12, 10**12 + 1]
    rows = []
    for c in ids:
        same = rng.random() < 0.4
        for turn in range(rng.choice([1, 2, 3, 7, 12])):
            rows.append((c, None if rng.random() < 0.05 else turn, rng.choice(["user", None, ""]) if not same else "user", rng.choice(["a", "bé日", None, ""]) if not same else f"x{turn}"))
    rows += rows[:5]
    rows += [(None, 1, "user", "no conversation")]
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("shards", [1, 3, 40])
def test_hostile_conversations(spark, seed, shards):
    rows = hostile(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = op.trie(op.as_paths(op.rebuilt(op.conversations(df))), shards)
    assert rows_of(got) == brute(rows)


def test_copies_of_one_path_are_split_among_shards(spark):
    paths = spark.range(500).select(F.col("id").alias("conv_id"), F.unhex(F.repeat(F.lit("ab"), 32)).alias("path"), F.array(F.lit(3), F.lit(4)).alias("lens"))
    cuts = op.splitters(paths, 8)
    assert len(cuts) == 7 and len({p for p, _ in cuts}) == 1
    got = rows_of(op.trie(paths, 8))
    ids = hashlib.sha256(",".join(str(i) for i in range(500)).encode()).hexdigest()
    none = hashlib.sha256(b"").hexdigest()
    assert got == [(0, 0, None, 500, 1, 1, 499 * 7, none), (0, 1, 0, 500, 1, 1, 499 * 7, none), (0, 2, 0, 500, 0, 1, 499 * 4, ids)]


def test_long_conversations_and_chunks_of_ends(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK", 60)
    rows = [(c, t, "user", f"t{t}") for c in (5, 6, 7) for t in range(3000)] + [(c, 0, "user", "z") for c in range(1000, 1100)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert rows_of(op.trie(op.as_paths(op.rebuilt(op.conversations(df))), 4)) == brute(rows)


def test_edge_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert op.conversation_trie(spark.createDataFrame([], schema)).collect() == []
    # A turnless conversation: 1's first turns come from 0, which is absent.
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 1)
    none = hashlib.sha256(str(c).encode()).hexdigest()
    assert rows_of(op.conversation_trie(spark.createDataFrame([(c, 0, "user", "gone")], schema))) == [(c, 0, None, 1, 0, 1, 0, none)]
    clash = spark.createDataFrame([(200, 1, "u", "x")], schema).withColumn("path", F.lit(1)).withColumn("of", F.lit("y")).withColumn("h", F.lit(None).cast("string"))
    assert len(op.conversation_trie(clash).collect()) == 2
