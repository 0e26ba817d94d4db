"""Operator 2 against brute force: fingerprints, links, components, what stays."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from presslake.llm import simhash
from presslake.llm.common import blocks, utf8

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def component_ids(fps, bits=2):
    """Smallest reachable number of each fingerprint's position group."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("block", [300, 1 << 20])
def test_fingerprints(block):
    rng = random.Random(2)
    texts = ["", "a", "\n\n", " x", "É y\n", "A b c D", "word " * 50] + ["".join(rng.choice(["a", "B", " ", " ", "\n", "é", "\t", "\x0b", "　"]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    data, off = utf8(pa.array(texts, pa.string()))
    got = np.concatenate([simhash.fingerprints(data[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in blocks(off, block)])
    assert got.tolist() == [fingerprint(t) for t in texts]


def test_spark_hash_agrees(spark):
    """The shingle hash is Spark's own xxhash64 of the same text."""
    row = spark.range(1).select(F.xxhash64(F.lit("a b cé")).alias("h")).first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest("a b cé".encode(), 42)


def chained(rng, centres, each):
    out = set()
    for _ in range(centres):
        x = rng.getrandbits(64)
        for _ in range(each):
            out.add(x)
            x ^= 1 << rng.randrange(64)
            if rng.random() < 0.6:
                x ^= 1 << rng.randrange(64)
    return sorted(out)


@pytest.mark.parametrize("group", [2, 48])
def test_links_and_components(spark, group):
    """Near fingerprints in paired groups and, with a small limit, in groups
    that meet at the fingerprints next to them, give the same components."""
    rng = random.Random(3)
    fps = sorted({*chained(rng, 6, 25), *(rng.getrandbits(64) for _ in range(150)), 0, 1, 3, (1 << 64) - 1})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), group=group)
    assert all((r.a % (1 << 64) ^ r.b % (1 << 64)).bit_count() <= 2 and r.a < r.b for r in edges.collect())
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    want = component_ids(fps)
    groups = defaultdict(set)
    for x, c in zip(signed, want):
        groups[c].add(x)
    for members in groups.values():
        if len(members) > 1:
            assert {got[m] for m in members} == {min(members)}
        else:
            assert not members & set(got)


def test_long_chain_settles(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    assert {(r.node, r.root) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(n + 1)}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    fps = [fingerprint(t) for _, t in rows]
    want = {i: (f"{f:016x}", rows[c][0]) for (i, _), f, c in zip(rows, fps, component_ids(fps))}
    got = simhash.near_duplicate_documents(docs).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want and len(got) == len(rows)


EDGE = [(5, "one two three four five"), (2, "one two three four five"), (9, None), (8, ""), (7, " \n"), (None, "one two three four five"),
        (3, "completely other words here"), (3, "completely other words here"), (None, "nobody has an id"), (None, "nobody has an id"),
        (6, "x " * 100_000), (3, "the same id but other words entirely so")]


def test_edge_cases(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA).withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(0))
    got = simhash.near_duplicate_documents(docs).collect()
    assert len(got) == len(EDGE)
    ids = {(r.doc_id, r.component_id) for r in got}
    assert {(5, 2), (2, 2), (None, 2), (9, 7), (8, 7), (7, 7), (3, 3), (None, None), (6, 6)} <= ids
    assert {r.fingerprint for r in got if r.component_id == 7} == {"0" * 16}


def test_keep_one(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA).withColumn("component_id", F.lit("k")).withColumn("_f", F.lit(1)).withColumn("low", F.lit(2))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == sorted([
        (2, EDGE[1][1]), (7, " \n"), (3, EDGE[6][1]), (-1, EDGE[8][1]), (6, EDGE[10][1]), (3, EDGE[11][1])])
    shuffled = simhash.keep_one(docs, broadcast_rows=0)
    assert sorted(map(repr, shuffled.collect())) == sorted(map(repr, kept.collect()))


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicate_documents(none).collect() == [] and simhash.keep_one(none).collect() == []
