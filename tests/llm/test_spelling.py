"""Operator 11 against a plain reading of its definition."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslake.llm import spelling as op

LOWER = str.maketrans(op._UPPER, op._LOWER)


def brute_words(docs, min_length=7):
    n = Counter()
    for k, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= min_length and c >= 2}


def brute_near(words):
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1:]].add(w)
    near = defaultdict(set)
    for (a, b), of in holes.items():
        for w in of:
            near[w] |= of - {w}
        if a + b in words:
            near[a + b] |= of
            for w in of:
                near[w].add(a + b)
    return near


def brute(n):
    near, form = brute_near(n), {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_definition(spark, sf):
    df = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    got = rows_of(op.document_variants(df))
    want = brute(brute_words([tuple(r) for r in df.select("doc_id", "text").collect()]))
    assert got == want
    assert any(r[1] for r in got) or sf == "0.001"


def random_words(seed, letters, lengths, size):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.choice(lengths))): rng.choice([2, 3, 19, 20, 200, 2000, 30000]) for _ in range(size)}


@pytest.mark.parametrize("letters,lengths,size", [("ab", (7, 8, 9), 900), ("abé", (7, 8), 3000), ("abcdefgÿàß", (3, 4, 5), 4000), ("aé", (300, 301), 50)])
@pytest.mark.parametrize("cell", [40, 2048])
def test_random_words(spark, letters, lengths, size, cell):
    n = random_words(size, letters, lengths, size)
    if lengths[0] == 300:            # counts beyond 255, words of all but one letter
        n = {"a" * k: 5 for k in (300, 301, 302)} | {"a" * i + "é" + "a" * (300 - i): 50 for i in range(0, 300, 7)} | {"a" * 150 + "é" * 150: 9, "a" * 149 + "é" * 151: 90}
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(4)
    assert rows_of(op.variants(df, cell=cell)) == brute(n)


def test_chains_of_forms(spark):
    n = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000, "aabbbbb": 200000}
    got = {r.word: r.root for r in op.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"aabbbbb"}


def test_reach_keeps_every_edit():
    """Every single edit stays in reach of folded, clipped vectors."""
    rng = random.Random(5)
    letters = [*map(chr, range(97, 123)), *map(chr, range(0xC0, 0x100))]
    for _ in range(300):
        w = [rng.choice(letters) for _ in range(rng.choice([7, 9, 600]))] if rng.random() < 0.8 else ["a"] * 600
        same, longer = list(w), list(w)
        same[rng.randrange(len(w))] = rng.choice(letters)
        longer.insert(rng.randrange(len(w) + 1), rng.choice(letters))
        v = [op.vectors(op.matrix(["".join(x)], len(x))) for x in (w, same, longer)]
        assert op.in_reach(v[0], v[1], v[1], False)[0] and op.in_reach(v[0], v[2], v[2], True)[0]
    assert not op.in_reach(v[0], v[0] + np.eye(1, op.DIMS, dtype=np.uint8) * 2, v[0] + np.eye(1, op.DIMS, dtype=np.uint8) * 2, False)[0] or v[0][0, 0] > 253


def test_document_edge_cases(spark):
    long = "Überlänge" * 4000
    docs = [(1, None), (2, ""), (None, "Kapitelle kapitelle KAPITELLE"), (3, f"{long} {long}"), (3, f"{long} {long}"), (4, "Ärzteblatt-ärzteblatt Ärzteblatt"), (5, "sechs6sechs öäüßéèà×÷ öäüßéèà×÷ Öäüßéèà×÷"), (6, "kapitelle " * 50 + "kapitele kapitele")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("x")).withColumn("r", F.lit(None).cast("string"))
    assert rows_of(op.document_variants(df)) == brute(brute_words(docs))
    assert op.document_variants(df.limit(0)).collect() == []
