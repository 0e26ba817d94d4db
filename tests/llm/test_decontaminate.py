"""Operator 12 against a plain reading of its definition."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslake.llm import decontaminate as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    """[(doc_id, n_words, n_hit, item ids)]"""
    of = {}
    for name, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            of.setdefault(tuple(w[i:i + n]), set()).add(name)
    out = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for n in {len(k) for k in of}:
            for i in range(len(w) - n + 1):
                got = of.get(tuple(w[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    names |= got
        out.append((doc, len(w), len(hit), sorted(str(x) for x in names if x is not None)))
    return out


def as_rows(out):
    return sorted(((d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in out), key=repr)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_definition(spark, sf):
    docs, items = (spark.read.parquet(f"/root/testdata/sf{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = [tuple(r) for r in op.contaminated_documents(docs, items).collect()]
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert sorted(got, key=repr) == as_rows(want)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def hostile(seed, n_docs=60, n_items=14):
    """Texts of few words, so that windows overlap, repeat and are shared."""
    rng = random.Random(seed)
    vocabulary = ["A", "a", "bb", "é", "É", "日本", "x9", "9", "zzz"]
    between = [" ", "  ", "\n", ", ", "\x7f", "-", "\t\x00"]
    text = lambda n: rng.choice(["", " ", "."]) + "".join(rng.choice(vocabulary) + rng.choice(between) for _ in range(n))
    items = [(rng.choice([None, *range(9)]), rng.choice([None, "", "...", text(1), text(2), text(3), text(5), text(12)])) for _ in range(n_items)]
    docs = [(rng.choice([None, i, i // 2]), rng.choice([None, "", text(rng.randrange(0, 4)), text(rng.randrange(0, 200))])) for i in range(n_docs)]
    return docs + docs[:3], items + items[:2]


@pytest.mark.parametrize("seed", range(4))
def test_hostile_texts_in_one_set_and_in_blocks(spark, seed):
    docs, items = hostile(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_runs", F.lit("x")).withColumn("item_id", F.lit(1)).withColumn("n_hit", F.lit(None).cast("string"))
    i = spark.createDataFrame(items, "item_id long, text string")
    want = as_rows(brute(docs, items, 3))
    for size in (1 << 20, 40):
        got = op.scan(d, i, window=3, set_bytes=size)
        rows = [(r.doc.doc_id, r.n_words, r.n_hit, len(r.items), hashlib.sha256(",".join(r.items).encode()).hexdigest(), r.n_hit > 0) for r in got.collect()]
        assert sorted(rows, key=repr) == want
        for r in got.collect():
            raw = (r.doc.text or "").encode()
            inside = [w for b in r.bytes for w in words(raw[b["first"]:b["after"]].decode())]
            assert len(inside) == r.n_hit and len(r.bytes) == len(r.runs)


def test_empty_tables_and_no_items(spark):
    d = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[1:4] for r in op.contaminated_documents(d, none).orderBy("doc_id").collect()] == [(3, 0, 0), (0, 0, 0)]
    assert op.contaminated_documents(d.limit(0), none).collect() == []
    assert op.contaminated_documents(d.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []


def test_a_very_long_text_is_scanned_whole(spark):
    tail = " ".join(f"t{k}" for k in range(10))
    d = spark.createDataFrame([(1, "wort " * 400_000 + tail), (2, "w" * 3_000_000 + " " + tail)], "doc_id long, text string")
    i = spark.createDataFrame([(7, tail)], "item_id long, text string")
    assert [(r.doc_id, r.n_words, r.n_hit) for r in op.contaminated_documents(d, i).orderBy("doc_id").collect()] == [(1, 400_010, 10), (2, 11, 10)]


def test_removal_of_spans_and_documents(spark):
    d = spark.createDataFrame([(1, "Keep this. The Secret, answer is  forty-two! And that.", 1), (2, "clean  text ", 2), (3, None, 3), (4, "the secret answer is forty two", 4), (5, "é the secret answer is forty two the secret answer is forty two 日", 5)], "id long, body string, bytes int")
    i = spark.createDataFrame([("q", "the secret answer is forty two")], "item_id string, text string")
    cut = {r.id: (r.body, r.bytes) for r in op.decontaminate(d, i, "body").collect()}
    assert cut == {1: ("Keep this. ! And that.", 1), 2: ("clean  text ", 2), 3: (None, 3), 4: ("", 4), 5: ("é 日", 5)}
    assert {r.id for r in op.decontaminate(d, i, "body", max_share=0.6).collect()} == {1, 2, 3}
    assert {r.id for r in op.decontaminate(d, i, "body", remove="documents").collect()} == {2, 3}
    with pytest.raises(ValueError):
        op.decontaminate(d, i, "body", remove="rows")


def test_equal_hashes_are_told_apart():
    """Verification, not the hash, decides."""
    data = b"alpha beta gamma"
    windows = op.WindowSet([("1", data)], 3)
    hashes, *rest = windows.lengths[3]
    other = np.frombuffer(b"delta beta gamma", np.uint8)
    x = op.window_hashes(op.words_of(other, np.array([0, len(other)]))[2], 3)
    seen, shift = rest[3], rest[4]
    seen[x >> shift] = True
    windows.lengths[3] = (x, *rest)
    assert list(windows.scan(other, np.array([0, len(other)]), {})) == [(3, [], [], set())]
