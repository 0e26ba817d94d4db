"""Operator 1: n-gram counting against a plain count, accuracy, edge cases."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from presslake.llm import langid

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string"


def plain(text):
    n = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        x = [1, *(ord(c) + 2 for c in word), 1]
        n.update((c, 0, 0) for c in x[1:-1])
        n.update((a, b, 0) for a, b in zip(x, x[1:]))
        n.update(zip(x, x[1:], x[2:]))
    return {a << 42 | b << 21 | c: k for (a, b, c), k in n.items()}


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_ngrams_equal_a_plain_count(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    rng = random.Random(1)
    texts = ["", "a", "  a b", "é1x", "漢字 b", "İI"] + ["".join(rng.choice("abc é1.漢\n") for _ in range(rng.randint(0, 60))) for _ in range(80)]
    doc, gram, n = langid.count_ngrams(texts)
    got = [{} for _ in texts]
    for d, g, k in zip(doc.tolist(), gram.tolist(), n.tolist()):
        got[d][g] = k
    assert got == [plain(t) for t in texts]


def test_wide_alphabets_split_the_batch():
    texts = ["".join(chr(c) for c in range(0x4E00 + i, 0x9000 + i)) for i in range(3)]
    doc, gram, n = langid.count_ngrams(texts)
    for i, t in enumerate(texts):
        assert dict(zip(gram[doc == i].tolist(), n[doc == i].tolist())) == plain(t)


def test_nearest_equals_out_of_place_by_definition():
    k = 5
    texts = ["abab ab", "zz zy", "..", "abz"]
    profiles = {"x": "ab ab abba", "y": "zzz zy zy"}
    ranked = {la: [g for g, _ in sorted(plain(t).items(), key=lambda p: (-p[1], p[0]))[:k]] for la, t in profiles.items()}
    langs = sorted(ranked)
    import numpy as np
    grams = np.unique([g for r in ranked.values() for g in r])
    ranks = np.array([[ranked[la].index(g) if g in ranked[la] else k for la in langs] for g in grams.tolist()])
    pred, score = langid.nearest(texts, langs, grams, ranks, k)
    for t, p, s in zip(texts, pred, score):
        own = [g for g, _ in sorted(plain(t).items(), key=lambda q: (-q[1], q[0]))[:k]]
        if not own:
            assert (p, s) == ("und", 0)
            continue
        d = {la: sum(abs(i - ranked[la].index(g)) if g in ranked[la] else k for i, g in enumerate(own)) for la in langs}
        best = min(langs, key=lambda la: (d[la], la))
        assert p == best and s == pytest.approx(1 - d[best] / (len(own) * k))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 150 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edge_cases(spark):
    rows = [(1, "the cat and the dog", "en"), (3, "le chat et le chien", "fr"), (4, None, "en"), (5, "", None), (6, "12 .. 3", "fr"),
            (None, "the dog", None), (7, "the dog", None), (7, "the dog", None), (8, "le chien " * 40_000, None), (9, "", "de")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(1))
    got = langid.identify_documents(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert all(by[i][0].lang_pred == "und" and by[i][0].score == 0 for i in (4, 5, 6, 9))
    assert by[8][0].lang_pred == "fr" and by[7][0] == by[7][1] and by[7][0].lang_pred == by[None][0].lang_pred == "en"
    assert by[None][0].held_out is False


def test_empty_and_unlabelled(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert langid.identify_documents(none).collect() == []
    got = langid.identify_documents(spark.createDataFrame([(1, "abc", None)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
