"""Operator 8 and the pipeline against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from presslake.llm import langid, packing, quality
from presslake.llm.common import blocks, utf8
from presslake.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), sum(a == b for a, b in zip(words, words[1:]))]


@pytest.mark.parametrize("segment", [40, 5000, 1 << 21])
def test_statistics(monkeypatch, segment):
    monkeypatch.setattr(quality, "SEGMENT", segment)
    monkeypatch.setattr(quality, "_POWERS", [])
    rng = random.Random(8)
    texts = ["", "a", "\n\n", " x", "é y\n", "a b c d e f g h " * 3, "l\nl\n l\nl", "long" * 50 + " " + "long" * 50]
    texts += ["".join(rng.choice(["a", "b", " ", " ", "\n", "é", "#", "\t", "\x0b", "　", "x y z w v u t s ", "\nq r\n"]) for _ in range(rng.randint(0, 90))) for _ in range(300)]
    data, off = utf8(pa.array(texts, pa.string()))
    got = np.concatenate([quality.text_statistics(data[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in blocks(off, segment)])
    assert got.tolist() == [counts(t) for t in texts]


def vector(n):
    w = max(n[0], 1)
    raw = (n[1] / w, *(math.sqrt(n[k] / w) for k in (2, 3, 4, 5)))
    return [math.floor(x * 1024 + 0.5) for x in raw]


GRAIN = np.array(quality.GRAIN)
SURE = np.diag(GRAIN / quality.SURE)


def starts(v):
    """(centre, scatter) of the three first estimates, in numpy."""
    p = v.shape[1]

    def middle(x):
        x = np.sort(np.floor(x / 16))
        return x[(len(x) - 1) // 2] / 64

    m = np.array([middle(v[:, k]) for k in range(p)])
    d = np.array([middle(np.abs(v[:, k] - m[k] * 1024)) for k in range(p)])
    w = np.sqrt((1.4826 * d) ** 2 + np.diag(SURE))
    z = (v / 1024 - m) / w
    signs = z / np.sqrt((z * z).sum(1, keepdims=True) + 1e-12)
    yield m, np.diag(w * w)
    for x in (np.tanh(z), signs):
        x = np.sign(x) * np.floor(np.abs(x) * 1024 + 0.5)
        s = np.sqrt(np.maximum((x * x).sum(0), 1))
        r = 0.95 * (x.T @ x) / np.outer(s, s)
        np.fill_diagonal(r, 1)
        yield m, r * np.outer(w, w)


def concentrated(v, m, scatter):
    """(centre, covariance, scatter) of the half that is closest."""
    x = v / 1024 - m
    bins = np.floor(np.log2(np.einsum("ni,ij,nj->n", x, np.linalg.inv(scatter), x) + 1e-9) * quality.BINS)
    half = v[bins <= np.sort(bins)[(len(bins) - 1) // 2]] / 1024
    m = half.mean(axis=0)
    cov = (half - m).T @ (half - m) / len(half)
    return m, cov, cov + SURE


def estimates(groups):
    """{group: (centre, covariance)} of {group: vectors} by the same steps."""
    det = lambda f: np.linalg.slogdet(f[2])[1]
    groups = {g: np.array(v, float) for g, v in groups.items()}
    fits = {}
    for g, v in groups.items():
        tried = []
        for m, scatter in starts(v):
            for _ in range(quality.TRIALS):
                m, cov, scatter = concentrated(v, m, scatter)
            tried.append((m, cov, scatter))
        fits[g] = min(tried, key=det)
        for _ in range(quality.STEPS):
            before, fits[g] = det(fits[g]), concentrated(v, *fits[g][::2])
            if before - det(fits[g]) <= quality.SETTLED:
                break
    return {g: (m, cov * quality.HALF_FACTOR) for g, (m, cov, _) in fits.items()}


def judged(rows):
    """{doc_id: (base_failed, distance, kept)} by brute force."""
    n = {i: counts(t) for i, t, _, _ in rows}
    failed = {i: c[0] < 20 or 100 * c[4] > 30 * c[0] for i, c in n.items()}
    own = defaultdict(list)
    for i, _, lang, source in rows:
        if not failed[i]:
            own[lang, source].append(i)
    pools = defaultdict(list)
    for g, ids in own.items():
        if len(ids) < quality.MIN_GROUP:
            pools[g[0]] += ids
    groups = {g: ids for g, ids in own.items() if len(ids) >= quality.MIN_GROUP}
    rest = []
    for lang, ids in pools.items():
        if len(ids) >= quality.MIN_GROUP:
            groups[lang, "*"] = ids
        else:
            rest += ids
    if len(rest) >= quality.MIN_GROUP:
        groups["*"] = rest
    fits = estimates({g: [vector(n[i]) for i in ids] for g, ids in groups.items()})
    out = {}
    for i, _, lang, source in rows:
        g = (lang, source) if (lang, source) in groups else (lang, "*") if (lang, "*") in groups else "*" if (lang, source) in own else None
        dist = None
        if g in fits:
            m, cov = fits[g]
            x = (np.array(vector(n[i])) / 1024 - m) * np.sqrt((np.diag(cov) + np.diag(SURE)) / (np.diag(cov) + GRAIN / np.minimum(max(n[i][0], 1), quality.SURE)))
            dist = math.sqrt(max(0.0, x @ np.linalg.inv(cov + SURE) @ x))
        out[i] = failed[i], dist, not failed[i] and not (dist is not None and dist > quality.CUTOFF)
    return out


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_query(spark, monkeypatch, broadcast):
    monkeypatch.setattr(quality, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(quality, "MIN_GROUP", 30)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    got = {r.doc_id: r for r in quality.judge_documents(docs).collect()}
    want = judged([tuple(r) for r in docs.collect()])
    assert len(got) == len(want) == docs.count()
    for i, (failed, dist, kept) in want.items():
        r = got[i]
        assert [r[c] for c in quality.STATS] == counts(docs_text(docs)[i]) and r.base_failed == failed
        assert (dist is None) == (r.distance is None) and (dist is None or r.distance == pytest.approx(dist, rel=1e-6, abs=1e-6))
        assert r.kept == kept


_TEXTS = {}


def docs_text(docs):
    if not _TEXTS:
        _TEXTS.update((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    return _TEXTS


def test_labels(spark):
    """Clean labelled documents stay, junk goes."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality.judge_documents(docs).join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in got}
    assert kept[1] > 0.999 and kept[0] < 0.1


EDGE = [(1, None, "en", "a", 0), (2, "", None, None, 0), (None, "word and word, " * 5, None, "b", 1), (3, "one two " * 12, "en", None, 1), (3, "one two " * 12, "en", None, 1),
        (4, " ".join(f"w{i}" for i in range(60_000)), "fr", "a", 2), (5, "x" * 400_000, "fr", "a", 2), (6, "\n" * 1000, "fr", "a", 2)]


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA).withColumn("g", F.lit(1)).withColumn("m0", F.lit("x")).withColumn("n_words", F.lit(7)).withColumn("label", F.lit(2))
    got = quality.judge_documents(docs).collect()
    assert len(got) == len(EDGE)
    by = {r.doc_id: r for r in got}
    assert {i for i, r in by.items() if r.base_failed} == {1, 2, None, 3, 5, 6}
    assert by[4].n_words == 60_000 and by[1].n_words == 0 and by[None].n_words == 15
    assert quality.judge_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def fingerprint_groups(rows):
    from test_simhash import component_ids, fingerprint
    return component_ids([fingerprint(t) for t in rows])


def test_pipeline_equals_brute_force(spark, monkeypatch):
    """Each stage's decisions, made again by plain code on what it was given."""
    from test_packing import verify
    monkeypatch.setattr(quality, "MIN_GROUP", 30)
    from presslake.llm.common import stage
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("kept", F.lit("x")).withColumn("g", F.col("doc_id") * 2).withColumn("_doc", F.lit(0)).withColumn("n_words", F.lit(-1))
    given = {}
    for name, step in corpus_pipeline.STAGES:
        given[name] = docs
        out = stage(step(spark, docs, SF), name)
        if name != "packing":
            assert out.columns == docs.columns
            assert out.exceptAll(docs).isEmpty()
        docs = out
    ids = {name: sorted((r.doc_id, r.text, r.lang, r.source) for r in df.collect()) for name, df in given.items()}
    # Language: rejected are texts without letters, or far from all profiles.
    found = {r.doc_id: r for r in langid.identify_documents(given["language"]).collect()}
    assert [x for x in ids["language"] if found[x[0]].lang_pred != "und" and found[x[0]].score >= corpus_pipeline.MIN_LANGUAGE_SCORE] == ids["quality"]
    want = judged(ids["quality"])
    assert [x for x in ids["quality"] if want[x[0]][2]] == ids["near_duplicates"]
    groups = fingerprint_groups([x[1] for x in ids["near_duplicates"]])
    assert [x for k, x in enumerate(ids["near_duplicates"]) if groups[k] == k] == ids["packing"]
    from tokenizers import Tokenizer
    verify(docs.collect(), [x[:2] for x in ids["packing"]], Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")))


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert set(rows.columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    assert 0 < rows.select("doc_id").distinct().count() <= 200


def test_stage_edge_cases(spark):
    rows = [*EDGE, (7, "123 456 " * 30, "en", "a", 1), (8, " ".join(f"word{i % 97}x{i}" for i in range(300)), "en", "a", 1), (8, " ".join(f"word{i % 97}x{i}" for i in range(300)), "en", "a", 1)]
    rows.append((10, " ".join(f"word{i}x{i}" for i in range(60_000)), "en", "a", 1))
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("text_crc32", F.lit("x"))
    kept = docs
    for name, step in corpus_pipeline.STAGES[:3]:
        kept = step(spark, kept, SF)
        assert kept.columns == docs.columns, name
    assert sorted(r.doc_id for r in kept.collect()) == [4, 8, 10]
    empty = docs.limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, SF).collect() == []
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in corpus_pipeline.identify_language(spark, unlabelled, SF).collect()} == {None, 3, 4, 5, 8, 10}


def test_cutoff_is_a_quantile():
    """CUTOFF and HALF_FACTOR by the chi-square law of odd dimensions."""
    def below(k, x):
        p, t = math.erf(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
        for j in range(1, k - 1, 2):
            p, t = p - t, t * x / (j + 2)
        return p

    k = len(quality.VECTOR)
    assert 1 - below(k, quality.CUTOFF ** 2) == pytest.approx(1e-6, rel=1e-4)
    lo, hi = 0.0, 50.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(k, mid) < 0.5 else (lo, mid)
    assert quality.HALF_FACTOR == pytest.approx(0.5 / below(k + 2, lo), rel=1e-4)


def test_each_statistic_rejects_alone(spark):
    """One text for each statistic, ordinary but for it; very short and very
    long ordinary texts, and ones with a little of everything, stay."""
    rng = random.Random(9)
    word = lambda: "abcdefgh"[rng.randrange(8)] * rng.randint(2, 7) + str(rng.randrange(1000))
    line = lambda n: " ".join(word() for _ in range(n))
    clean = lambda n: "\n".join(line(8) for _ in range(n))
    rows = [(i, clean(rng.randint(3, 90))) for i in range(400)]
    window = line(12)
    bad = {1000: " ".join(word() + "x" * 9 for _ in range(300)),
           1001: " ".join(word() + ("#" if i % 4 == 0 else "") for i in range(400)),
           1002: "\n".join([*(line(7) for _ in range(40)), *[word()] * 20]),
           1003: "\n".join(line(30) + " " + window for _ in range(20)),
           1004: " ".join(w for _ in range(200) for w in [word()] * rng.choice([1, 1, 1, 2]))}
    good = {2000: line(20), 2001: clean(5000), 2002: clean(40) + "\n" + window + "\n" + window + " A&B", 2003: line(24) + " $5 #1"}
    rows += [*bad.items(), *good.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string"))
    got = {r.doc_id: r for r in quality.judge_documents(docs.coalesce(2)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == set(bad)


def test_small_sources_are_judged(spark):
    """A source of 30 texts beside one of 300 of its language, one text of a
    language of its own, at the MIN_GROUP of production; one of the small
    source's texts, and the single one, are of long words and symbols."""
    rng = random.Random(5)
    clean = lambda: " ".join("abcdefgh"[rng.randrange(8)] * rng.randint(2, 7) + str(rng.randrange(10**6)) for _ in range(rng.randint(60, 90)))
    junk = lambda: " ".join(f"{'x' * 30}{rng.randrange(10**6)}#$%&" for _ in range(70))
    rows = [(i, clean(), "en", "big") for i in range(300)] + [(1000 + i, clean(), "en", "small") for i in range(29)]
    rows += [(2000, junk(), "en", "small"), (2001, junk(), "xx", "s"), (2002, clean(), "xx", "s")]
    got = {r.doc_id: r for r in quality.judge_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(2)).collect()}
    assert all(r.distance is not None for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == {2000, 2001}
