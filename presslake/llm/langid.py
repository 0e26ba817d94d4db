"""Operator 1, language ID: rank-order n-gram profiles.

A language's profile is its K most frequent character n-grams (one to three
characters, word by word, the word's edges counting as a character), ranked.
A document's own K most frequent n-grams are ranked likewise; its distance to a
language is the sum of how far each n-gram is out of place (K if the profile
lacks it), and the nearest language wins.

Learning counts n-grams inside tasks, sums them in Spark and keeps K per
language: the only thing that reaches the driver.  Prediction is one pass over
the texts without a shuffle.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.llm.common import importable, worker_store

PROFILE = 400         #: K, n-grams of a profile and of a document
TRAIN_DOCS = 20_000   #: about so many labelled documents per language are learned from
MAX_LANGS = 1_000     #: most languages that profiles may be learned for
BLOCK = 1 << 18       #: code points that are counted at once

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _runs(keys: np.ndarray, counts: np.ndarray | None = None):
    """Distinct keys in order, with how often each occurs (or its counts' sum)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    if counts is None:
        return keys[at], np.diff(np.append(at, len(keys)))
    return keys[at], np.add.reduceat(counts, at)


def count_ngrams(texts: list[str]):
    """All n-grams of texts: arrays (text's index, n-gram, count), ordered by
    index and n-gram.  An n-gram is a number of three 21-bit fields, one for
    each character: its code point + 2, 1 for a word's edge, 0 for none."""
    lowered = [t.lower() for t in texts]
    cp = _codes(" ".join(["", *lowered, ""]))
    # Texts stand between single blanks; a blank belongs to no text.
    doc = np.repeat(np.arange(len(texts) + 1), [1, *(len(t) + 1 for t in lowered)]) - 1
    letter = _letters()[cp]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]                      # of a run of other characters the first stays
    cp, doc, letter = cp[keep], doc[keep], letter[keep]
    present = np.unique(cp[letter])
    table = np.zeros(int(present[-1]) + 1 if len(present) else 1, np.int64)
    table[present] = np.arange(2, len(present) + 2)
    x = np.ones(len(cp), np.int64)
    x[letter] = table[cp[letter]]
    bits = int(len(present) + 1).bit_length()
    if len(texts) > 1 and 3 * bits + len(texts).bit_length() > 63:
        half = len(texts) // 2
        a, b = count_ngrams(texts[:half]), count_ngrams(texts[half:])
        return np.concatenate((a[0], b[0] + half)), np.concatenate((a[1], b[1])), np.concatenate((a[2], b[2]))
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for s in range(0, len(x), BLOCK):            # an n-gram belongs to the block in which it begins
        y, w, d = x[s:s + BLOCK + 2], letter[s:s + BLOCK + 2], doc[s:s + BLOCK + 2]
        n = min(BLOCK, len(x) - s)
        one = np.flatnonzero(w[:n])
        two = np.flatnonzero(w[:-1] | w[1:]) if len(y) > 1 else one[:0]
        two = two[two < n]
        three = np.flatnonzero(w[1:-1]) if len(y) > 2 else one[:0]
        three = three[three < n]
        got = np.concatenate((
            d[one] << 3 * bits | y[one] << 2 * bits,
            np.where(w[two], d[two], d[np.minimum(two + 1, len(d) - 1)]) << 3 * bits | y[two] << 2 * bits | y[two + 1] << bits if len(two) else one[:0],
            d[three + 1] << 3 * bits | y[three] << 2 * bits | y[three + 1] << bits | y[three + 2] if len(three) else one[:0]))
        k, c = _runs(got)
        keys, counts = (k, c) if not len(keys) else _runs(np.concatenate((keys, k)), np.concatenate((counts, c)))
    field = np.concatenate(([0, 1], present.astype(np.int64) + 2))
    mask = (1 << bits) - 1
    gram = field[keys >> 2 * bits & mask] << 42 | field[keys >> bits & mask] << 21 | field[keys & mask]
    return keys >> 3 * bits, gram, counts


def nearest(texts: list[str], langs: list[str], grams: np.ndarray, ranks: np.ndarray, k: int):
    """Predicted language and score (1 - distance / largest possible distance)
    of each text.  ``grams``: the profiles' n-grams in order; ``ranks``: their
    rank in each language, ``k`` where a profile lacks one."""
    pred, score = ["und"] * len(texts), np.zeros(len(texts))
    if not langs:
        return pred, score
    doc, gram, n = count_ngrams(texts)
    if not len(doc):
        return pred, score
    order = np.argsort(doc << 40 | (1 << 39) - np.minimum(n, (1 << 39) - 1), kind="stable")
    doc, gram = doc[order], gram[order]
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    rank = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
    top = rank < k
    doc, gram, rank = doc[top], gram[top], rank[top]
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    used = np.diff(np.append(first, len(doc)))
    at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
    known = grams[at] == gram
    dist = np.empty((len(first), len(langs)), np.int64)
    for j in range(len(langs)):
        there = np.where(known, ranks[at, j], k)
        dist[:, j] = np.add.reduceat(np.where(there >= k, k, np.abs(there - rank)), first)
    best = dist.argmin(axis=1)                   # ties: the language that comes first
    for i, b, s in zip(doc[first].tolist(), best.tolist(), (1 - dist[np.arange(len(first)), best] / (used * k)).tolist(), strict=True):
        pred[i], score[i] = langs[b], s
    return pred, score


def _text_runs(texts: list[str]):
    """Runs of texts holding about BLOCK characters."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= BLOCK:
            yield run
            run, size = [], 0
    if run:
        yield run


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
                   k: int = PROFILE, train_docs: int = TRAIN_DOCS):
    """Learn profiles from rows with text and lang.  Of a language with more
    than ``train_docs`` documents, those whose key hashes lowest are taken, at
    the rate that gives about so many.  Returns (langs, n-grams, ranks)."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where("text is not null and lang is not null")
    sizes = rows.groupBy("lang").count().limit(MAX_LANGS + 1).collect()
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not sizes:
        return [], np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
    rate = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1.0, train_docs / r["count"]))])
    low = F.shiftrightunsigned(F.xxhash64(F.lit("train"), "key"), 11).cast("double") / float(1 << 53)
    taken = rows.where(low < rate[F.col("lang")]).select("lang", "text")

    def run(batches):
        import pyarrow as pa
        worker_store("langid")
        for b in batches:
            by: dict[str, list[str]] = {}
            for la, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by.setdefault(la, []).append(t)
            for la, texts in by.items():
                grams, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
                for part in _text_runs(texts):
                    _, g, c = count_ngrams(part)
                    grams, counts = _runs(np.concatenate((grams, g)), np.concatenate((counts, c)))
                yield pa.RecordBatch.from_arrays([pa.array([la] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], names=["lang", "gram", "n"])

    importable(docs.sparkSession)
    counted = taken.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < k).select("lang", "gram", "rank").collect()
    langs = sorted({r["lang"] for r in top})
    grams = np.unique(np.array([r["gram"] for r in top], np.int64))
    ranks = np.full((len(grams), len(langs)), k, np.int64)
    for r in top:
        ranks[np.searchsorted(grams, r["gram"]), langs.index(r["lang"])] = r["rank"]
    return langs, grams, ranks


def predict(docs: DataFrame, profiles, text: str = "text", k: int = PROFILE,
            lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language of each whole text and its score.

    Null texts and texts without a letter get ``und`` and 0.  All columns stay;
    a column that has an output's name already is replaced."""
    langs, grams, ranks = profiles
    at = docs.columns.index(text)
    kept = [c for c in docs.columns if c not in (lang_out, score_out)]

    def run(batches):
        import pyarrow as pa
        worker_store("langid")
        for b in (b.slice(i, 1024) for b in batches for i in range(0, max(b.num_rows, 1), 1024)):
            pred, score = [], []
            for part in _text_runs([t or "" for t in b.column(at).to_pylist()]):
                p, s = nearest(part, langs, grams, ranks, k)
                pred += p
                score.append(s)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), pa.array(pred, pa.string()), pa.array(np.concatenate(score) if score else [], pa.float64())],
                names=[*kept, lang_out, score_out])

    from pyspark.sql.types import DoubleType, StringType, StructType
    importable(docs.sparkSession)
    schema = StructType([docs.schema[c] for c in kept]).add(lang_out, StringType()).add(score_out, DoubleType())
    return docs.mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    """Is a document kept back from learning?  (crc32 of its key as text, mod 4, is 2.)"""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 4 == 2


def identify_documents(docs: DataFrame, k: int = PROFILE) -> DataFrame:
    """Learn from the documents that are not held out, predict all of them.

    Returns doc_id, held_out, lang_pred, score.  A null doc_id counts as empty
    text; without any labelled text every prediction is ``und``; repeated rows
    are predicted alike."""
    profiles = learn_profiles(docs.where(~held_out(F.col("doc_id"))), k=k)
    return (predict(docs.select("doc_id", "text"), profiles, k=k)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))
