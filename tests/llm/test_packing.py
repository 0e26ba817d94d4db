"""Operator 6: token ids, cuts and first-fit decreasing against plain ones."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslake.llm import packing
from presslake.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def test_words_encode_as_the_whole_text(tok):
    rng = random.Random(4)
    bits = ["a", "Word", " ", "  ", "\n", "\t", "\r\n", " ", "　", "\x1c", "\x85", "é", "é", "́", "İ", "ΣΑΣ", "漢", "'s", "12", "!?", "<|endoftext|>", "<|start", "🎉"]
    texts = ["", " ", "́a", "a ́b"] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(500)]
    small = packing.WordEncoder(PATH, words=50)  # forgets all the time
    for enc in (packing.WordEncoder(PATH), small):
        for s in range(0, len(texts), 100):
            for t, ids in zip(texts[s:s + 100], enc.encode(texts[s:s + 100])):
                assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_first_fit_is_first_fit():
    rng = random.Random(5)
    for n in (0, 1, 2, 7, 64, 500):
        sizes = sorted((rng.randint(1, 50) for _ in range(n)), reverse=True)
        room, want = [], []
        for s in sizes:
            i = next((k for k, r in enumerate(room) if r >= s), len(room))
            if i == len(room):
                room.append(50)
            want.append((i, 50 - room[i]))
            room[i] -= s
        assert list(zip(*packing.first_fit(sizes, 50))) == want
    with pytest.raises(ValueError):
        packing.first_fit([51], 50)


def verify(rows, docs, tok, capacity=2048):
    """Every id lies in one piece, sequences are gapless and not too long."""
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    copies = defaultdict(list)
    for i, t in docs:
        copies[i].append(t)
    for i, texts in copies.items():
        want = []
        for t in texts:
            ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
            want += [(s, len(ids[s:s + capacity]), zlib.crc32(np.array(ids[s:s + capacity], "<u4").tobytes()), len(ids)) for s in range(0, len(ids), capacity)]
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[i]) == sorted(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(sequences)


def test_query(spark, tok):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = packing.pack_documents(docs, PATH).collect()
    n = verify(rows, [tuple(r) for r in docs.collect()], tok)
    total = sum(r.length for r in rows)
    assert n <= -(-total // 2048) * 1.02 + 1


@pytest.mark.parametrize("group,block", [(3, 1 << 16), (8192, 4)])
def test_groups_and_blocks(spark, tok, monkeypatch, group, block):
    docs = [(i, "w " * (i % 9 * 300)) for i in range(40)] + [(7, "again")] * 12
    df = spark.createDataFrame(docs, SCHEMA)
    from presslake.llm.common import stage
    pieces = stage(packing.cut_documents(df, PATH), "pieces")
    rows = packing.pack(pieces, ("doc_id", "start", "ids_crc32", "length", "doc_tokens"), group=group, block=block).collect()
    verify(rows, docs, tok)


def test_edge_cases(spark, tok):
    docs = [(1, None), (None, "no id"), (None, None), (2, ""), (3, "same"), (3, "same"), (4, "long words " * 20_000), (5, "x" * 300_000)]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("start", F.lit("x")).withColumn("_text", F.lit(1)).withColumn("_g", F.lit(1))
    verify(packing.pack_documents(df, PATH).collect(), docs, tok)
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_ids_on_request(spark, tok):
    rows = packing.cut_documents(spark.createDataFrame([(1, "Hello there, world")], SCHEMA), PATH, capacity=2, with_ids=True).collect()
    assert [i for r in sorted(rows, key=lambda r: r.start) for i in r.ids] == [*tok.encode("Hello there, world", add_special_tokens=False).ids, 1]
