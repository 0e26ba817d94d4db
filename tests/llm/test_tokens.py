"""Operators 7 and 9 against the libraries on whole texts."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslake.llm import tokencount, transducer
from presslake.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
BYTES = tokenizer_path("byte_bpe_50k.json")
PIECES = tokenizer_path("piece_bpe_32k.model")
EDGE = [(1, None), (2, ""), (None, "no id"), (3, "same  "), (3, "same  "), (4, "ab <|endoftext|> c<s>"), (5, "word, " * 30_000), (6, "x" * 70_000), (7, "漢字" * 20_000), (8, "\x00▁ ▁")]


@pytest.fixture(scope="module")
def tok():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def sp():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_splice_equals_the_whole(tok):
    def encode(s):
        e = tok.encode(s, add_special_tokens=False)
        return e.ids, e.offsets

    rng = random.Random(6)
    bits = ["a", "b ", " ", "  ", "'s", "'re", "1", "23", "\n", "\t", "..", ",", "é", "漢字", "　", "<|endoftext|>", "<|end", "word", "🎉"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(30, 300))) for _ in range(200)]
    texts += ["x" * 3000, "漢" * 1500, " " * 2000, "a1" * 900, "'s" * 700, "<|endoftext|>" * 90, ""]
    for t in texts:
        for chunk, overlap in ((40, 8), (100, 30)):
            assert tokencount.splice(t, encode, tokencount.special_margin(tok), chunk, overlap) == encode(t)[0], repr(t)


def test_overlaps_widen():
    """Without a proven boundary in reach the chunks grow until there is one."""
    calls = []

    def encode(s):
        calls.append(len(s))
        return [ord(c) for c in s], [(i, i + 1) for i in range(len(s))]

    text = "é" * 500 + " a b" * 50
    assert tokencount.splice(text, encode, 1, chunk=50, overlap=4) == [ord(c) for c in text]
    assert max(calls) > 400


def test_counts(spark, tok):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: (len(r.text.encode()), len(tok.encode(r.text, add_special_tokens=False))) for r in docs.collect()}
    for chunk in (500, tokencount.CHUNK):
        got = tokencount.count_tokens(docs, BYTES, chunk=chunk, overlap=64).collect()
        assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want
        assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def test_count_edge_cases(spark, tok):
    docs = spark.createDataFrame(EDGE, SCHEMA).withColumn("n_tokens", F.lit("x")).withColumn("key", F.lit(1))
    got = tokencount.count_tokens(docs, BYTES).collect()
    want = [(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False))) for i, t in EDGE]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)
    assert tokencount.count_tokens(spark.createDataFrame([], SCHEMA), BYTES).collect() == []


def test_transducer_equals_the_library(sp):
    t = transducer.Transducer(PIECES)
    rng = random.Random(7)
    bits = ["a", "b", " ", "  ", "the", "ing", "▁", "\n", "\t", "é", "漢", "🎉", "0", "1", "er", "!", ".", ",", "),", "<s>", "<0x0A>", "\x00", "é"]
    texts = ["", " ", "▁", "a▁ b", "x" * 300, " " * 90, "a" + " " * 40 + "b"] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    for x in texts:
        want = sp.encode(x)
        assert np.frombuffer(t.encode(x), "<i4").tolist() == want, repr(x)
        assert t.decode(want) == sp.decode(want), repr(x)


def test_transducer_forgets(monkeypatch, sp):
    monkeypatch.setattr(transducer, "MEMORY", 5)
    monkeypatch.setattr(transducer, "PAIRS", 7)
    t = transducer.Transducer(PIECES)
    for x in ("the quick brown fox jumps over the lazy dog again and again", "nothing new here, nor there"):
        assert np.frombuffer(t.encode(x), "<i4").tolist() == sp.encode(x)
    assert len(t.paths) <= 5 and len(t.pairs) <= 7


def test_unigram_weights():
    """With probabilities the path of the largest product wins."""
    t = transducer.Transducer(PIECES)
    t.bpe, t.byte = False, None
    t.ids = {"▁": 3, "a": 4, "b": 5, "ab": 6, "abb": 7, "bb": 8}
    t.score = [0, 0, 0, -1.0, -2.0, -2.0, -2.5, -9.0, -2.1]
    t.piece = ["<unk>", "", "", "▁", "a", "b", "ab", "abb", "bb"]
    t.stems = {p[:k]: t.ids.get(p[:k], -1) for p in t.ids for k in range(1, len(p) + 1)}
    t.unknown = 0
    assert t.shortest("▁abb") == [3, 4, 8]
    assert t.shortest("▁ab?!b") == [3, 6, 0, 5]


def variant(tmp_path, rule: str | None, squeeze: bool, prefix: bool, unigram: bool = False, fallback: bool = True) -> str:
    """The public model's pieces with another normaliser, weights or no bytes."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    model, other = pb.ModelProto(), pb.ModelProto()
    with open(PIECES, "rb") as f:
        model.ParseFromString(f.read())
    if rule:
        other.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        model.normalizer_spec.CopyFrom(other.normalizer_spec)
    model.normalizer_spec.remove_extra_whitespaces, model.normalizer_spec.add_dummy_prefix = squeeze, prefix
    if not fallback:
        kept = [p for p in model.pieces if p.type != 6]
        del model.pieces[:]
        model.pieces.extend(kept)
        model.trainer_spec.byte_fallback = False
    if unigram:
        model.trainer_spec.model_type = 1
        rng = random.Random(11)
        for p in model.pieces:
            if p.type == 1:
                p.score = -rng.randint(5 << 10, 15 << 10) / 1024
    path = str(tmp_path / "variant.model")
    with open(path, "wb") as f:
        f.write(model.SerializeToString())
    return path


@pytest.mark.parametrize("rule,squeeze,prefix,unigram,fallback", [
    ("nmt_nfkc", True, True, False, True), ("nmt_nfkc", True, True, True, False), ("nfkc", False, True, False, True),
    ("nmt_nfkc_cf", True, False, False, False), ("nfkc_cf", False, False, True, True), (None, True, True, False, True)])
def test_normalisers_equal_the_library(tmp_path, rule, squeeze, prefix, unigram, fallback):
    import sentencepiece
    path = variant(tmp_path, rule, squeeze, prefix, unigram, fallback)
    sp, t = sentencepiece.SentencePieceProcessor(model_file=path), transducer.Transducer(path)
    rng = random.Random(13)
    bits = ["a", "B", " ", "  ", "the ", "ing", "▁", "\n", "\t", "\r", "é", "e\u0301", "\u0301", "ﬁ", "①", "Ａ", "\u3000", "\u00a0", "\u00a8", "\u00ad", "\u200b", "\ufdfa", "½", "ß", "İ",
            "漢", "が", "か\u3099", "ﾊﾟ", "각", "\u1100\u1161", "🎉", "𝐀", "\x01", "\x00", "\x7f", "0", "!", ",", "...", "…", "<unk>", "ไทย", "\ufeff"]
    texts = ["", " ", "  ", "▁", " ▁ ", "\x01", "\x01 ", "\u3000", "a▁", "a ▁ b", " a  b ", "e" + "\u0301" * 50, "ﬁ" * 3000, "漢\n字", "漢漢"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    for x in texts:
        want = sp.encode(x)
        assert np.frombuffer(t.encode(x), "<i4").tolist() == want, repr(x)
        assert t.decode(want) == sp.decode(want), repr(x)


def test_character_map_equals_the_library(tmp_path):
    """Every key of the map, read from its trie, against the library's reading."""
    import sentencepiece
    t = transducer.Transducer(variant(tmp_path, "nmt_nfkc", False, False))
    n = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", escape_whitespaces=False, add_dummy_prefix=False, remove_extra_whitespaces=False)
    assert len(t.normal.rules) > 10_000 and all(n.normalize(k) == v == t.normal(k) for k, v in t.normal.rules.items())
    every = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    assert [c for c in every if n.normalize(c) != t.normal(c)] == []


def test_normalised_table(spark, tmp_path):
    """Whole texts through Spark with a normaliser that changes them."""
    import sentencepiece
    path = variant(tmp_path, "nmt_nfkc", True, True, unigram=True, fallback=False)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = spark.createDataFrame([*EDGE, (9, "ﬁne  Ａ" * 9_000)], SCHEMA)
    got = transducer.encode(docs, path).collect()
    want = [(i, sp.encode(t or "")) for i, t in [*EDGE, (9, "ﬁne  Ａ" * 9_000)]]
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == sorted(want, key=repr)


def test_encode_query(spark, sp):
    docs = spark.createDataFrame(EDGE, SCHEMA).withColumn("ids", F.lit("x")).withColumn("_text", F.lit(1))
    rows = transducer.encode(docs, PIECES)
    got = rows.collect()
    want = [(i, sp.encode(t or "")) for i, t in EDGE]
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.n_ids == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<i4").tobytes()) for r in got)
    assert {r.doc_id for r in got if not r.round_trip} == {8}  # a literal word mark reads as a blank, as in the library
    back = transducer.decode(rows, PIECES).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=repr) == sorted(((i, sp.decode(sp.encode(t or ""))) for i, t in EDGE), key=repr)
    assert transducer.encode(spark.createDataFrame([], SCHEMA), PIECES).collect() == []


def test_round_trip_of_the_table(spark, sp):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = transducer.encode(docs, PIECES).collect()
    want = {r.doc_id: sp.encode(r.text) for r in docs.collect()}
    assert {r.doc_id: r.ids for r in got} == want and all(r.round_trip for r in got)
