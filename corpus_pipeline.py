"""A corpus pipeline: documents in, packed training sequences out.

``run`` applies STAGES in order; each stage's rows are written as Parquet to
the shared folder and read back as the next one's documents.  All stages but
the last return the columns of their input, for the documents that they keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm import langid, packing, quality, simhash
from presslake.llm.common import stage
from presslake.llm.queries import tokenizer_path

#: Documents whose nearest language scores less are in none of the languages.
MIN_LANGUAGE_SCORE = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a known language (operator 1): text without letters,
    or far from every profile, goes.  Profiles are learned from the labelled
    documents; the label of a document is no input to its prediction."""
    profiles = langid.learn_profiles(docs.where(~langid.held_out(F.col("doc_id"))))
    if not profiles[0]:  # nothing is labelled: nothing to judge by but letters
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "text")
    found = langid.predict(rows, profiles)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("_doc.*")


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that pass the plain rules and are no outliers of their
    language and source (operator 8).  A null text has no words and fails; null
    languages and sources are groups of their own; an empty table stays empty.
    Statistics are counted once and staged with the rows."""
    # The row travels as one column: its own columns may have any names.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "text", "lang", "source")
    counted = stage(quality.add_statistics(rows).drop("text"), "pipeline-statistics")
    return quality.judge(counted, quality.fit_groups(counted.drop("_doc"))).where("kept").select("_doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (operator 2): that of
    the smallest doc_id, of repeated rows one.  A document without an id is in
    its group like any other, and kept only if the group has no id at all."""
    return simhash.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenize, cut and pack the documents (operator 6); one row per piece.  A
    null or empty text has its end token only; an empty table gives no rows."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language", identify_language),
    ("quality", judge_quality),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: No SQL expresses these stages; tests/llm checks run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
