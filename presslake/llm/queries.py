"""The queries of this folder's operators: ``(spark, sf_dir) -> DataFrame``.

Each ``opN_<name>`` applies operator N to its whole table with production
parameters.  Tokenizer files are looked up by :func:`tokenizer_path`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from presslake.llm.oracle import ORACLE_SQL  # noqa: F401  (registered with the queries)


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is installed (on every machine)."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.langid import identify_documents
    return identify_documents(read(spark, sf_dir, "documents"))


def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.simhash import near_duplicate_documents
    return near_duplicate_documents(read(spark, sf_dir, "documents"))


def op3_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.hostrank import judge_urls
    return judge_urls(read(spark, sf_dir, "pages"))


def op4_pruned_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.ann import search_embeddings
    return search_embeddings(read(spark, sf_dir, "embeddings"))


def op5_consensus_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.htmltext import extract_pages
    return extract_pages(read(spark, sf_dir, "pages"))


def op6_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.packing import pack_documents
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.tokencount import count_tokens
    return count_tokens(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.quality import judge_documents
    return judge_documents(read(spark, sf_dir, "documents"))


def op9_transducer_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.transducer import encode
    return encode(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.sharding import shard_documents
    return shard_documents(read(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.spelling import document_variants
    return document_variants(read(spark, sf_dir, "documents"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.decontaminate import contaminated_documents
    return contaminated_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.llm.trie import conversation_trie
    return conversation_trie(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_rank_order_language, op2_simhash_components, op3_host_trust, op4_pruned_graph_search, op5_consensus_text, op6_first_fit_packing, op7_token_counts, op8_robust_outliers, op9_transducer_pieces, op10_rendezvous_shards,
                            op11_spelling_variants, op12_decontamination, op13_prefix_trie)}
