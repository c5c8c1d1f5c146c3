"""The operators bound to the driver's tables: ``QUERIES[name](spark, sf_dir)`` and ``ORACLE_SQL[name]``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import cutting_stock, decontaminate, hard_negatives, license_scan, prefix_trie, pu_quality
from tessera.llm import substring_doubling, suffix_dedup, topk_inner, toxicity
from tessera.llm.bpe import digests, encode
from tessera.llm.common import small_batches
from tessera.llm.shard_packing import pack_shards
from tessera.llm.simhash import near_duplicates
from tessera.sources.tables import read_table


def op1_run_length_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier."""
    return suffix_dedup.digests(suffix_dedup.dedup_bytes(spark, read_table(spark, sf_dir, "documents")))


def op2_vector_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards, bytes, tokens and rows balanced together."""
    return pack_shards(spark, read_table(spark, sf_dir, "documents"), n_shards=16)


def op3_positive_unlabelled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from trusted positives and all documents."""
    return pu_quality.score_documents(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_segment_popcount_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicates(spark, read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document's restored text."""
    return toxicity.score_documents(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_aho_corasick_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scanned once for all 13-word windows of the benchmark."""
    return decontaminate.contamination(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_doubling_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 50-word windows that start in an earlier document."""
    return substring_doubling.digests(substring_doubling.dedup_words(spark, read_table(spark, sf_dir, "documents")))


def op8_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document: passages against templates by Dice over word bigrams."""
    return license_scan.scan_licenses(spark, read_table(spark, sf_dir, "documents"))


def op9_norm_sorted_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products of every hundredth vector against all vectors."""
    return topk_inner.top_k_inner(spark, read_table(spark, sf_dir, "embeddings"))


def tokenizer_path() -> str:
    """The vocabulary file of the contract's tokenizer (read on the driver only)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; digests of the ids and of the decoded text."""
    return digests(encode(spark, read_table(spark, sf_dir, "documents"), tokenizer_path()))


def op11_angular_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector and its five nearest rows of the same label."""
    return hard_negatives.hard_negatives(spark, read_table(spark, sf_dir, "embeddings"), hard_negatives.shifted_label())


def op12_ternary_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(spark, read_table(spark, sf_dir, "conversations"))


def op13_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of 2,048 without padding."""
    return cutting_stock.digests(cutting_stock.pack_tokens(spark, read_table(spark, sf_dir, "documents"), tokenizer_path()))


def _in_small_batches(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _in_small_batches(query) for name, query in {
    "op1_run_length_suffix_dedup": op1_run_length_suffix_dedup,
    "op3_positive_unlabelled_quality": op3_positive_unlabelled_quality,
    "op4_segment_popcount_simhash": op4_segment_popcount_simhash,
    "op5_noisy_channel_toxicity": op5_noisy_channel_toxicity,
    "op6_aho_corasick_decontamination": op6_aho_corasick_decontamination,
    "op7_doubling_substring_dedup": op7_doubling_substring_dedup,
    "op8_license_dice": op8_license_dice,
    "op9_norm_sorted_top_k": op9_norm_sorted_top_k,
    "op10_transducer_bpe": op10_transducer_bpe,
    "op2_vector_bin_packing": op2_vector_bin_packing,
    "op11_angular_hard_negatives": op11_angular_hard_negatives,
    "op12_ternary_prefix_trie": op12_ternary_prefix_trie,
    "op13_cutting_stock_packing": op13_cutting_stock_packing,
}.items()}

ORACLE_SQL: dict[str, str] = {
    "op8_license_dice": license_scan.oracle_sql(),
    "op6_aho_corasick_decontamination": decontaminate.oracle_sql(),
    "op9_norm_sorted_top_k": topk_inner.oracle_sql(),
    "op11_angular_hard_negatives": hard_negatives.oracle_sql(),
}
