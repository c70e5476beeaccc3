"""The queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_windows, hmm_lm, mtree, packing, prefix_trie, sharding, simhash, spelling, token_counts, toxicity, warc
from . import sentencepiece_viterbi as viterbi
from . import quality_rules as quality


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleave_shards(_table(spark, sf_dir, "documents"), n_shards=40)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), fold=3)


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return mtree.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), capacity=2048)


def op7_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = hmm_lm.score_documents(_table(spark, sf_dir, "documents"), fold=5)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), width=4, distance=4).select("doc_id", "fingerprint", "component_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_archives(archives, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    all_of_them = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_windows.digests(chat_windows.format_windows(all_of_them, budget=2048, history=256))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"), family=100, most=6)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"), min_length=7, min_count=2, slip_every=31)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_toxicity": op3_toxicity,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_quality_rules": op5_quality_rules,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_hmm_lm": op7_hmm_lm,
    "op8_simhash": op8_simhash,
    "op9_token_counts": op9_token_counts,
    "op10_warc": op10_warc,
    "op11_chat_windows": op11_chat_windows,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling_variants": op13_spelling_variants,
}
