"""The registered queries on the smallest tables: their columns and types, whole results, and SQL where there is any."""

import compare
import pytest

from tidebook.llm.oracles import ORACLES
from tidebook.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2_sentencepiece": "doc_id bigint, n_ids bigint, ids_hash bigint, text_crc32 bigint, decoded_crc32 bigint, same boolean",
    "op3_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op4_exact_top_k": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op5_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op6_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op7_hmm_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op8_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op9_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op10_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op11_chat_windows": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op12_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op13_spelling_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    made = QUERIES[name](spark, DATA)
    assert ", ".join(f"{c} {t}" for c, t in made.dtypes) == COLUMNS[name]
    if name in ORACLES:
        assert compare.rows_of_spark(made) == compare.rows_of_duckdb(ORACLES[name], DATA)
    elif name not in ("op6_best_fit_packing",):
        documents = spark.read.parquet(f"{DATA}/documents.parquet")
        assert sorted(r.doc_id for r in made.select("doc_id").collect()) == sorted(r.doc_id for r in documents.select("doc_id").collect())


def test_language_model_beats_word_shares_on_held_out_texts(spark):
    from pyspark.sql import functions as F

    r = QUERIES["op7_hmm_lm"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b
