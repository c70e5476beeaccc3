"""Clashing columns, empty tables, long texts and bounded memories."""

import zlib

import pytest

import corpus_pipeline
from tidebook.llm import common, hmm_lm, mtree, near_copies, packing, quality_rules, simhash, token_counts, toxicity, warc
from tidebook.llm import sentencepiece_viterbi as viterbi
from tidebook.llm.queries import tokenizer_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
GOOD = " ".join(f"word{k} and" for k in range(60))
OTHER = " ".join(f"else{k} then" for k in range(60))


def test_filters_leave_columns_of_any_name_alone(spark):
    rows = [(k, GOOD + f" t{k}" * 9, "en", "s", 7, 999 + k, f"own {k}", 0.25) for k in range(4)] + [(4, "short", "en", "s", 7, 1003, "own 4", 0.25)]
    docs = spark.createDataFrame(rows, DOCS + ", __id bigint, __TEXT string, __score double")
    for keep in (quality_rules.keep_good, simhash.deduplicate, near_copies.deduplicate):
        kept = keep(docs)
        assert kept.columns == docs.columns
        found = kept.collect()
        assert found and all((r["__id"], r["__TEXT"], r["__score"]) == (999 + r.doc_id, f"own {r.doc_id}", 0.25) for r in found)


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], DOCS)
    model = tokenizer_path("piece_bpe_32k.model")
    assert viterbi.round_trip(docs, model).count() == 0 and viterbi.encode_texts(docs, model).count() == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    made = corpus_pipeline.run(spark, str(tmp_path))
    assert made.count() == 0 and "sequence_id" in made.columns


def test_pipeline_with_nulls_in_any_column(spark, tmp_path):
    rows = [(1, GOOD, None, None, None), (2, None, "en", "s", 1), (None, OTHER, None, None, None), (3, GOOD, "en", "s", 1), (3, GOOD, "en", "s", 1), (4, "", "en", "s", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None, None), (None, 1, 1), (3, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {1, None}


@pytest.fixture(scope="module")
def long_text():
    """Some megabytes: many words, and one word of a megabyte."""
    return " ".join(f"w{k % 9000}x{k % 7}" for k in range(400_000)) + " " + "ab" * 500_000


def test_texts_of_several_megabytes(spark, long_text):
    import sentencepiece
    from tokenizers import Tokenizer

    docs = spark.createDataFrame([(1, long_text, "en", "s", 1), (2, "a few words", "en", "s", 1)], DOCS)
    n = len(long_text.split())
    judged = quality_rules.quality_rules(docs).where("doc_id = 1").first()
    assert (judged.n_words, judged.word_chars) == (n, len(long_text) - n + 1)
    assert hmm_lm.score_documents(docs, rounds=1).where("doc_id = 1").first().n_tokens == n + 1
    assert simhash.near_duplicates(docs).count() == near_copies.near_copies(docs).count() == 2
    model = tokenizer_path("piece_bpe_32k.model")
    ids = viterbi.encode_texts(docs, model).where("doc_id = 1").first().ids
    assert ids == sentencepiece.SentencePieceProcessor(model_file=model).encode(long_text)
    word, byte = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
    few = " ".join(long_text.split(" ")[:-1])  # the library takes a word's square
    short = spark.createDataFrame([(1, few)], "doc_id bigint, text string")
    assert token_counts.count_tokens(short, word).first().n_tokens == len(Tokenizer.from_file(word).encode(few, add_special_tokens=False).ids)
    pieces = packing.pack_documents(short, byte).agg({"length": "sum"}).first()[0]
    assert pieces == len(Tokenizer.from_file(byte).encode(few, add_special_tokens=False).ids) + 1


def test_warc_of_several_megabytes_and_clashing_columns(spark, long_text):
    rows = [(1, "http://h/1", long_text, 5, "x", 1), (2, "http://h/2", long_text, 5, "x", 1), (3, None, "short", 5, "x", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, __page int, digest string, refers_to int")
    found = {r.page_id: r for r in warc.read_archives(warc.write_archives(pages)).collect()}
    assert found[1].record_type == "response" and zlib.crc32(bytes(found[1].payload)) == zlib.crc32(long_text.encode())
    assert (found[2].record_type, found[2].refers_to, found[3].record_type) == ("revisit", 1, "response")


def test_top_k_with_clashing_columns_and_components_of_any_size(spark):
    rows = [(k, [float(k), 2.0], 1, 2, "x") for k in range(60)] + [(100, [1.0e6, -1.0e6], 1, 2, "x"), (101, [1.0e300, 0.0], 1, 2, "x"), (50, [5.0, 1.0], 3, 4, "y")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, id int, tree int, v string")
    found = mtree.top_k(table, table.where("vec_id % 50 = 0"), k=3).collect()
    best = {}
    for q, query, *_ in rows:
        if q % 50 == 0 and q != 101:
            scores = sorted((-sum(int(256 * a // 1) * int(256 * b // 1) for a, b in zip(query, v)), i) for i, v, *_ in rows if i != q and i != 101)
            best.setdefault(q, []).extend(scores)
    # a repeated id with another vector is a query of its own; of its scores the best count
    want = {(q, r + 1, i, -s) for q, scores in best.items() for r, (s, i) in enumerate(sorted(set(scores))[:3])}
    assert {tuple(r) for r in found if r.query_id != 50} == {w for w in want if w[0] != 50}
    assert all(r.vec_id != 101 for r in found)


def test_memories_are_bounded_by_bytes():
    m = common.Memory(10_000)
    m.learn("x" * 20_000, b"")
    assert len(m) == 1
    m.room(["x" * 20_000])
    assert len(m) == m.size == 0
    for k in range(60):
        m.learn(f"w{k}", b"1234")
    m.room(["w3", "w70", "w7"])
    assert dict(m) == {"w3": b"1234", "w7": b"1234"} and m.size == 2 * (6 + m.ENTRY)


def test_kind_of_tokenizer_is_read_from_its_file(spark):
    word, byte = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
    assert token_counts.drops_white_space(word) and not token_counts.drops_white_space(byte)
    docs = spark.createDataFrame([(1, "some words  here")], "doc_id bigint, text string")
    assert token_counts.count_tokens(docs, byte).first().n_tokens == len(token_counts.load_tokenizer(byte).encode("some words  here").ids)
    with pytest.raises(ValueError, match="white space"):
        token_counts.count_tokens(docs, byte, words_apart=True)


def test_intermediate_tables_can_be_deleted(spark):
    from pathlib import Path

    t = common.materialize(spark.range(5), "some")
    path = Path(common._written[t].removeprefix("file://"))
    assert path.exists() and common.materialize(t, "more").count() == 5
    common.discard(t)
    assert not path.exists()


def test_host_of_urls(spark):
    from pyspark.sql import functions as F

    urls = [("https://User@Www.Example.org:80/a?b",), ("/relative",), (None,), ("not a url",), ("http://[::1",)]
    got = [r[0] for r in spark.createDataFrame(urls, "u string").select(quality_rules.host_of(F.col("u"))).collect()]
    assert got == ["www.example.org", None, None, None, None]
