"""Ids of a BPE model against the library on the unchanged model."""

import random

import numpy as np
import sentencepiece

from tidebook.llm import sentencepiece_viterbi as viterbi
from tidebook.llm.queries import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")


def texts(spark):
    found = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    draw = random.Random(4)
    letters = "".join(draw.choices("abcdeinrst", k=20_000))
    return found + ["a  b   c\n\n d ", " lead", "", "tab\there\x0bvt\r\n", "日本語 テキスト 梦 🙂👩‍👩‍👧", "aaaa" * 50, "word " + "long" * 3000, letters, "x\x00y", "▁ ▁▁ under", "\n", "   "]


def test_ids_are_the_librarys(spark):
    found = texts(spark)
    docs = spark.createDataFrame(list(enumerate(found)), "doc_id int, text string")
    got = {r.doc_id: r.ids for r in viterbi.encode_texts(docs, MODEL).collect()}
    want = sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(found)
    wrong = [k for k, ids in enumerate(want) if got[k] != ids]
    assert not wrong, [(k, found[k][:40]) for k in wrong[:5]]


def test_the_first_of_equal_pairs_is_merged():
    assert viterbi.merged("aaaaa", {"a": 0.0, "aa": -1.0, "aaaa": -2.0}) == ["aaaa", "a"]
    assert np.frombuffer(viterbi.encoder(MODEL).ids(""), "<i4").tolist() == []


def test_pairs_are_the_merges_with_a_window_of_bounded_width(spark):
    """The search gives what merging whole texts gives, however they are fed, and holds no more than a window."""
    v = viterbi.vocabulary(MODEL)
    search = viterbi.StreamingPairs(v)
    for text in [v.normalize(t) for t in texts(spark)[::3]]:
        for step in (7, 10_000):
            found, widest = [], 0
            for at in range(0, len(text), step):
                found += search.feed(text[at : at + step])
                widest = max(widest, len(search.text))
            assert found + search.finish() == viterbi.merged(text, v.score)
            assert widest <= 4 * v.longest


def test_pairs_of_a_made_model():
    """Pieces that several pairs of others make up, against merges of random texts."""
    class Made:
        score = {p: -k for k, p in enumerate(["a", "b", "c", "ab", "bc", "abc", "ca", "aa", "aabc", "cab", "bcab", "abab"])}
        longest = 4

        def __init__(self):
            self.matches = viterbi.ahocorasick.Automaton()
            for k, (p, x) in enumerate(self.score.items()):
                self.matches.add_word(p, (len(p), x, k))
            self.matches.make_automaton()

    search, draw = viterbi.StreamingPairs(Made()), random.Random(9)
    for _ in range(2000):
        text = "".join(draw.choices("abcd", weights=[5, 5, 5, 1], k=draw.randint(0, 40)))
        assert search.feed(text) + search.finish() == viterbi.merged(text, Made.score)
