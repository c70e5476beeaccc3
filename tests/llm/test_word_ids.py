"""Ids put together from words: what the tokenizer is asked for, and that they are its own for whole texts."""

import random
import sys

import pyarrow as pa

from tidebook.llm import packing
from tidebook.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def test_words_with_stops_are_encoded_once(monkeypatch):
    ids, asked = packing.WordIds(PATH), []
    given = packing.WordIds.encoded
    monkeypatch.setattr(packing.WordIds, "encoded", lambda self, text: asked.append(text) or given(self, text))
    text = "So hendwhre, hendwhre. hendwhre: hendwhre; hendwhre! hendwhre? hendwhre"
    assert ids([text]) == [ids.whole(text)]
    assert sum(x.count("hendwhre") for x in asked) == 1
    assert not any(ids.mark[0] in x for x in asked)


def test_ids_of_odd_words_are_the_tokenizers():
    ids, draw = packing.WordIds(PATH), random.Random(5)
    parts = ["it's", "'s", "'", "'tis", "x'", "a.b", "a.", "..", ".", ",", "?!", "3", "3.", "3.5,", "²", "½.", "ª;", "é", "É,", "ß:", "\xad", "\xad.", "<|endoftext|>", "a<|endoftext|>.", "<|endoftext|>,", "a", "Ġ", "don't.", "I'll,", "_", "_.", "(x),", "\"q.\"", "ÿ!", "'re.", "'re"]
    texts = ["", *parts]
    for _ in range(400):
        texts.append("\n".join(" ".join(draw.choices(parts, k=draw.randint(1, 9))) for _ in range(draw.randint(1, 3))))
    texts += ["tab\there", "two  spaces", " lead", "end ", "café x", "\x7f", "a\x00b"]
    got = [x for at in range(0, len(texts), 50) for x in ids(texts[at : at + 50])]
    assert got == [ids.whole(x) for x in texts]


def test_words_with_several_stops_are_encoded_once(monkeypatch):
    ids, asked = packing.WordIds(PATH), []
    given = packing.WordIds.encoded
    monkeypatch.setattr(packing.WordIds, "encoded", lambda self, text: asked.append(text) or given(self, text))
    texts = ["So hendwhre.%%% hendwhre,$$$ hendwhre###\nhendwhre.' hendwhre'", "hendwhre... (hendwhre) hendwhre"]
    assert ids(texts) == [ids.whole(x) for x in texts]
    # with a space before it, with a line feed, and with a parenthesis
    assert sum(x.count("hendwhre") for x in asked) == 3
    assert ids(texts[::-1]) == [ids.whole(x) for x in texts[::-1]]
    assert sum(x.count("hendwhre") for x in asked) == 3


def test_work_in_python_does_not_go_by_lines():
    ids, calls = packing.WordIds(PATH), []
    texts = ["\n".join(f"some words of line {k}, text {n}" for k in range(400)) for n in range(20)]
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        got = ids(texts)
    finally:
        sys.setprofile(None)
    assert got == [ids.whole(x) for x in texts]
    assert len(calls) < 5000  # of 8,000 lines


def test_known_words_are_bounded_by_bytes():
    asked = []

    def encode(words):
        asked.append(words)
        return [pa.array([x.encode() * 2 for x in words], pa.binary())]

    known = packing.KnownWords(encode, limit=2000)
    for k in range(40):
        words = [f"w{n}" for n in range(9 * k, 9 * k + 20)]
        assert known(pa.array(words)).to_pylist() == [x.encode() * 2 for x in words]
        assert known.size <= 2000
    assert len(asked) == 40 and max(map(len, asked[1:])) == 9
    assert known(pa.array(["x" * 5000])).to_pylist() == [b"x" * 10000] and known.size <= 1000


def test_texts_are_taken_by_bytes():
    texts = pa.array(["a" * 4, "", "b" * 5, "c" * 30, "", "d" * 9, "e"])
    assert list(packing.chunks(texts, 10)) == [(0, 3), (3, 4), (4, 7)]
    assert list(packing.chunks(texts[:0], 10)) == []
    assert list(packing.chunks(pa.array(["", ""]), 10)) == [(0, 2)]


def test_ids_where_no_text_or_every_text_is_regular():
    for texts in ([], [""], ["a\tb", "", " a"], ["a", "b\nc"], ["...", "'s", "a\n'.\nb's"], ["a<|endoftext|>.", "x"]):
        ids = packing.WordIds(PATH)
        assert ids(texts) == [ids.whole(x) for x in texts]
