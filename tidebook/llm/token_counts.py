"""Token counts by batch encoding inside Arrow functions."""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory, ship

#: Bytes of text encoded by one call, and the length from which a text is split.
BATCH_BYTES = 1 << 20
#: Pre-tokenizers that drop white space, and normalizers that do nothing to a word because of the words beside it.
DROPPING = frozenset(("BertPreTokenizer", "Whitespace", "WhitespaceSplit", "Split, others removed"))
WORD_BY_WORD = frozenset(("NFC", "NFD", "Lowercase", "StripAccents", "Replace of white space"))


@functools.lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """A .json tokenizer without truncation and padding, once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _steps(rule: dict | None) -> list[str]:
    """Types of a rule's steps, with what matters of their settings."""
    if rule is None:
        return []
    if rule["type"] == "Sequence":
        return [n for r in rule.get("normalizers") or rule.get("pretokenizers") or () for n in _steps(r)]
    said = rule["type"]
    if rule.get("add_prefix_space"):
        said += " with a space"
    if said == "Split" and rule.get("behavior") == "Removed" and rule.get("invert"):
        said += ", others removed"
    if said == "Replace" and rule.get("pattern") == {"Regex": r"\s+"} and rule.get("content") == " ":
        said += " of white space"
    return [said]


@functools.lru_cache(maxsize=4)
def tokenizer_steps(path: str) -> tuple[list[str], list[str]]:
    """What a .json tokenizer does with a text before it looks for tokens: its normalizers and its pre-tokenizers."""
    with open(path, "rb") as f:
        rules = json.load(f)
    return _steps(rules.get("normalizer")), _steps(rules.get("pre_tokenizer"))


def drops_white_space(path: str) -> bool:
    """Whether a tokenizer's file says that white space is dropped and words don't touch each other, so that their counts add up to the text's."""
    if not path.endswith(".json"):
        return False
    normalizers, pre = tokenizer_steps(path)
    return WORD_BY_WORD.issuperset(normalizers) and not DROPPING.isdisjoint(pre) and not any("with a space" in x for x in pre)


@functools.lru_cache(maxsize=4)
def load_pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def by_bytes(words: list[bytes], limit: int = BATCH_BYTES) -> Iterator[list[bytes]]:
    """Consecutive batches of about ``limit`` bytes; a longer item is a batch of its own."""
    batch, size = [], 0
    for w in words:
        if batch and size + len(w) > limit:
            yield batch
            batch, size = [], 0
        batch.append(w)
        size += len(w)
    if batch:
        yield batch


def safe_parts(text: bytes, limit: int = BATCH_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, in parts of about ``limit`` bytes that end at ASCII white space.

    White space is dropped by the tokenizers this is used for and neither merges,
    nor composes, nor changes case with what stands beside it, so the counts of the
    parts add up to the text's.
    """
    at = 0
    while len(text) - at > limit:
        end = at + limit
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[at:end].split()
        at = end
    yield text[at:].split()


class WordCounts:
    """Token counts of lists of words, for a tokenizer that drops white space."""

    def __init__(self, path: str):
        self.encode = load_tokenizer(path).encode_batch
        self.known = Memory()

    def learn(self, words: set[bytes]) -> None:
        self.known.room(words)
        for batch in by_bytes(self.known.new(words)):
            for w, found in zip(batch, self.encode([w.decode() for w in batch], add_special_tokens=False)):
                self.known.learn(w, len(found))

    def __call__(self, texts: list[bytes]) -> list[int]:
        counts, parts, size = [0] * len(texts), [], 0
        for row, text in enumerate(texts):
            for words in safe_parts(text):
                parts.append((row, words))
                size += sum(map(len, words))
                if size >= BATCH_BYTES:
                    self.add(counts, parts)
                    parts, size = [], 0
        self.add(counts, parts)
        return counts

    def add(self, counts: list[int], parts: list[tuple[int, list[bytes]]]) -> None:
        self.learn(set().union(*(words for _, words in parts)))
        for row, words in parts:
            counts[row] += sum(map(self.known.__getitem__, words))


@functools.lru_cache(maxsize=4)
def counter(path: str, words_apart: bool):
    """Counts a list of texts."""
    if path.endswith(".model"):
        return lambda texts: [len(load_pieces(path).encode(x.decode())) for x in texts]
    if words_apart:
        return WordCounts(path)
    encode = load_tokenizer(path).encode_batch
    return lambda texts: [len(x) for batch in by_bytes(texts) for x in encode([t.decode() for t in batch], add_special_tokens=False)]


def _count(batches: Iterator[pa.RecordBatch], path: str, words_apart: bool) -> Iterator[pa.RecordBatch]:
    count = counter(path, words_apart)
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        sizes, tokens = [], []
        for start in range(0, len(texts), 512):
            rows = [x or b"" for x in texts[start : start + 512].to_pylist()]
            sizes += map(len, rows)
            tokens += count(rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
        )


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    words_apart: bool | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The number of tokens of every whole text, without begin, end or added special tokens.

    Texts go to Python in Arrow batches and only lengths come back. Encoding is done
    in batches of about ``BATCH_BYTES``; longer texts are split at white space. Where the
    tokenizer's file says that it drops white space, such as the word BPE's, distinct words
    are encoded once and their counts are added; for others, and for .model files, each text is
    encoded as a whole. ``words_apart`` says which, and is refused where words can't be
    taken apart. Strings of special tokens inside texts are handled as the library does by default.

    Returns doc_id, n_bytes (UTF-8), n_tokens; a row per row of ``docs``. Null and
    empty texts have 0 of each; null ids and repeated rows are kept; an empty table
    gives no rows. Other columns are ignored.
    """
    ship(docs.sparkSession)
    able = drops_white_space(tokenizer_path)
    if words_apart and not able:
        raise ValueError(f"the tokenizer of {tokenizer_path} doesn't drop white space: words can't be counted apart")
    words_apart = able if words_apart is None else words_apart
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        lambda batches: _count(batches, tokenizer_path, words_apart), f"doc_id {kind}, n_bytes bigint, n_tokens bigint"
    )
