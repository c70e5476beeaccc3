"""Spelling variants of a corpus's words, found by wildcard groups and deletions instead of pairs."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, ship

#: Letters, before A-Z are lower-cased; and how many kinds are left then, which bounds a wildcard group.
LETTERS = "a-zÀ-ÿ"
KINDS = 26 + 64
#: Code points of the longest word whose groups are keyed by its own text. A longer one has as many groups as code points, each
#: as long as itself, so these are keyed by a 127-bit hash that is carried along the word.
SPELT_OUT = 64
PRIME, BASE = (1 << 127) - 1, 0x2545F4914F6CDD1D9E3779B97F4A7C15
#: Words that a task counts before it hands them on, by the bytes they take; and the text that is searched at once.
COUNTED_BYTES = 48 << 20
STRETCH = 1 << 20
#: How much more frequent a word's form is.
RATIO = 10


def _stretches(text: str) -> Iterator[str]:
    """A text in parts of about STRETCH code points that no run of letters is cut by."""
    other, at = re.compile(f"[^{LETTERS}]"), 0
    while len(text) - at > STRETCH:
        found = other.search(text, at + STRETCH)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def _count(batches: Iterator[pa.RecordBatch], min_length: int, slip_every: int) -> Iterator[pa.RecordBatch]:
    runs, counts, size = re.compile(f"[{LETTERS}]{{{min_length},}}").findall, Counter(), 0

    def counted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                said = zlib.crc32(f"{doc_id or ''}:".encode())
                for stretch in _stretches((text or b"").lower().decode()):
                    for word, n in Counter(runs(stretch)).items():
                        if slip_every and not (h := zlib.crc32(word.encode(), said)) % slip_every:
                            word = word[: (k := h % len(word))] + word[k + 1 :]
                            if len(word) < min_length:
                                continue
                        if word not in counts:
                            size += 120 + 2 * len(word)
                        counts[word] += n
                    if size > COUNTED_BYTES:
                        yield counted()
                        counts.clear()
                        size = 0
    yield counted()


def vocabulary(
    docs: DataFrame, min_length: int = 7, min_count: int = 2, slip_every: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The distinct words (runs of letters, A-Z lower-cased) of ``min_length`` code points and ``min_count`` occurrences or more.

    With ``slip_every`` a word of a document loses one letter where that divides crc32 of ``<id>:<word>``, at the
    place that the crc's remainder by its length says. Tasks count before the shuffle.

    Returns word, n, id: ids are in the order of the words' code points, with gaps.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    counted = rows.mapInArrow(lambda batches: _count(batches, min_length, slip_every), "word string, n bigint")
    found = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return materialize(found.orderBy("word").select("word", "n", F.monotonically_increasing_id().alias("id")), "spelling-words")


def _hash(word: str) -> int:
    h = 0
    for c in word:
        h = (h * BASE + ord(c)) % PRIME
    return h


def _long_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of words that aren't spelt out: of each place's wildcard group, of each distinct deletion, and of the word itself."""
    out: list[tuple[str, str, int, int]] = []

    def keyed() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(("kind", "key", "id", "n"), x)) for x in out], pa.schema([("kind", pa.string()), ("key", pa.string()), ("id", pa.int64()), ("n", pa.int64())]))

    for batch in batches:
        for word, n, id in zip(*(c.to_pylist() for c in batch.columns)):
            out.append(("word", f"{len(word)}-{_hash(word):x}", id, n))
            if len(word) == SPELT_OUT + 1:  # its deletions and groups are spelt out
                continue
            before = [0]
            for c in word:
                before.append((before[-1] * BASE + ord(c)) % PRIME)
            after, power = 0, 1  # of what follows place k
            for k in range(len(word) - 1, -1, -1):
                out.append(("wildcard", f"{len(word)}*{k}*{(before[k] * power * BASE + after) % PRIME:x}", id, n))
                if not k or word[k] != word[k - 1]:
                    out.append(("deletion", f"{len(word) - 1}-{(before[k] * power + after) % PRIME:x}", id, n))
                after, power = (after + ord(word[k]) * power) % PRIME, power * BASE % PRIME
                if len(out) >= 8192:
                    yield keyed()
                    out.clear()
    yield keyed()


def _keys(words: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(key, id, n) of wildcard groups, of deletions, and of the words themselves. No key is in two groups of any kind."""
    size, at = F.length("word"), F.col("at")
    short = words.where(size <= SPELT_OUT + 1).withColumn("at", F.explode(F.sequence(F.lit(1), size)))
    rest = F.substr("word", at + 1)
    wildcards = short.select(F.concat(F.substr("word", F.lit(1), at - 1), F.lit("*"), rest).alias("key"), "id", "n")
    first_of_equals = (at == 1) | (F.substr("word", at, F.lit(1)) != F.substr("word", at - 1, F.lit(1)))
    deletions = short.where(first_of_equals).select(F.concat(F.substr("word", F.lit(1), at - 1), rest).alias("key"), "id", "n")
    own = words.where(size <= SPELT_OUT).select(F.col("word").alias("key"), "id", "n")
    long = words.where(size > SPELT_OUT).select("word", "n", "id").mapInArrow(_long_keys, "kind string, key string, id bigint, n bigint")
    return tuple(
        spelt.unionByName(long.where(F.col("kind") == kind).select("key", "id", "n"))
        for spelt, kind in ((wildcards, "wildcard"), (deletions, "deletion"), (own, "word"))
    )


def near_words(words: DataFrame) -> DataFrame:
    """For every word that has near words (one code point inserted, deleted or replaced): how many, and the most frequent of them.

    Words that differ in place p alone lie in one group of (p, prefix, suffix), and two words share one such group at most. A group
    has KINDS words at the most, one for each letter; it is kept as its size and its two most frequent words, from which each
    member knows how many others there are and the best of these. Deletions join the vocabulary, which gives a
    word the deletion and the deletion the word; both sides are summed up without lists. Rows grow with the words' letters.

    ``words`` has word, n, id as ``vocabulary`` gives them. Returns id, n_near, best (n, minus its id).
    """
    ship(words.sparkSession)
    wildcards, deletions, own = _keys(words)
    group = Window.partitionBy("key").orderBy(F.desc("n"), "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    word = F.struct("n", (-F.col("id")).alias("order"))
    grouped = wildcards.select("id", F.count("*").over(group).alias("size"), F.first(word).over(group).alias("first"), F.nth_value(word, 2).over(group).alias("second"))
    replaced = grouped.where("size > 1").select(
        "id", (F.col("size") - 1).alias("n_near"), F.when(F.col("first.order") == -F.col("id"), F.col("second")).otherwise(F.col("first")).alias("best")
    )
    met = deletions.join(own.select("key", F.col("id").alias("shorter"), F.col("n").alias("shorter_n")), "key")
    both = F.array(
        F.struct("id", F.struct(F.col("shorter_n").alias("n"), (-F.col("shorter")).alias("order")).alias("best")),
        F.struct(F.col("shorter").alias("id"), word.alias("best")),
    )
    shifted = met.select(F.inline(both)).select("id", F.lit(1).cast("bigint").alias("n_near"), "best")
    return replaced.unionByName(shifted).groupBy("id").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """(id, form_id, root_id) of (id, form_id): forms are followed by doubling.

    Each step multiplies n by RATIO at least, from 2 on, so ``most``, the largest n, bounds the steps and with them the rounds.
    """
    steps = 0
    while 2 * RATIO ** (steps + 1) <= most:
        steps += 1
    found = forms.withColumn("root_id", F.col("form_id"))
    for _ in range(max(0, steps - 1).bit_length()):
        further = found.select(F.col("id").alias("root_id"), F.col("root_id").alias("further"))
        new = materialize(found.join(further, "root_id", "left").select("id", "form_id", F.coalesce("further", "root_id").alias("root_id")), "spelling-roots")
        discard(found)
        found = new
    return found


def group_variants(
    docs: DataFrame, min_length: int = 7, min_count: int = 2, slip_every: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every word of the corpus with the more frequent word that it is a variant of.

    A word's form is its near word of the largest n (ties: the smallest in code-point order) if that is RATIO times the word's n or more, else
    null. Its root is the last word on the way from form to form, itself if it has no form.

    Words, their occurrences and their near words cover all documents. Null and empty texts have no words; a null id
    counts as an empty one; repeated rows count again; texts are taken whole and words of any length take part (those of over
    ``SPELT_OUT`` letters by 127-bit hashes of their groups); other columns are ignored; no words give no rows.

    Returns word, form, root, n, n_near, form_n.
    """
    words = vocabulary(docs, min_length, min_count, slip_every, id_col, text_col)
    best = near_words(words)
    ranked = F.when(F.col("best.n") >= RATIO * F.col("n"), F.col("best"))
    found = materialize(
        words.join(best, "id", "left").select("word", "n", "id", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), (-ranked["order"]).alias("form_id"), ranked["n"].alias("form_n")),
        "spelling-forms",
    )
    discard(words)
    most = found.agg(F.max("n")).first()[0] or 0
    roots = _roots(found.where("form_id is not null").select("id", "form_id"), most)
    names = found.select("id", "word")
    named = (
        roots.join(names.toDF("form_id", "form"), "form_id").join(names.toDF("root_id", "root_word"), "root_id").select("id", "form", "root_word")
    )
    return found.join(named, "id", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
