"""Best-fit packing of tokenized documents into sequences of bounded length."""

from __future__ import annotations

import functools
import re
import string
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions.workers import releasing

from .common import materialize, packed, ship
from .token_counts import by_bytes, load_tokenizer, tokenizer_steps

#: Bins that one packing task keeps open, and pieces that one task packs.
OPEN_BINS = 1024
PIECES_PER_TASK = 65_536
#: Pieces that are looked at together: of these the longest go first. With 4096 about 0.01 % more
#: sequences are made than all ids need, without any look-ahead 0.9 %.
LOOK_AHEAD = 4096
#: Bytes of text that are taken apart at a time; a longer text is taken by itself.
CHUNK_BYTES = 4 << 20
#: Bytes of new words that the tokenizer gets at a time; what it makes of them takes about a hundred times as much.
NEW_BYTES = 256 << 10
#: Bytes of words and their ids that a worker remembers, about.
KNOWN_BYTES = 48 << 20
#: Texts made only of lines of words with single spaces between, all of plain
#: printable characters, can be cut before each space and around each line feed:
#: the byte-level pre-tokenizer cuts there too. Texts that have one of these are encoded whole.
IRREGULAR = ("\\A\\z", "\\A[\n ]", "[\n ]\\z", "[\n ][\n ]", "[^\n -~¡-ɏ]")
#: A token with a space before its word begins so in a byte-level vocabulary.
SPACE = "Ġ"
#: Behind a letter or digit, any of these at a word's end are together all of what the pre-tokenizer cuts there: with an apostrophe it takes only letters.
STOPS = string.punctuation
LETTER_OR_DIGIT = "[\\pL\\pN]"


class KnownWords:
    """Ids of words in Arrow arrays; once these take more than about ``limit`` bytes, what the words at hand don't have is forgotten."""

    def __init__(self, encode: Callable[[list[str]], list[pa.Array]], limit: int = KNOWN_BYTES):
        self.encode, self.limit = encode, limit
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())

    @property
    def size(self) -> int:
        return self.words.nbytes + self.ids.nbytes

    def __call__(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words, of which new ones are encoded."""
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(at.is_null())
        at = at.fill_null(-1).to_numpy(zero_copy_only=False).copy()
        at[at < 0] = np.arange(len(self.words), len(self.words) + len(new))
        self.ids = pa.concat_arrays([self.ids, *self.encode(new.to_pylist())])
        self.words = pa.concat_arrays([self.words, new])
        found = self.ids.take(pa.array(at))
        if self.size > self.limit:
            self.words, self.ids = words, found
            if self.size > self.limit // 2:  # very many or very long words
                self.words, self.ids = words[:0], found[:0]
        return found


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, by a byte-level BPE tokenizer.

    Arrow takes texts apart into words, distinct words are encoded once and all are looked up. A word here has
    the line feed before it, if that is what is before it, else the space before it is left out; a text begins like a line.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.bases, self.stops = KnownWords(self.words_together), KnownWords(self.stops_together)
        self.line_feed = self.whole("\n")
        added = self.tokenizer.get_added_tokens_decoder()
        # added tokens' strings: texts that have one are encoded whole
        self.mark = tuple(t.content for t in added.values())
        self.irregular = "|".join([*IRREGULAR, *map(re.escape, self.mark)])
        # only this pre-tokenizer, with nothing before it, is known to cut regular texts before spaces and around line feeds
        self.by_words = tokenizer_steps(path) == ([], ["ByteLevel"]) and len(self.line_feed) == 4 and not any(x in "".join(self.mark) for x in " \n")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.begins = np.zeros(1 + max(vocabulary.values()), bool)
        self.begins[[k for token, k in vocabulary.items() if token.startswith(SPACE) and k not in added]] = True
        self.begins[np.frombuffer(self.line_feed, "<u4")] = True

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words from one text, and where each word's begin: tokens with a space and line feeds tell them apart."""
        ids = self.encoded((" " + " ".join(words)).replace(" \n", "\n"))
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(words):
            raise ValueError("the tokenizer doesn't keep words apart")
        return ids, np.append(starts, len(ids))

    def words_together(self, words: list[str]) -> list[pa.Array]:
        made = [(len(batch), *self.together(batch)) for batch in by_bytes(words, NEW_BYTES)]
        return [pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((4 * at).astype("int32")), pa.py_buffer(ids)]) for n, ids, at in made]

    def stops_together(self, stops: list[str]) -> list[pa.Array]:
        """Ids of stops, each of them encoded as a line of its own."""
        made = [(ids.tobytes(), (4 * at).tolist()) for batch in by_bytes(stops, NEW_BYTES) for ids, at in [self.together(["\n" + x for x in batch])]]
        return [pa.array([data[x + len(self.line_feed) : y] for x, y in pairwise(at)], pa.binary()) for data, at in made]

    def distinct(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words. Those that end with stops are what is before these, which is encoded once, and the stops."""
        bases = pc.utf8_rtrim(words, STOPS)
        stopped = pc.and_(pc.less(pc.binary_length(bases), pc.binary_length(words)), pc.match_substring_regex(bases, LETTER_OR_DIGIT + "\\z"))
        bases = pc.if_else(stopped, bases, words).dictionary_encode()
        stops = pc.replace_substring_regex(words.filter(stopped), f"(?s)\\A.*{LETTER_OR_DIGIT}", "").dictionary_encode()
        ids = self.bases(bases.dictionary).take(bases.indices)
        more = self.stops(stops.dictionary).take(stops.indices)
        return pc.replace_with_mask(ids, stopped, pc.binary_join_element_wise(ids.filter(stopped), more, b""))

    def regular(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts that can be taken apart."""
        if not len(texts):
            return []
        lines = pc.replace_substring(pc.binary_join_element_wise("\n", texts, ""), "\n", " \n")
        words = pc.split_pattern(pc.utf8_slice_codeunits(lines, 1), " ")
        coded = words.flatten().dictionary_encode()
        ids = self.distinct(coded.dictionary).cast(pa.large_binary()).take(coded.indices)
        _, ends, data = ids.buffers()
        at = np.frombuffer(ends, "int64")[words.offsets.to_numpy()].tolist()
        data = memoryview(data or b"")
        return [bytes(data[x + len(self.line_feed) : y]) for x, y in pairwise(at)]

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        whole = pc.match_substring_regex(texts, self.irregular) if self.by_words else pa.repeat(True, len(texts))
        found = iter(self.regular(texts.filter(pc.invert(whole))))
        others = iter(texts.filter(whole).to_pylist())
        return [self.whole(next(others)) if x else next(found) for x in whole.to_pylist()]


@functools.lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Pieces (number, start, length, bytes): all of ``capacity`` ids but perhaps the first."""
    n = len(ids) // 4
    pieces = max(1, -(-n // capacity))
    start, length = 0, n - capacity * (pieces - 1)
    for k in range(pieces):
        yield k, start, length, ids[4 * start : 4 * (start + length)]
        start, length = start + length, capacity


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Where consecutive runs of about ``limit`` bytes begin and end; a longer text is a run of its own."""
    sizes = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype="int64")])
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + limit, "right")) - 1)
        yield start, end
        start = end


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encode, end = word_ids(path), np.array([end_id], "<u4").tobytes()
    for batch in batches:
        texts = batch.column(1).cast(pa.string()).fill_null("")
        for begin, stop in chunks(texts):
            rows = batch.slice(begin, stop - begin)
            out: list[list] = [[] for _ in range(6)]
            for doc, found in zip(rows.column(0).to_pylist(), encode(texts.slice(begin, stop - begin))):
                for k, start, length, ids in cut(found + end, capacity):
                    for column, value in zip(out, (doc, k, start, length, zlib.crc32(ids), ids if with_ids else None)):
                        column.append(value)
            arrays = [pa.array(x, t) for x, t in zip(out, (rows.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                flat = pa.array(np.frombuffer(b"".join(out[5]), "<u4").astype("int32"))
                arrays.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *out[3]]), pa.int32()), flat))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)


def document_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    with_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token ids of every document, with ``end_id`` last, cut into pieces of at most ``capacity`` ids.

    Only longer documents are cut; all pieces are full but perhaps the first. Returns
    doc_id, piece, start, length, ids_crc32 and, if asked for, ids (array<int>). Null
    text counts as empty and gives one piece with the end id alone.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return rows.mapInArrow(lambda batches: releasing(_pieces(batches, tokenizer_path, capacity, end_id, with_ids)), schema)


def best_fit(sizes: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int]]:
    """Bounded-space online best-fit: the bin and the offset in it of each size, in turn.

    Bit f of ``free`` is set while an open bin has f ids of free space, so the best
    fit for a size is the lowest set bit from it on. Where none fits and
    ``open_bins`` are open, the fullest closes; full bins close by themselves.
    """
    free, n_open, n_bins = 0, 0, 0
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    placed, offsets = [], []
    for size in sizes:
        if fits := free >> size:
            space = size + (fits & -fits).bit_length() - 1
            b = bins[space].pop()
            if not bins[space]:
                free ^= 1 << space
        else:
            if n_open == open_bins:
                fullest = (free & -free).bit_length() - 1
                bins[fullest].pop()
                if not bins[fullest]:
                    free ^= 1 << fullest
                n_open -= 1
            b, space = n_bins, capacity
            n_bins += 1
            n_open += 1
        placed.append(b)
        offsets.append(capacity - space)
        if space := space - size:
            bins[space].append(b)
            free |= 1 << space
        else:
            n_open -= 1
    return placed, offsets


def _pack(rows: pa.Table, capacity: int, open_bins: int, look_ahead: int) -> pa.Table:
    part = rows.column("part")[0].as_py()
    rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32", "length")]).drop_columns("part")
    lengths = rows.column("length").to_numpy()
    rows = rows.take(pa.array(np.lexsort((-lengths, np.arange(len(lengths)) // look_ahead))))
    placed, offsets = best_fit(rows.column("length").to_pylist(), capacity, open_bins)
    rows = rows.append_column("sequence_id", pa.array(np.array(placed, "int64") + (part << 32)))
    return rows.append_column("offset", pa.array(offsets, pa.int64()))


def pack_pieces(
    pieces: DataFrame, capacity: int = 2048, open_bins: int = OPEN_BINS, pieces_per_task: int = PIECES_PER_TASK, look_ahead: int = LOOK_AHEAD
) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32).

    Pieces are dealt by a hash of their content to groups of about
    ``pieces_per_task``, each packed by itself in order of doc_id and piece, but for the
    longest of each ``look_ahead`` pieces going first. What a group's last open bins
    leave free is little beside its other bins and doesn't grow with the input. The result
    depends on the pieces alone, not on how they were partitioned.
    """
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = materialize(pieces.select(*columns), "packing-pieces")
    parts = packed(pieces.count(), pieces_per_task)
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    kind = pieces.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return dealt.groupBy("part").applyInArrow(lambda rows: _pack(rows, capacity, open_bins, look_ahead), schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    open_bins: int = OPEN_BINS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids.

    Returns per piece doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    Null text counts as empty, rows with equal or null ids are all packed, texts of
    any length are cut, an empty table gives no rows. Other columns are ignored.
    """
    pieces = document_pieces(docs, tokenizer_path, capacity, end_id, False, id_col, text_col)
    return pack_pieces(pieces, capacity, open_bins)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, doc_ids, offsets and ids.

    ``pieces`` are those of document_pieces with ids, ``placed`` what pack_pieces
    returned for them. doc_id must be unique for this. A sequence holds at most
    ``capacity`` ids, so its group is bounded.
    """
    key = ["doc_id", "piece"]
    joined = placed.join(pieces.select(*key, "ids"), key)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return (
        joined.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
        .select(
            "sequence_id", "length", F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"),
            F.flatten(F.col("parts.ids")).alias("ids"),
        )
    )
