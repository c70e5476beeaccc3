"""SentencePiece encoding by streaming Viterbi, for unigram and for BPE models, and decoding.

A text is segmented from left to right: each boundary keeps a pointer to the boundary before. Only the
boundaries of the last ``longest`` characters can still be extended; once the pointers of all of
these lead back to one boundary, all before it is settled and is given out.

In a unigram model the best segmentation is the one whose pieces' scores have the largest sum. A BPE model's scores
are the order of its merges, and no sum of them says how a text is cut. There a piece may follow another only if
merging the two pieces' characters by themselves gives just these two. Merges of one place don't change what is
done at another, so a segmentation all of whose neighbours are such pairs is the one that merging the whole text
gives, and the only one: every boundary has just one piece that may end there.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory, ship

SPACE = "▁"
#: Unknown characters score this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Pairs of pieces of which a worker keeps whether they may be neighbours, and bytes of words' ids it keeps.
KNOWN_PAIRS = 600_000
KNOWN_BYTES = 160 << 20


class Vocabulary:
    """Pieces, scores and kinds of a SentencePiece model, taken as they are."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that leave texts as they are, but for spaces, are supported")
        self.prefix = rules.add_dummy_prefix
        self.merges = model.trainer_spec.model_type == model.trainer_spec.BPE
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte: dict[int, int] = {}
        self.unknown = 0
        self.raw: list[bytes] = []
        for k, p in enumerate(model.pieces):
            raw = p.piece.replace(SPACE, " ").encode()
            if p.type == kinds.BYTE:
                raw = bytes([int(p.piece[3:5], 16)])
                self.byte[raw[0]] = k
            elif p.type == kinds.UNKNOWN:
                self.unknown, raw = k, " ⁇ ".encode()
            elif p.type == kinds.CONTROL:
                raw = b""
            else:
                if self.merges and p.type != kinds.NORMAL:
                    raise ValueError("BPE models with pieces of a user's own or unused ones aren't supported")
                self.score[p.piece], self.id[p.piece] = p.score, k
            self.raw.append(raw)
        self.longest = max(map(len, self.score))
        self.matches = ahocorasick.Automaton()  # all pieces that end at a place, the longest first
        for piece, score in self.score.items():
            self.matches.add_word(piece, (len(piece), score, self.id[piece]))
        self.matches.make_automaton()
        self.unknown_score = min(self.score.values()) - UNKNOWN_PENALTY
        joined = {c for p in self.score if len(p) > 1 for c in p} - {SPACE}
        # where no piece can reach across, all paths meet: before a space sign, if pieces have it
        # at their start alone, and around characters that are in no longer piece
        self.spaces_lead = all(SPACE not in p.lstrip(SPACE) for p in self.score)
        some = "".join(map(re.escape, sorted(joined)))
        self.stretch = re.compile(f"{SPACE}+[{some}]*|[{some}]+|." if self.spaces_lead else f"[{SPACE}{some}]+|.", re.DOTALL)

    def normalize(self, text: str) -> str:
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def ids_of(self, piece: str) -> list[int]:
        if piece in self.id:
            return [self.id[piece]]
        if self.byte:
            return [self.byte[b] for b in piece.encode()]
        return [self.unknown]


class StreamingViterbi:
    """Segments text that comes in parts; feed() and finish() give the pieces that are settled.

    What is held: the characters and boundaries since the last one where all
    surviving paths met, and for the search itself the last ``longest`` boundaries.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.text = ""
        self.best = [0.0]
        self.back = [-1]

    def feed(self, text: str) -> list[str]:
        v, scores, matches = self.v, self.v.score, self.v.matches.iter
        out: list[str] = []
        for at in range(0, len(text), v.longest):
            done = len(self.text)
            self.text += text[at : at + v.longest]
            held, best, back = self.text, self.best, self.back
            # pieces that end in the new part may begin in the old one
            context = max(0, done - v.longest + 1)
            for last, (length, score, _) in matches(held[context:]):
                if (end := context + last + 1) > done:
                    while len(best) <= end:
                        self.open_boundary(held, best, back, scores)
                    if (score := score + best[end - length]) > best[end]:
                        best[end], back[end] = score, end - length
            while len(best) <= len(held):
                self.open_boundary(held, best, back, scores)
            if len(held) > 2 * v.longest:
                out += self.settle()
        return out

    def open_boundary(self, held: str, best: list[float], back: list[int], scores: dict[str, float]) -> None:
        """The next boundary, reached so far by an unknown character at most."""
        last = len(best) - 1
        known = held[last] in scores
        best.append(float("-inf") if known else self.v.unknown_score + best[last])
        back.append(-1 if known else last)

    def settle(self) -> list[str]:
        """Give out what lies before the boundary at which all surviving paths meet."""
        back = self.back
        last = len(back) - 1
        paths = set(range(max(0, last - self.v.longest + 1), last + 1))
        while len(paths) > 1:
            far = max(paths)
            paths.remove(far)
            paths.add(back[far])
        meet = paths.pop()
        if meet <= 0:
            return []
        out = self.pieces_to(meet)
        base = self.best[meet]
        self.text = self.text[meet:]
        self.best = [b - base for b in self.best[meet:]]
        self.back = [b - meet for b in back[meet:]]
        return out

    def pieces_to(self, end: int) -> list[str]:
        out = []
        while end > 0:
            start = self.back[end]
            out.append(self.text[start:end])
            end = start
        return out[::-1]

    def finish(self) -> list[str]:
        out = self.pieces_to(len(self.back) - 1)
        self.text, self.best, self.back = "", [0.0], [-1]
        return out


class Encoder:
    """Ids of texts. What lies between boundaries that no piece crosses is segmented once and kept.

    Such boundaries are before single spaces and around line feeds, so most texts are looked
    up word by word; the others, with runs of spaces, stretch by stretch.
    """

    def __init__(self, path: str, merges: bool):
        self.v = vocabulary(path)
        self.known = Memory()  # by stretch or word, with its space sign
        self.spaced = Memory(KNOWN_BYTES)  # by word, of the word with a space sign before it
        self.search = (StreamingPairs if merges else StreamingViterbi)(self.v)
        self.by_words = self.v.spaces_lead and self.v.prefix and self.v.stretch.findall("a\na") == ["a", "\n", "a"]
        self.line_feed = self.ids("\n")

    def ids(self, stretch: str) -> bytes:
        pieces = self.search.feed(stretch) + self.search.finish()
        return np.array([i for p in pieces for i in self.v.ids_of(p)], "<i4").tobytes()

    def stretches(self, text: str) -> list[bytes]:
        found = self.v.stretch.findall(text)
        for s in found:
            if s not in self.known:
                self.known.learn(s, self.ids(s))
        return list(map(self.known.__getitem__, found))

    def learn(self, known: Memory, words: list[str], lead: str) -> None:
        for w in words:
            known.learn(w, self.ids(lead + w))

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [[line.split(" ") for line in x.split("\n")] if self.by_words and x and x[0] != " " and "  " not in x and SPACE not in x else None for x in texts]
        bare = {line[0] for x in split if x for line in x[1:]}
        led = set().union(*(line[1:] for x in split if x for line in x), (x[0][0] for x in split if x))
        for known, words, lead in ((self.known, bare, ""), (self.spaced, led, SPACE)):
            known.room(words)
            self.learn(known, known.new(words), lead)
        out, get, known, spaced = [], self.spaced.__getitem__, self.known, self.spaced
        for text, x in zip(texts, split):
            if x is None:
                out.append(b"".join(self.stretches(self.v.normalize(text))))
            else:
                # the text's first word has a space sign before it as well, other lines' first words have none
                first = spaced[x[0][0]] + b"".join(map(get, x[0][1:]))
                out.append(self.line_feed.join([first, *(known[line[0]] + b"".join(map(get, line[1:])) for line in x[1:])]))
        return out


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """Pieces by merges: again and again the pair of neighbours whose piece has the best score, of equals the first one."""
    pieces: list[str | None] = list(text)
    n = len(pieces)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(-scores[p], k, k + 1, p) for k in range(n - 1) if (p := text[k : k + 2]) in scores]
    heapq.heapify(heap)
    while heap:
        _, a, b, piece = heapq.heappop(heap)
        x, y = pieces[a], pieces[b]
        if x is None or y is None or after[a] != b or len(x) + len(y) != len(piece):
            continue  # one of the pair has been merged since
        pieces[a], pieces[b] = piece, None
        after[a] = c = after[b]
        if c < n:
            before[c] = a
            if (p := piece + pieces[c]) in scores:
                heapq.heappush(heap, (-scores[p], a, c, p))
        if (c := before[a]) >= 0 and (p := pieces[c] + piece) in scores:
            heapq.heappush(heap, (-scores[p], c, a, p))
    return [p for p in pieces if p is not None]


class StreamingPairs(StreamingViterbi):
    """The search for a BPE model: an edge counts if its piece may follow the one that ends where it begins."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary)
        self.last = ""  # the piece that was given out last
        self.ends = [-1]  # at each boundary the id of the piece that ends there, below 0 at a text's start and after unknown characters
        self.pairs: dict[int, bool] = {}

    def learn(self, pair: int, before: str, piece: str) -> bool:
        """Whether ``piece`` may follow ``before``, which is "" where nothing is that it could be merged with."""
        found = self.pairs[pair] = merged(before + piece, self.v.score) == ([before, piece] if before else [piece])
        return found

    def feed(self, text: str) -> list[str]:
        v, matches = self.v, self.v.matches.iter
        out: list[str] = []
        if len(self.pairs) > KNOWN_PAIRS:
            self.pairs.clear()
        known = self.pairs.get
        for at in range(0, len(text), v.longest):
            done = len(self.text)
            self.text += text[at : at + v.longest]
            held, back, ends = self.text, self.back, self.ends
            # a character that no piece has is merged with nothing and may follow anything
            back += [-1 if c in v.score else k for k, c in enumerate(held[done:], done)]
            ends += [-1] * (len(held) - done)
            # pieces that end in the new part may begin in the old one
            for last, (length, _, piece) in matches(held, max(0, done - v.longest + 1)):
                if last >= done and back[last + 1] < 0:
                    start = last + 1 - length
                    before = ends[start]
                    pair = before << 24 | piece
                    fits = known(pair)
                    if fits is None:
                        fits = self.learn(pair, "" if before < 0 else self.last if not start else held[back[start] : start], held[start : last + 1])
                    if fits:
                        back[last + 1], ends[last + 1] = start, piece
            if len(held) > 2 * v.longest:
                out += self.settle()
        return out

    def settle(self) -> list[str]:
        self.best = self.back  # there are no sums
        out = super().settle()
        if out:
            self.last, self.ends = out[-1], self.ends[-len(self.back) :]
        return out

    def finish(self) -> list[str]:
        out = super().finish()
        self.last, self.ends = "", [-1]
        return out


@functools.lru_cache(maxsize=4)
def encoder(path: str, merges: bool | None = None) -> Encoder:
    """By sums of scores or by merges; by default as the model's type says."""
    return Encoder(path, vocabulary(path).merges if merges is None else merges)


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def decode_ids(v: Vocabulary, ids: np.ndarray) -> str:
    text = b"".join(map(v.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text[1:] if v.prefix and text.startswith(" ") else text


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """The column "text" becomes "ids"; it is the last."""
    encode = encoder(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            found = encode([x or "" for x in rows.column("text").to_pylist()])
            ends = np.cumsum([0, *map(len, found)]) // 4
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], ids], [*rows.schema.names[:-1], "ids"])


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    v = vocabulary(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            ids = rows.column("ids")
            texts = [decode_ids(v, x.values.to_numpy()) if x.is_valid else None for x in ids]
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(texts, pa.string())], [*rows.schema.names[:-1], "text"])


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, the columns in ``keep``, and ids (array<int>) of every whole text.

    A BPE model's segmentation is that of its merges, found by the pairs of pieces that may be neighbours; a
    unigram model's has the largest sum of piece scores, and among equals longer last pieces win. Spaces are written as the model does, with one before the text if
    the model says so. Characters that no piece has become the ids of their bytes. Null and
    empty texts have no ids; null ids, ties and repeated rows are kept; an empty table gives no
    rows. A text is never cut: what is held beside it is a window.
    """
    ship(docs.sparkSession)
    keep = keep or []
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).cast("string").alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(lambda batches: _encode(batches, model_path), f"{kinds}, ids array<int>")


def decode_texts(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """doc_id, the columns in ``keep``, and the text of each row's ids; null ids give a null text, no ids an empty one.

    Bytes that make up no character become U+FFFD.
    """
    ship(encoded.sparkSession)
    keep = keep or []
    rows = encoded.select(F.col(id_col).alias("doc_id"), *keep, F.col(ids_col).cast("array<int>").alias("ids"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(lambda batches: _decode(batches, model_path), f"{kinds}, text string")


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode it again: doc_id, n_ids, ids_hash, text_crc32, decoded_crc32, same.

    ``same`` is false only where a text has the sign that stands for a space, which comes back as a space.
    """
    marked = docs.select(
        F.col(id_col).alias("doc_id"), F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"), F.col(text_col).alias("text")
    )
    encoded = encode_texts(marked, model_path, keep=["text_crc32"])
    counted = encoded.select("doc_id", F.col("text_crc32"), F.size("ids").cast("bigint").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), "ids")
    decoded = decode_texts(counted, model_path, keep=["text_crc32", "n_ids", "ids_hash"])
    back = F.crc32(F.col("text").cast("binary"))
    return decoded.select("doc_id", "n_ids", "ids_hash", "text_crc32", back.alias("decoded_crc32"), (back == F.col("text_crc32")).alias("same"))
