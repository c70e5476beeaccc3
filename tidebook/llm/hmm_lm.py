"""A hidden Markov language model: Baum-Welch training and exact likelihoods by the scaled forward recursion.

A state emits a word class, and the class its word: P(w | state) = P(class | state) * P(w | class).
The most frequent words are classes of their own, the others share a class with words
that end alike, and the end of a text has a class to itself. Within a class a word has
(c + 0.5) / (N + 0.5 * (V + 1)), with c its training count, N the class's tokens and V its
distinct words; the share left over is that of a word never seen. So states and classes are
of bounded number, while counts of all words of the corpus take part.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, held_out, materialize, packed, ship

#: Model size: hidden states, words that are classes of their own, classes of word endings and their letters.
STATES = 8
OWN_CLASSES = 8192
ENDING_CLASSES = 4096
ENDING_LETTERS = 3
#: Rounds of Baum-Welch, documents computed at once, and tokens at once; beyond these, segments of so many tokens of each at least.
ROUNDS = 5
DOCUMENTS_AT_ONCE = 4096
TOKENS_AT_ONCE = 1 << 17
SEGMENT = 64
#: States are scaled at every so many tokens: by then probabilities of 1e-20 a token are still far from underflow.
SCALE_EVERY = 8
#: A block of documents is closed at so many distinct words or bytes of text.
BLOCK_WORDS = 1_000_000
BLOCK_BYTES = 8 << 20
#: Rows whose words are told apart at once.
BLOCK_ROWS = 256
#: The most frequent words, those with a class of their own among them, of so many bytes at most each: they are broadcast.
COMMON_WORDS = 65_536
COMMON_BYTES = 48
#: Counts within this ratio are taken for alike where the most frequent words are chosen.
LEVEL = 1.05
#: Parts of a hash's range among which words of one count are chosen.
HASH_PARTS = 4096
#: Words of blocks, and blocks, that one task of a shuffle has, about.
WORDS_PER_TASK = 2_000_000
BLOCKS_PER_TASK = 4

END = ""  # no word is empty

BLOCK = pa.schema([
    ("block", pa.int64()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())),
    ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())), ("codes", pa.binary()),
])
BLOCK_SQL = "block bigint, words array<string>, counts array<bigint>, doc_ids array<bigint>, held array<boolean>, lengths array<bigint>, codes binary"


# --- documents as blocks of word numbers ----------------------------------------


class Block:
    """Documents as numbers of words in a vocabulary of their own."""

    def __init__(self):
        self.rows: list[pa.RecordBatch] = []
        self.lengths: list[np.ndarray] = []
        self.codes: list[np.ndarray] = []
        self.words: list[pa.Array] = []
        self.n_words = self.size = 0  # words that several batches have count in each

    def add(self, rows: pa.RecordBatch) -> None:
        """Rows of id, whether held out, and text."""
        texts = pc.ascii_trim_whitespace(pc.fill_null(rows.column(2).cast(pa.string()), ""))
        # a space behind its last word gives a text an empty one, its end; an empty text is that already
        texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(pc.ascii_lower(texts), "", " "))
        words = pc.ascii_split_whitespace(texts)
        found = words.flatten().dictionary_encode()
        self.rows.append(rows.select([0, 1]))
        self.lengths.append(pc.list_value_length(words).to_numpy().astype("int64"))
        self.codes.append(found.indices.to_numpy() + sum(map(len, self.words)))
        self.words.append(found.dictionary)
        self.n_words += len(found.dictionary)

    def row(self, name: int) -> pa.RecordBatch:
        found = pa.concat_arrays(self.words).dictionary_encode()
        codes = found.indices.to_numpy()[np.concatenate(self.codes)]
        docs, held = (pa.concat_arrays([r.column(c) for r in self.rows]) for c in (0, 1))
        lengths = np.concatenate(self.lengths)
        trains = np.repeat(~held.to_numpy(zero_copy_only=False), lengths)
        counts = np.bincount(codes[trains], minlength=len(found.dictionary))
        lists = [found.dictionary, pa.array(counts, pa.int64()), docs, held, pa.array(lengths)]
        lists = [pa.ListArray.from_arrays([0, len(x)], x) for x in lists]
        return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), *lists, pa.array([squeezed(codes)], pa.binary())], schema=BLOCK)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, name = Block(), TaskContext.get().partitionId() << 33
    for batch in batches:
        ends, at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(), dtype="int64"), 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            stop = min(int(np.searchsorted(ends, done + BLOCK_BYTES - block.size)) + 1, at + BLOCK_ROWS, batch.num_rows)
            block.add(batch.slice(at, stop - at))
            block.size += int(ends[stop - 1]) - done
            at = stop
            if block.n_words >= BLOCK_WORDS or block.size >= BLOCK_BYTES:
                yield block.row(name)
                block, name = Block(), name + 1
    if block.rows:
        yield block.row(name)


def squeezed(codes: np.ndarray) -> bytes:
    """Numbers as compressed bytes: their lowest bytes, then the next, and so on."""
    planes = np.ascontiguousarray(codes.astype("<u4").view("u1").reshape(-1, 4).T)
    return len(codes).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def code_array(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=4 * n, codec="zstd", asbytes=True), "u1").reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


# --- the model ------------------------------------------------------------------


def class_of(word: Column, own: Column, n_own: int) -> Column:
    """A word's class: 0 the end, then the words with a class of their own (``own``, else null), then endings."""
    ending = F.pmod(F.xxhash64(F.right(word, F.lit(ENDING_LETTERS))), F.lit(ENDING_CLASSES)) + 1 + n_own
    return F.when(word == END, 0).otherwise(F.coalesce(own, ending)).cast("int")


class Model:
    """Start, transition and emission probabilities: start (S), move (S x S), emit (S x classes)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @cached_property
    def by_class(self) -> np.ndarray:
        """Emission probabilities, a row for each class."""
        return np.ascontiguousarray(self.emit.T)

    @classmethod
    def first(cls, totals: np.ndarray, states: int, seed: int = 7) -> Model:
        """Sticky states that emit classes by their totals, each with its own disturbance."""
        draw = np.random.default_rng(seed)
        emit = (totals + 1.0)[None, :] * np.exp(draw.normal(0, 0.7, (states, len(totals))))
        move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True))

    @classmethod
    def of_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, totals: np.ndarray) -> Model:
        """The next round's model from expected counts, with a trace of the corpus's own shares."""
        prior = (totals + 1.0) / (totals + 1.0).sum()
        start, move, emit = start + 1e-3, move + 1e-3, emit + 10.0 * prior[None, :]
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


class Room:
    """Arrays that are used again: new ones of their size are paid for page by page."""

    def __init__(self):
        self.arrays: dict[str, np.ndarray] = {}

    def array(self, name: str, rows: int, states: int) -> np.ndarray:
        held = self.arrays.get(name)
        if held is None or len(held) < rows or held.shape[1] != states:
            held = self.arrays[name] = np.empty((rows, states))
        return held[:rows]


def segments(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The first step of each segment, and how many documents (the longest come first) are going at each of its steps."""
    going = np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(lengths) else 0))
    ends, at = np.cumsum(going), 0
    while at < len(going):
        most = (int(ends[at - 1]) if at else 0) + TOKENS_AT_ONCE
        stop = min(max(int(np.searchsorted(ends, most, side="right")), at + SEGMENT), len(going))
        yield at, going[at:stop]
        at = stop


def laid(obs: np.ndarray, starts: np.ndarray, first: int, going: np.ndarray) -> np.ndarray:
    """The classes of a segment step by step: at each step those of the documents still going, which are always the first ones."""
    cuts = np.cumsum(going) - going
    document = np.arange(int(going.sum())) - np.repeat(cuts, going)
    return obs[starts[document] + np.repeat(first + np.arange(len(going)), going)]


def forwards(
    model: Model, codes: np.ndarray, going: np.ndarray, before: np.ndarray | None, room: Room
) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray], list[int]]:
    """Emission probabilities and forward states of a segment (a row a token), the scales of the steps that have them, and where steps begin.

    ``before`` is the scaled forward state at the end of the segment before, None where documents
    start. The last step is always scaled.
    """
    states = len(model.start)
    likely, alpha = (room.array(name, len(codes), states) for name in ("likely", "alpha"))
    model.by_class.take(codes, axis=0, out=likely, mode="clip")
    cuts, last, old, move, scales = [0, *np.cumsum(going).tolist()], len(going) - 1, before, np.ascontiguousarray(model.move), {}
    dot, multiply = np.dot, np.multiply
    for t, (a, b) in enumerate(zip(cuts, cuts[1:])):
        now, here = alpha[a:b], likely[a:b]
        if old is None:
            multiply(here, model.start, now)
        else:
            dot(old[: b - a], move, now)
            multiply(now, here, now)
        if t % SCALE_EVERY == SCALE_EVERY - 1 or t == last:
            scales[t] = now.sum(axis=1, keepdims=True)
            now /= scales[t]
        old = now
    return likely, alpha, scales, cuts


def last_places(cuts: list[int], going: np.ndarray, stay: int) -> np.ndarray:
    """Where in a segment's rows the documents end that don't go on behind it (``stay`` do), in their order."""
    return np.repeat(cuts[:-1], -np.diff(going, append=stay))[::-1] + np.arange(stay, int(going[0]))


def segment_counts(
    model: Model, codes: np.ndarray, going: np.ndarray, before: np.ndarray | None, after: np.ndarray, room: Room
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, np.ndarray | None]:
    """Start, transition and emission counts of a segment, its log likelihood, and the scaled backward state at the end of the segment before.

    ``before`` is as in ``forwards``; ``after`` is the scaled backward state at the segment's end of the documents that go on behind it.
    """
    likely, alpha, scales, cuts = forwards(model, codes, going, before, room)
    states, classes = model.emit.shape
    beta = room.array("beta", len(codes), states)
    n, stay = int(going[0]), len(after)
    places = last_places(cuts, going, stay)
    left = alpha[places].sum(axis=1, keepdims=True)  # of documents that end, since their last scale
    ll = float(np.log(left).sum() + sum(np.log(s).sum() for s in scales.values()))
    beta[places] = 1 / left
    beta[cuts[-2] : cuts[-2] + stay] = after
    backwards, dot, multiply = np.ascontiguousarray(model.move.T), np.dot, np.multiply
    for t in range(len(going) - 1, -1, -1):
        a, b = cuts[t], cuts[t + 1]
        ahead = likely[a:b]
        multiply(ahead, beta[a:b], ahead)
        if t in scales:
            ahead /= scales[t]
        if t:
            past = cuts[t - 1]
            dot(ahead, backwards, beta[past : past + b - a])
    # transitions: a token's row and the next one's lie as far apart as documents are going, until some end
    move = np.zeros((states, states)) if before is None else before[:n].T @ likely[:n]
    turns = [0, *(np.flatnonzero(np.diff(going)) + 1).tolist(), len(going)]
    for t, end in zip(turns, turns[1:]):
        a, b, z = cuts[t], cuts[t + 1], cuts[end]
        if t:
            past = cuts[t - 1]
            move += alpha[past : past + b - a].T @ likely[a:b]
        move += alpha[a : z - (b - a)].T @ likely[b:z]
    multiply(alpha, beta, alpha)
    emit = np.stack([np.bincount(codes, weights=alpha[:, s], minlength=classes) for s in range(states)])
    start = alpha[:n].sum(axis=0) if before is None else np.zeros(states)
    return start, move * model.move, emit, ll, None if before is None else likely[:n] @ backwards


def document_counts(
    model: Model, obs: np.ndarray, starts: np.ndarray, lengths: np.ndarray, room: Room | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Counts and log likelihood of whole documents, which lie in ``obs``, the longest first.

    They are computed together, step by step. What is too much at once is computed segment by segment,
    and states are carried over the cuts: forward states at the cuts first, then from the last segment
    to the first what lies between.
    """
    room = room or Room()
    parts = list(segments(lengths))
    before: list[np.ndarray | None] = [None]
    for first, going in parts[:-1]:
        _, alpha, _, cuts = forwards(model, laid(obs, starts, first, going), going, before[-1], room)
        before.append(alpha[cuts[-2] :].copy())
    states, classes = model.emit.shape
    start, move, emit, ll, after = np.zeros(states), np.zeros((states, states)), np.zeros((states, classes)), 0.0, np.ones((0, states))
    for (first, going), state in zip(reversed(parts), reversed(before)):
        a, b, c, d, after = segment_counts(model, laid(obs, starts, first, going), going, state, after, room)
        start, move, emit, ll = start + a, move + b, emit + c, ll + d
    return start, move, emit, ll


def expected_counts(model: Model, obs: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One E-step over sequences (rows of ``obs``, each of ``lengths`` classes): start, transition and emission counts, and log likelihood."""
    order = np.argsort(-lengths, kind="stable")
    return document_counts(model, obs.ravel(), order * obs.shape[1], lengths[order])


def at_once(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of documents to be computed together."""
    ends, at = np.cumsum(lengths), 0
    while at < len(lengths):
        most = (int(ends[at - 1]) if at else 0) + TOKENS_AT_ONCE
        stop = min(max(int(np.searchsorted(ends, most, side="right")), at + 1), at + DOCUMENTS_AT_ONCE)
        yield at, stop
        at = stop


def _e_step(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    start = np.zeros(len(model.start))
    move, emit, ll, room = np.zeros_like(model.move), np.zeros_like(model.emit), 0.0, Room()
    for batch in batches:
        for row, (held, lengths, codes) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("held", "lengths", "codes")))):
            obs = batch.column("kinds")[row].values.to_numpy()[code_array(codes)]
            lengths, trains = np.array(lengths), ~np.array(held)
            starts, sizes = (np.cumsum(lengths) - lengths)[trains], lengths[trains]
            order = np.argsort(-sizes, kind="stable")
            starts, sizes = starts[order], sizes[order]
            for at, stop in at_once(sizes):
                a, b, c, d = document_counts(model, obs, starts[at:stop], sizes[at:stop], room)
                start, move, emit, ll = start + a, move + b, emit + c, ll + d
    # (kind, state, place, value), zeros left out
    parts = [(0, start[None, :]), (1, move), (2, emit), (3, np.array([[ll]]))]
    for kind, values in parts:
        i, j = np.nonzero(values)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(i), kind, "int32")), pa.array(i.astype("int32")), pa.array(j.astype("int32")), pa.array(values[i, j])],
            ["kind", "state", "place", "value"],
        )


def train(coded: DataFrame, totals: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """Baum-Welch over all training documents; the model and each round's log likelihood.

    Each task adds up the expected counts of its blocks; Spark sums them over tasks. What
    comes to the driver is one number for each state and class, however large the corpus.
    """
    model, likelihoods = Model.first(totals, states), []
    columns = coded.select("kinds", "held", "lengths", "codes")
    for _ in range(rounds):
        found = columns.mapInArrow(lambda b, m=model: _e_step(b, m), "kind int, state int, place int, value double")
        summed = found.groupBy("kind", "state", "place").agg(F.sum("value").alias("value")).toArrow()
        kind, i, j, value = (summed.column(c).to_numpy() for c in ("kind", "state", "place", "value"))
        start, move, emit, ll = np.zeros((1, states)), np.zeros((states, states)), np.zeros((states, len(totals))), np.zeros((1, 1))
        for k, into in enumerate((start, move, emit, ll)):
            of = kind == k
            into[i[of], j[of]] = value[of]
        likelihoods.append(float(ll[0, 0]))
        model = Model.of_counts(start[0], move, emit, totals)
    return model, likelihoods


def forward(model: Model, obs: np.ndarray, lengths: np.ndarray, room: Room | None = None) -> np.ndarray:
    """log10 likelihood of each sequence of classes, all laid end to end in ``obs``, by the scaled forward recursion.

    Sequences go along together as documents do in training, the longest first.
    """
    order, room = np.argsort(-lengths, kind="stable"), room or Room()
    starts, sizes = (np.cumsum(lengths) - lengths)[order], lengths[order]
    found = np.zeros(len(sizes))
    for at, stop in at_once(sizes):
        out, before, parts = found[at:stop], None, list(segments(sizes[at:stop]))
        for k, (first, going) in enumerate(parts):
            _, alpha, scales, cuts = forwards(model, laid(obs, starts[at:stop], first, going), going, before, room)
            for t, scale in scales.items():
                out[: going[t]] += np.log10(scale[:, 0])
            stay = int(parts[k + 1][1][0]) if k + 1 < len(parts) else 0
            out[stay : going[0]] += np.log10(alpha[last_places(cuts, going, stay)].sum(axis=1))
            before = alpha[cuts[-2] :].copy()
    result = np.empty(len(lengths))
    result[order] = found
    return result


class Shares:
    """What is known of training words: totals, and tokens and distinct words of each class."""

    def __init__(self, tokens: int, distinct: int, class_tokens: np.ndarray, class_words: np.ndarray):
        self.tokens, self.distinct, self.class_tokens, self.class_words = tokens, distinct, class_tokens, class_words


def _score(batches: Iterator[pa.RecordBatch], model: Model, shares: Shares, first_ending: int) -> Iterator[pa.RecordBatch]:
    room = Room()
    for batch in batches:
        for row, (docs, held, lengths, codes) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_ids", "held", "lengths", "codes")))):
            kind, c = (batch.column(name)[row].values.to_numpy() for name in ("kinds", "counts"))
            base = np.log10((c + 0.5) / (shares.tokens + 0.5 * (shares.distinct + 1)))
            # one word is all there is of a class of its own
            within = np.where(kind < first_ending, 0.0, np.log10((c + 0.5) / (shares.class_tokens[kind] + 0.5 * (shares.class_words[kind] + 1))))
            codes, lengths = code_array(codes), np.array(lengths)
            cuts = np.cumsum(lengths) - lengths
            yield pa.RecordBatch.from_arrays([
                pa.array(docs, pa.int64()), pa.array(held), pa.array(lengths),
                pa.array(np.add.reduceat((c > 0)[codes].astype("int64"), cuts)),
                pa.array(np.add.reduceat(base[codes], cuts)),
                pa.array(forward(model, kind[codes], lengths, room) + np.add.reduceat(within[codes], cuts)),
            ], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def most_frequent(vocabulary: DataFrame, most: int) -> list[tuple[str, int]]:
    """(word, count) of the ``most`` most frequent words but long ones, by count and then by a hash of the word.

    Where to cut is found from how many words each level of counts has, then each count of the level that doesn't fit, then each part of the
    hash's range for the count that doesn't: so that no task and not the driver gets more than these words and the last part's;
    a sort with a limit would bring ``most`` from each task.
    """
    short = vocabulary.where((F.col("word") != END) & (F.octet_length("word") <= COMMON_BYTES))
    level = F.floor(F.log(F.col("c").cast("double")) / math.log(LEVEL))
    part = F.pmod(F.xxhash64("word"), F.lit(HASH_PARTS))
    rows, taken, room = short, short.limit(0), most
    for key, largest_first in ((level, True), (F.col("c"), True), (part, False)):
        sizes = sorted(((r["key"], r["n"]) for r in rows.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=largest_first)
        fit = 0
        while fit < len(sizes) and sizes[fit][1] <= room:
            room -= sizes[fit][1]
            fit += 1
        if fit:
            last = sizes[fit - 1][0]
            taken = taken.unionByName(rows.where(key >= last if largest_first else key <= last))
        if fit == len(sizes) or not room:
            room = 0
            break
        rows = rows.where(key == sizes[fit][0])
    found = [(r["word"], r["c"], r["h"]) for r in (taken.unionByName(rows) if room else taken).select("word", "c", F.xxhash64("word").alias("h")).collect()]
    chosen = sorted(found, key=lambda x: (-x[1], x[2] % HASH_PARTS, x[2], x[0]))[:most]
    return sorted(((w, c) for w, c, _ in chosen), key=lambda x: (-x[1], x[0]))


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fold: int = 5,
    states: int = STATES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Score every whole text by a hidden Markov model learnt from all texts that aren't held out.

    Held out are rows with crc32(id as text) mod ``fold`` equal to 1. Texts are lower-cased
    (A-Z) and cut into words, with one end after them. Documents are gathered into blocks
    with a vocabulary of their own, so that words meet their corpus counts once a block.

    Returns doc_id, held_out, n_tokens (words and end), n_known (those seen in training),
    train_tokens, base_score (log10 by smoothed word shares) and score (log10 by the model);
    a row per row of ``docs``. Null text counts as empty and is the end alone; rows with a null id
    are not held out; without any training text all is scored by smoothing alone; an empty
    table gives no rows. Other columns are ignored. Ids are integers.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(fold, id_col).alias("held"), F.col(text_col).cast("string").alias("text"))
    blocks = materialize(rows.mapInArrow(_blocks, BLOCK_SQL), "hmm-blocks")
    n_blocks, n_words = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    by_word, by_block = packed(n_words, WORDS_PER_TASK), packed(n_blocks, BLOCKS_PER_TASK)

    local = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "x")).select(
        "block", "place", F.col("x.words").alias("word"), F.col("x.counts").alias("n")
    )
    vocabulary = materialize(local.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0"), "hmm-vocabulary", by_word)
    tokens, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    common = most_frequent(vocabulary, COMMON_WORDS)  # of bounded number and size
    n_own = min(OWN_CLASSES, len(common))
    known = [(w, c, k + 1 if k < n_own else None) for k, (w, c) in enumerate(common)]
    known = F.broadcast(spark.createDataFrame(known, "w string, known_c bigint, own int"))
    n_classes = 1 + n_own + ENDING_CLASSES
    kind = class_of(F.col("word"), F.col("own"), n_own).alias("kind")

    classes = vocabulary.join(known, F.col("word") == F.col("w"), "left").select("c", kind)
    summed = classes.groupBy("kind").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).toArrow()  # a row per class at most
    class_tokens, class_words = np.zeros(n_classes), np.zeros(n_classes)
    class_tokens[summed.column("kind").to_numpy()] = summed.column("n").to_numpy()
    class_words[summed.column("kind").to_numpy()] = summed.column("v").to_numpy()
    shares = Shares(tokens, distinct, class_tokens, class_words)

    # counts and classes go back to the blocks, in the places of their words. Common words and the end, which nearly
    # all blocks have, are looked up where they are; only the others meet their counts in a shuffle
    ends = vocabulary.where(F.col("word") == END).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    marked = local.select("block", "place", "word").join(known, F.col("word") == F.col("w"), "left")
    marked = marked.withColumn("known_c", F.when(F.col("word") == END, F.lit(ends)).otherwise(F.col("known_c")))
    here = marked.where("known_c is not null").select("block", "place", F.col("known_c").alias("c"), kind)
    others = marked.where("known_c is null").select("block", "place", "word", "own").join(vocabulary, "word", "left")
    counted = here.unionByName(others.select("block", "place", F.coalesce("c", F.lit(0)).alias("c"), kind))
    places = counted.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "c", "kind"))).alias("x"))
    places = places.select("block", F.col("x.c").alias("counts"), F.col("x.kind").alias("kinds"))
    coded = blocks.select("block", "doc_ids", "held", "lengths", "codes").join(places, "block")
    coded = materialize(coded.select("doc_ids", "held", "lengths", "codes", "counts", "kinds"), "hmm-coded", max(by_word, by_block))
    discard(blocks, vocabulary)

    model, likelihoods = train(coded, class_tokens, states, rounds)
    logging.getLogger(__name__).info("log likelihood before each round: %s", likelihoods)
    first_ending = 1 + n_own
    kinds = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = coded.mapInArrow(lambda b: _score(b, model, shares, first_ending), kinds)
    return scored.withColumn("train_tokens", F.lit(tokens).cast("bigint"))
