"""Near copies by the Jaccard similarity of word shingles: candidates by SimHash blocks and by MinHash bands, each verified exactly.

Fingerprints within DISTANCE of 64 bits, joined on pigeonhole blocks as ``simhash`` does it, are candidates. That is a similarity of
about 0.96: what is less alike, down to the one asked for, no choice of blocks of 64 bits would reach, so MinHash bands add those.
Blocks and bands only say which texts may belong together: what they connect is a coarse group, within
which all texts' shingle sets are compared exactly. So a wrong candidate costs time, not a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, join_counted, materialize, only, packed, ship, text_key
from .simhash import KEYS_PER_TASK, SEED, connected_components, fingerprint_links, fingerprint_of, shingle_hashes, with_classes

WIDTH = 5
SIMILARITY = 0.8
#: Fingerprints that differ in so many bits at most are candidates.
DISTANCE = 4
#: A pair of similarity s meets in a band at least with 1 - (1 - s^ROWS)^BANDS: 0.99994 at 0.8.
BANDS = 32
ROWS = 6
#: Shingles whose minima are taken at once, and shingles of a coarse group compared in one task.
SHINGLES_AT_ONCE = 4096
CHUNK_SHINGLES = 2_000_000

_draw = np.random.default_rng(SEED)
FACTORS = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype="u8") * np.uint64(2) + np.uint64(1)
SHIFTS = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype="u8")


# --- candidates -----------------------------------------------------------------


def distinct_hashes(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, "u8")


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The distinct shingles' hashes, sorted."""
    return distinct_hashes(list(shingle_hashes(text, width)))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key of each band of minima; equal sets have equal keys."""
    least = np.full(BANDS * ROWS, (1 << 32) - 1, "u4")
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        # multiply and shift: of a product's bits the upper ones depend on all of the hash
        mixed = (hashes[at : at + SHINGLES_AT_ONCE, None] * FACTORS + SHIFTS) >> np.uint64(32)
        np.minimum(least, mixed.min(axis=0).astype("u4"), out=least)
    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(rows[k].tobytes(), k) for k in range(BANDS)], "u8")


def _sketches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            nodes, sizes, prints, keys = [], [], [], []
            for text in part.column(2).cast(pa.binary()).to_pylist():
                words = b" ".join((text or b"").lower().split())
                parts = list(shingle_hashes(words, width))
                found = distinct_hashes(parts)
                nodes.append(xxhash.xxh64_intdigest(words, SEED))
                sizes.append(len(found))
                prints.append(fingerprint_of(parts))
                keys.append(band_keys(found))
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(nodes) + 1) * BANDS, pa.int32()), pa.array(np.concatenate(keys).view("i8")))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:2], pa.array(np.array(nodes, "u8").view("i8")), pa.array(sizes, pa.int64()), pa.array(np.array(prints, "u8").view("i8")), bands],
                ["doc_id", "text_key", "node", "size", "fp", "bands"],
            )


# --- exact links ----------------------------------------------------------------


def links_within(nodes: np.ndarray, sets: list[np.ndarray], similarity: float) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs whose Jaccard similarity is ``similarity`` or more.

    Searches breadth-first: what is found leaves the rest, so a group of near copies costs
    a comparison or so for each, not one for each pair.
    """
    sizes = np.array([len(s) for s in sets])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    mine = [codes[a:b] for a, b in zip(offsets, offsets[1:])]
    mark = np.zeros(len(values), bool)
    rest = np.argsort(-sizes, kind="stable")
    flat, starts = np.concatenate([mine[k] for k in rest]), np.concatenate([[0], np.cumsum(sizes[rest])])
    a, b, frontier = [], [], []
    while len(rest):
        if not frontier:
            root, frontier = rest[0], [rest[0]]
            rest, flat, starts = rest[1:], flat[starts[1] :], starts[1:] - starts[1]
        if not len(rest):
            break
        x = frontier.pop()
        mark[mine[x]] = True
        common = np.add.reduceat(mark[flat], starts[:-1], dtype="int64")
        mark[mine[x]] = False
        near = common >= similarity * (sizes[x] + sizes[rest] - common) - 1e-9
        if near.any():
            found = rest[near].tolist()
            a += [int(nodes[k]) for k in found]
            b += [int(nodes[root])] * len(found)
            frontier += found
            flat = flat[np.repeat(~near, np.diff(starts))]
            rest = rest[~near]
            starts = np.concatenate([[0], np.cumsum(sizes[rest])])
    return a, b


def _exact_links(rows: pa.Table, similarity: float) -> pa.Table:
    sets = rows.column("shingles").combine_chunks()
    sets = sets.chunk(0) if isinstance(sets, pa.ChunkedArray) else sets
    a, b = links_within(rows.column("node").to_numpy(), [x.values.to_numpy().view("u8") for x in sets], similarity)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _shingles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The column "text", which is the last, becomes "shingles"."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sets = [shingle_set(x or b"", width).view("i8") for x in part.column("text").cast(pa.binary()).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], [*part.schema.names[:-1], "shingles"])


def _by_fingerprint(distinct: DataFrame) -> DataFrame:
    """Candidates (a, b) that connect texts of equal fingerprints with the first of them, and those firsts where their fingerprints are within DISTANCE."""
    firsts = materialize(distinct.groupBy("fp").agg(F.min("node").alias("m"), F.count(F.lit(1)).alias("members")), "copies-fingerprints")
    shared = firsts.where("members > 1").withColumnRenamed("fp", "f")
    equal = join_counted(distinct.select("node", "fp"), shared, "fp", "f", "members", distinct.count()).where("node <> m").select(F.col("node").alias("a"), F.col("m").alias("b"))
    links = fingerprint_links(firsts.select("fp"), DISTANCE)
    for x in "ab":
        links = links.join(firsts.select(F.col("fp").alias("f"), F.col("m").alias(f"{x}_first")), F.col(x) == F.col("f")).drop("f")
    return equal.unionByName(links.select(F.col("a_first").alias("a"), F.col("b_first").alias("b")))


def near_copies(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Near-copy component of every document: doc_id, text_key, component_id, first_key, n_docs, as ``simhash.near_duplicates``.

    Texts are lower-cased (A-Z) and cut into words; the set of a text's shingles of ``width``
    words (fewer words: one shingle of all) tells how alike texts are, and texts of Jaccard similarity
    ``similarity`` or more are linked; a component is all that links reach. Texts of the
    same words are one from the start, however many documents have them; so are those without words.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(id_col, text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    marked = rows.mapInArrow(lambda batches: _sketches(batches, width), f"doc_id {kind}, text_key bigint, node bigint, size bigint, fp bigint, bands array<bigint>")
    marked = materialize(marked, "copies-sketches")
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")
    distinct = marked.groupBy("node").agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("n"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    distinct = materialize(distinct, "copies-distinct")

    # all that share a band's key are candidates of its first node: as many rows as members, not pairs
    keys = distinct.where("size > 0").select("node", F.explode("bands").alias("key"))
    n_keys = BANDS * distinct.count()
    shared = keys.groupBy("key").agg(F.min("node").alias("m"), F.count(F.lit(1)).alias("members")).where("members > 1").withColumnRenamed("key", "k")
    coarse = join_counted(keys, shared, "key", "k", "members", n_keys).where("node <> m").select(F.col("node").alias("a"), F.col("m").alias("b"))
    coarse = materialize(coarse.unionByName(_by_fingerprint(distinct.where("size > 0"))).distinct(), "copies-coarse", packed(n_keys, KEYS_PER_TASK))
    groups = connected_components(coarse)
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    groups = materialize(groups.join(distinct.select("node", "size", "first"), "node"), "copies-groups")
    totals = groups.groupBy("root").agg(F.ceil(F.sum("size") / CHUNK_SHINGLES).cast("int").alias("chunks"), F.count(F.lit(1)).alias("members"))
    groups = join_counted(groups, totals.withColumnRenamed("root", "r"), "root", "r", "members", groups.count()).select(
        "node", "root", "chunks", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), F.col("first.doc_id").alias("d"), F.col("first.text_key").alias("t")
    )
    # one document of each candidate brings its text; of a group too large for a task each pair of chunks has one of its own
    texts = rows.join(groups, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t"))).dropDuplicates(["node"])
    sets = texts.select("node", "root", "chunks", "chunk", "text").mapInArrow(
        lambda batches: _shingles(batches, width), "node bigint, root bigint, chunks int, chunk int, shingles array<bigint>"
    )
    other = F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda x: x != F.col("chunk"))
    )
    pairs = sets.withColumn("other", F.explode(other)).select(
        "root", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "node", "shingles"
    )
    links = pairs.groupBy("root", "i", "j").applyInArrow(lambda part: _exact_links(part, similarity), "a bigint, b bigint")

    roots = connected_components(links)
    discard(coarse)
    rooted = distinct.select("node", "first", "n").join(roots.withColumnRenamed("node", "x"), F.col("node") == F.col("x"), "left").select("node", "first", "n", F.coalesce("root", "node").alias("root"))
    of_node = with_classes(materialize(rooted, "copies-rooted"), "node").withColumnRenamed("node", "x")
    # many documents may have the same words
    return join_counted(marked, of_node, "node", "x", "n", marked.count()).select(
        "doc_id", "text_key", F.col("first.doc_id").alias("component_id"), F.col("first.text_key").alias("first_key"), "n_docs"
    )


def deduplicate(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, with all its columns, with one row of each component of near copies: the one with the smallest id."""
    found = near_copies(docs, width, similarity, id_col, text_col)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("first_key")))
    return only(docs, first, id_col, text_col, once=True)
