"""SimHash near-duplicate detection with pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, join_counted, materialize, only, packed, ship, text_key

SEED = 42
BITS = 64
#: Shingles whose bits are counted at once, and members of a block bucket compared in one task.
SHINGLES_AT_ONCE = 1 << 16
BUCKET_MEMBERS = 8192
#: Fingerprints under a mask that one task of a shuffle has, about.
KEYS_PER_TASK = 4_000_000


# --- fingerprints ---------------------------------------------------------------


def shingle_hashes(text: bytes, width: int) -> Iterator[np.ndarray]:
    """XXH64 of each run of ``width`` words, in parts; of all words if they are fewer; nothing without words."""
    words = text.lower().split()  # bytes: only A-Z change, and only ASCII white space separates
    if not words:
        return
    joined = memoryview(b" ".join(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    last = max(1, len(words) - width + 1)
    tails = ends[width - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, last, SHINGLES_AT_ONCE):
        to = min(last, at + SHINGLES_AT_ONCE)
        yield np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts[at:to], tails[at:to])), "<u8", to - at)


def fingerprint_of(parts: Iterable[np.ndarray]) -> int:
    """The 64-bit SimHash of shingles' hashes: a bit is 1 if it is set in over half of them."""
    counts, n = np.zeros(BITS, "int64"), 0
    for hashes in parts:
        counts += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="int64")
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, width: int) -> int:
    return fingerprint_of(shingle_hashes(text, width))


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, found = batch.column(2).cast(pa.binary()), []
        for at in range(0, len(texts), 512):
            found += [fingerprint(x or b"", width) for x in texts[at : at + 512].to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.array(found, "u8").view("i8"))], ["doc_id", "text_key", "fp"])


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (of id and text) and fp (the fingerprint as a signed 64-bit integer) of every whole text."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(id_col, text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _fingerprints(batches, width), f"doc_id {kind}, text_key bigint, fp bigint")


# --- links ----------------------------------------------------------------------


def block_masks(distance: int, blocks: int) -> list[int]:
    """Masks of every choice of ``blocks - distance`` of the blocks into which 64 bits are cut.

    Two fingerprints that differ in at most ``distance`` bits differ in at most that
    many blocks, so they agree under one of the masks at least.
    """
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    of_block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(of_block[k] for k in chosen) for chosen in combinations(range(blocks), blocks - distance)]


def blocks_for(n: int, distance: int) -> int:
    """Blocks so many that chance agreements under a mask stay few beside ``n`` distinct fingerprints.

    All choices find the same links; more blocks mean more masks and fewer
    chance candidates for each.
    """
    for blocks in range(distance + 3, 3 * distance + 1):
        masks = block_masks(distance, blocks)
        if len(masks) * n <= 8 * 2 ** (BITS * (blocks - distance) // blocks):
            break
    return blocks


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links_within(members: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the members' links: each member that isn't the first of its component, and that first one.

    Searches breadth-first: what is found leaves the rest, so that a member of a
    dense cluster is compared with what is still unfound, not with all.
    """
    rest, found, roots = members, [], []
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        frontier = np.array([root], members.dtype)
        while len(frontier) and len(rest):
            near = np.zeros(len(rest), bool)
            step = max(1, (1 << 20) // len(rest))
            for at in range(0, len(frontier), step):
                differing = np.bitwise_count(rest[None, :] ^ frontier[at : at + step, None])
                near |= (differing <= distance).any(axis=0)
            frontier, rest = rest[near], rest[~near]
            found.append(frontier)
            roots.append(np.full(len(frontier), root, members.dtype))
    empty = np.zeros(0, members.dtype)
    return np.concatenate([empty, *found]), np.concatenate([empty, *roots])


def _runs(batches: Iterator[pa.RecordBatch], masks: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(mask's number, chunk, members) of each bucket of two or more, from rows sorted by mask and bucket.

    A bucket of over BUCKET_MEMBERS members comes in chunks of that many, numbered
    from 0; one that fits comes as chunk -1.
    """
    bucket, held, chunk, size = None, [], 0, 0

    def rest() -> Iterator[tuple[int, int, np.ndarray]]:
        if chunk or size > 1:
            yield bucket[0], chunk if chunk else -1, np.concatenate(held)

    for batch in batches:
        combo, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy().view("u8")
        if not len(fp):
            continue
        key = fp & masks[combo]
        bounds = [0, *(np.flatnonzero((np.diff(combo) != 0) | (key[1:] != key[:-1])) + 1).tolist(), len(fp)]
        # alone in the middle of a batch: no bucket of two
        for k in [k for k in range(len(bounds) - 1) if bounds[k + 1] - bounds[k] > 1 or k in (0, len(bounds) - 2)]:
            at, end = bounds[k], bounds[k + 1]
            if bucket != (int(combo[at]), int(key[at])):
                yield from rest()
                bucket, held, chunk, size = (int(combo[at]), int(key[at])), [], 0, 0
            held.append(fp[at:end])
            size += end - at
            while size > BUCKET_MEMBERS:
                joined = np.concatenate(held)
                yield bucket[0], chunk, joined[:BUCKET_MEMBERS]
                held, chunk, size = [joined[BUCKET_MEMBERS:]], chunk + 1, size - BUCKET_MEMBERS
    yield from rest()


def _bucket_links(batches: Iterator[pa.RecordBatch], masks: np.ndarray, distance: int) -> Iterator[pa.RecordBatch]:
    """Links of buckets that fit into a task; members of larger ones, with the number of their chunk."""
    a, b, combos, chunks = [], [], [], []
    for number, chunk, members in _runs(batches, masks):
        if chunk < 0:
            x, root = links_within(members, distance)
            a.append(x), b.append(root)
            combos.append(np.full(len(x), -1)), chunks.append(np.full(len(x), -1))
        else:
            a.append(members), b.append(members)
            combos.append(np.full(len(members), number)), chunks.append(np.full(len(members), chunk))
        if sum(map(len, a)) > 50_000:
            yield _link_batch(a, b, combos, chunks)
            a, b, combos, chunks = [], [], [], []
    if a:
        yield _link_batch(a, b, combos, chunks)


def _link_batch(a, b, combos, chunks) -> pa.RecordBatch:
    a, b = np.concatenate(a).view("i8"), np.concatenate(b).view("i8")
    combos, chunks = np.concatenate(combos).astype("int32"), np.concatenate(chunks).astype("int32")
    rows = np.unique(np.stack([a, b, combos.astype("i8"), chunks.astype("i8")], axis=1), axis=0) if len(a) else np.zeros((0, 4), "i8")
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy()), pa.array(rows[:, 2].astype("int32")), pa.array(rows[:, 3].astype("int32"))],
        ["a", "b", "combo", "chunk"],
    )


def _chunk_links(rows: pa.Table, distance: int) -> pa.Table:
    members = np.unique(rows.column("fp").to_numpy().view("u8"))
    a, b = links_within(members, distance)
    return pa.table({"a": pa.array(a.view("i8")), "b": pa.array(b.view("i8"))})


def fingerprint_links(distinct: DataFrame, distance: int = 4, blocks: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect just those within ``distance`` bits.

    Fingerprints are joined on blocks: all that agree under a mask meet in one
    bucket, sorted together by Spark, and are compared there. Of a bucket's links
    only a spanning forest is returned, so the rows grow with the members, not
    their pairs; components are the same. A bucket with more members than one task
    should compare is cut into chunks, and each pair of chunks is compared in a
    task of its own.
    """
    spark = distinct.sparkSession
    ship(spark)
    n = distinct.count()
    blocks = blocks or blocks_for(n, distance)
    masks = block_masks(distance, blocks)
    as_array = np.array(masks, "u8")
    keys = F.array(*[F.lit(signed(m)) for m in masks])
    rows = distinct.select(F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("combo"), "fp")
    bucket = F.col("fp").bitwiseAND(F.get(keys, F.col("combo")))
    found = (
        rows.repartition(F.col("combo"), bucket)
        .sortWithinPartitions("combo", bucket, "fp")
        .mapInArrow(lambda batches: _bucket_links(batches, as_array, distance), "a bigint, b bigint, combo int, chunk int")
    )
    found = materialize(found, "simhash-links", packed(n * len(masks), KEYS_PER_TASK))
    small = found.where("chunk < 0").select("a", "b")
    large = found.where("chunk >= 0").select("combo", F.col("a").alias("fp"), "chunk", F.col("a").bitwiseAND(F.get(keys, F.col("combo"))).alias("bucket"))
    chunks = large.groupBy("combo", "bucket").agg(F.max("chunk").alias("last"))
    pairs = (
        large.join(chunks, ["combo", "bucket"])
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .select("combo", "bucket", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "fp")
    )
    between = pairs.groupBy("combo", "bucket", "i", "j").applyInArrow(lambda rows: _chunk_links(rows, distance), "a bigint, b bigint")
    return small.unionByName(between)


# --- components -----------------------------------------------------------------


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node of its component.

    Alternates large-star and small-star steps until nothing changes: each node's
    neighbours are linked to the smallest of them, as joins and groupings that
    Spark shuffles, with each round written to the shared folder. The links of a
    node that very many others are linked to are never gathered in one task.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(links, "components")
    n, before = links.count(), None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"), "degree")
        large = join_counted(both, least, "a", "n", "degree", 2 * n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "components")
        n = large.count()
        down = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree")).select(F.col("a").alias("n"), "m", "degree")
        small = (
            join_counted(large, down, "a", "n", "degree", n)
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
            .select("x.a", "x.b").where("a <> b").distinct()
        )
        old, links = links, materialize(small, "components")
        n, mark = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        discard(old, large)
        if (n, mark) == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = n, mark


def with_classes(rooted: DataFrame, node: str) -> DataFrame:
    """(node, n, first, n_docs) from (node, first, n, root): the smallest ``first`` and the sum of ``n`` of each root's nodes."""
    classes = rooted.groupBy("root").agg(F.min("first").alias("least"), F.sum("n").alias("n_docs"), F.count(F.lit(1)).alias("nodes"))
    found = join_counted(rooted.select(node, "n", "root"), classes.withColumnRenamed("root", "r"), "root", "r", "nodes", rooted.count())
    return found.select(node, "n", F.col("least").alias("first"), "n_docs")


def near_duplicates(
    docs: DataFrame,
    width: int = 4,
    distance: int = 4,
    blocks: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fingerprint and near-duplicate component of every document.

    Texts are lower-cased (A-Z), cut into words and into shingles of ``width`` words
    (fewer words: one shingle of all; none: fingerprint 0), each hashed by XXH64 with
    seed 42. Fingerprints within ``distance`` bits are linked, and a component is all
    that links reach. Equal fingerprints are handled as one from the start, however
    many documents have them.

    Returns doc_id, text_key, fp (signed), fingerprint (16 hexadecimal digits), component_id
    (smallest doc_id in the component, null ids aside), first_key (that row's text_key) and
    n_docs (rows in it). A row per row of ``docs``; null text counts as empty; rows with a null
    id take part, and component_id is null only where a component has no other ids; an empty table
    gives no rows. Other columns are ignored.
    """
    marked = materialize(fingerprints(docs, width, id_col, text_col), "simhash-fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")
    distinct = materialize(marked.groupBy("fp").agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    roots = connected_components(fingerprint_links(distinct.select("fp"), distance, blocks))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    of_fp = with_classes(materialize(rooted, "simhash-rooted"), "fp").withColumnRenamed("fp", "f")
    # many documents may share a fingerprint
    found = join_counted(marked, of_fp, "fp", "f", "n", marked.count())
    return found.select(
        "doc_id", "text_key", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"), F.col("first.text_key").alias("first_key"), "n_docs",
    )


def deduplicate(docs: DataFrame, width: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, with all its columns, with one row of each near-duplicate component: the one with the smallest id."""
    found = near_duplicates(docs, width, distance, id_col=id_col, text_col=text_col)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("first_key")))
    return only(docs, first, id_col, text_col, once=True)
