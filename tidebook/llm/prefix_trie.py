"""A prefix trie of conversations, merged from small tries of families."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, join_counted, materialize, ship

#: Rows from which a family is dealt out by conversation, so that no task has a trie of more rows in its memory. There is one such
#: family in so many rows at most: a broadcast of their ids has 8 bytes for each.
FAMILY_ROWS = 100_000
#: A task's rows are sorted by these: families, in each the base's turns first, then conversations, and their turns.
PIECE = ["base", "split", "part"]
BATCH = 8192
ROOT = bytes(16)

NODES = "base bigint, split boolean, part bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, depth bigint, conv bigint, n_convs bigint, chars bigint, saved bigint, leaves bigint, childless bigint, first_end bigint, ends string"
TOTALS = "k1 bigint, k2 bigint, saved bigint, leaves bigint"
ENDS = "k1 bigint, k2 bigint, ends_sha256 string"
NO_ENDS = hashlib.sha256().hexdigest()


def _longs(key: bytes) -> tuple[int, int]:
    return int.from_bytes(key[:8], "little", signed=True), int.from_bytes(key[8:], "little", signed=True)


def _child(key: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(key + turn, digest_size=16).digest()


class Rows:
    """Rows of a schema, handed on in batches."""

    def __init__(self, schema: str):
        kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
        self.schema = pa.schema([(c, kinds[t]) for c, t in (x.split() for x in schema.split(", "))])
        self.rows: list[tuple] = []

    def add(self, *row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        if len(self.rows) >= BATCH:
            yield from self.all()

    def all(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows), self.schema.types)], schema=self.schema)
        self.rows = []


class Trie:
    """The trie of a family's rebuilt conversations. A node comes after its parent in all lists."""

    def __init__(self):
        self.children: dict[tuple[int, bytes], int] = {}
        self.keys, self.parents, self.depths, self.chars = [ROOT], [-1], [0], [0]
        self.convs, self.counts, self.ends = [[]], [0], [[]]

    def step(self, at: int, turn: bytes, chars: int) -> int:
        found = self.children.get((at, turn))
        if found is None:
            found = self.children[at, turn] = len(self.keys)
            self.keys.append(_child(self.keys[at], turn))
            self.parents.append(at)
            self.depths.append(self.depths[at] + 1)
            self.chars.append(chars)
            self.convs.append([])
            self.counts.append(0)
            self.ends.append([])
        return found

    def end(self, at: int, conv: int | None) -> None:
        """A conversation ends here and so is a member of each node on its way."""
        self.ends[at].append(conv)
        while at >= 0:
            if conv is not None and (not self.convs[at] or conv < self.convs[at][0]):
                self.convs[at] = [conv]
            self.counts[at] += 1
            at = self.parents[at]

    def rows(self) -> Iterator[tuple]:
        n = len(self.keys)
        saved, leaves, has_child = [0] * n, [0] * n, [False] * n
        for k in range(n - 1, -1, -1):
            leaves[k] += not has_child[k]
            saved[k] += (self.counts[k] - 1) * self.chars[k]
            if (up := self.parents[k]) >= 0:
                has_child[up] = True
                saved[up] += saved[k]
                leaves[up] += leaves[k]
        for k in range(n):
            up, ends = self.parents[k], sorted(self.ends[k], key=lambda c: (c is not None, c))
            yield (
                *_longs(self.keys[k]), *(_longs(self.keys[up]) if up >= 0 else (None, None)), self.depths[k], self.convs[k][0] if self.convs[k] else None, self.counts[k],
                self.chars[k], saved[k], leaves[k], int(not has_child[k]), ends[0] if ends else None, ",".join("" if c is None else str(c) for c in ends) if ends else None,
            )


class Chain:
    """What a trie does for one conversation alone, without keeping its turns."""

    def __init__(self, conv: int | None):
        self.conv, self.last = conv, (ROOT, None, 0, 0)

    def step(self, turn: bytes, chars: int) -> tuple:
        key, _, depth, _ = before = self.last
        self.last = (_child(key, turn), key, depth + 1, chars)
        return self.row(before, False)

    def row(self, node: tuple, last: bool) -> tuple:
        key, up, depth, chars = node
        ends = (self.conv, "" if self.conv is None else str(self.conv)) if last else (None, None)
        return (*_longs(key), *(_longs(up) if up is not None else (None, None)), depth, self.conv, 1, chars, 0, 1, int(last), *ends)


def _shared_turns(conv: int | None, most: int) -> int:
    return zlib.crc32(str("" if conv is None else conv).encode()) % most


def _build(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Nodes of families' tries, from their rows in the order of PIECE, the base's turns first."""
    out = Rows(NODES)
    piece = conv = grown = chain = None
    first: list[tuple[bytes, int]] = []
    skip = at = 0

    def begin() -> Iterator[pa.RecordBatch]:
        """The conversation's share of the base's turns."""
        nonlocal skip, at, chain
        skip, at = (0, 0) if conv == piece[0] else (_shared_turns(conv, most), 0)
        chain = Chain(conv) if piece[1] else None
        for turn in first[:skip]:
            yield from walk(*turn)

    def walk(turn: bytes, chars: int) -> Iterator[pa.RecordBatch]:
        nonlocal at
        if chain:
            yield from out.add(*piece, *chain.step(turn, chars))
        else:
            at = grown.step(at, turn, chars)

    def finish() -> Iterator[pa.RecordBatch]:
        if chain:
            yield from out.add(*piece, *chain.row(chain.last, True))
        elif grown and opened:
            grown.end(at, conv)

    def close() -> Iterator[pa.RecordBatch]:
        if piece and not piece[1]:
            for row in grown.rows():
                yield from out.add(*piece, *row)

    opened = False
    for batch in batches:
        for *found, its, turn, chars in zip(*(c.to_pylist() for c in batch.columns)):
            if (new := tuple(found)) != piece:
                yield from finish()
                yield from close()
                piece, first, opened, grown, chain = new, [], False, Trie(), None
            if its is not None and its == piece[0] and len(first) < most - 1:
                first.append((turn, chars))
            if piece[1] and its != piece[2]:  # a copy of the base's turns, for a family that is dealt out
                continue
            if not opened or its != conv:
                yield from finish()
                conv, opened = its, True
                yield from begin()
            if skip:
                skip -= 1
            else:
                yield from walk(turn, chars)
    yield from finish()
    yield from close()
    yield from out.all()


def _corrected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections summed over subtrees, from a family's nodes with the deepest first; what belongs to a node comes before it."""
    out, piece, open_sums = Rows(TOTALS), None, {}
    for batch in batches:
        for *found, k1, k2, p1, p2, is_node, saved, leaves in zip(*(c.to_pylist() for c in batch.columns)):
            if found != piece:
                piece, open_sums = found, {}
            key = (k1, k2)
            if is_node:
                saved, leaves = open_sums.pop(key, (0, 0))
                if not (saved or leaves):
                    continue
                yield from out.add(k1, k2, saved, leaves)
                key = (p1, p2)
            before = open_sums.get(key, (0, 0))
            open_sums[key] = (before[0] + saved, before[1] + leaves)
    yield from out.all()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's lists of ids, as they come."""
    out, node, said = Rows(ENDS), None, None
    for batch in batches:
        for k1, k2, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if (k1, k2) == node:
                said.update(b"," + ends.encode())
            else:
                if node:
                    yield from out.add(*node, said.hexdigest())
                node, said = (k1, k2), hashlib.sha256(ends.encode())
    if node:
        yield from out.add(*node, said.hexdigest())
    yield from out.all()


def _base(conv: Column, family: int) -> Column:
    return conv - conv % family


def _placed(rows: DataFrame, hot: DataFrame | None) -> DataFrame:
    """The rows with the rest of PIECE: a family is one, or, of very many rows, each of its conversations."""
    if hot is None:
        return rows.withColumns({"split": F.lit(False), "part": F.lit(None).cast("bigint")})
    marked = rows.join(F.broadcast(hot), rows.base.eqNullSafe(hot.hot), "left").withColumn("split", F.coalesce("is_hot", F.lit(False)))
    return marked.withColumn("part", F.when(F.col("split"), F.col("conv"))).drop("hot", "is_hot")


def _copies(turns: DataFrame, placed: DataFrame, hot: DataFrame, most: int) -> DataFrame:
    """The base's first turns for each other conversation of a family that is dealt out."""
    order = Window.partitionBy("base").orderBy("turn", "digest")
    bases = turns.join(F.broadcast(hot), turns.base == hot.hot).drop("hot", "is_hot").where("conv = base")
    first = bases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") < most).drop("rank")
    others = placed.where("split and conv <> base").select(F.col("base").alias("of"), "part").distinct()
    return first.join(others, F.col("of") == F.col("base")).drop("of").withColumn("split", F.lit(True))


def prefix_trie(
    conversations: DataFrame, family: int = 100, most: int = 6, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The prefix trie of all rebuilt conversations, a row for each node.

    Conversation c is rebuilt from the first h turns of conversation c - c % family, h being crc32 of c's decimal text by ``most``, and its own
    after its first h. Families meet by this base id: each builds its small trie of turn digests (texts stay where they are read) with
    counts and sums of its own, and only its combined nodes are shuffled to be merged by the digest of their path. Sums over
    subtrees add up, but for nodes that several families have: what is then counted too often is given to the
    family of the node's smallest member as a correction, summed up along that family's paths, and added.

    No task holds more than a family of ``FAMILY_ROWS`` rows: larger ones are dealt out by conversation, and one conversation streams
    through its task. The merged lists of ids stream into their hashes, in their order.

    Null roles and texts are empty; turns go in order, null first, rows of one turn by their digests; repeated rows are turns
    of their own. Rows with a null id are one conversation, whose decimal text is empty (h = 0, before all others in lists; it is no smallest
    member). Negative ids: c % family has c's sign. No rows give no nodes, not even a root. Other columns are ignored.

    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = conversations.sparkSession
    ship(spark)
    conv, role, text = F.col(id_col).cast("bigint"), F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    turns = conversations.select(
        _base(conv, family).alias("base"), conv.alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.length(text).cast("bigint").alias("chars")
    )
    large = conversations.select(_base(conv, family).alias("hot")).groupBy("hot").agg(F.count("*").alias("n")).where(F.col("n") > FAMILY_ROWS)
    hot = materialize(large.select("hot", F.lit(True).alias("is_hot")), "trie-large")
    if hot.isEmpty():
        hot = None
    rows = _placed(turns, hot)
    if hot is not None:
        rows = rows.unionByName(_copies(turns, rows, hot, most))
    in_order = [*PIECE, F.coalesce(F.col("conv") != F.col("base"), F.lit(False)), "conv", "turn", "digest"]
    dealt = rows.repartition(*PIECE).sortWithinPartitions(*in_order).select(*PIECE, "conv", "digest", "chars")
    nodes = materialize(dealt.mapInArrow(lambda batches: _build(batches, most), NODES), "trie-families")

    same = ["p1", "p2", "depth", "chars"]
    merged = nodes.groupBy("k1", "k2").agg(
        *[F.max(c).alias(c) for c in same], F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("n_convs", "saved", "leaves", "childless")], F.count("*").alias("families")
    )
    merged = materialize(merged, "trie-merged")
    too_few = (F.col("childless") == F.col("families")).cast("bigint") - F.col("childless")
    owned = merged.where("families > 1").select(
        _base(F.col("conv"), family).alias("base"), "conv", "k1", "k2", "p1", "p2", "depth", F.lit(False).alias("is_node"), ((F.col("families") - 1) * F.col("chars")).alias("saved"), too_few.alias("leaves")
    )
    owned = _placed(owned.where("saved <> 0 or leaves <> 0"), hot)
    columns = [*PIECE, "k1", "k2", "p1", "p2", "is_node", "saved", "leaves"]
    both = nodes.select(*columns[:-3], F.lit(True).alias("is_node"), F.lit(0).cast("bigint").alias("saved"), F.lit(0).cast("bigint").alias("leaves"), "depth").unionByName(owned.select(*columns, "depth"))
    summed = both.repartition(*PIECE).sortWithinPartitions(*PIECE, F.desc("depth"), "is_node").select(*columns).mapInArrow(_corrected, TOTALS)
    corrections = summed.groupBy("k1", "k2").agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))

    lists = nodes.where("ends is not null").select("k1", "k2", "first_end", "ends").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first_end")
    hashes = lists.select("k1", "k2", "ends").mapInArrow(_hashed, ENDS)
    children = merged.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    key = ["k1", "k2"]
    full = merged.join(corrections, key, "left").join(children, key, "left").join(hashes, key, "left").select(
        F.struct("k1", "k2").alias("node"), F.struct("p1", "p2").alias("up"), "conv", "depth", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    full = materialize(full, "trie-nodes")
    discard(nodes, merged)
    parents = full.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"), F.col("n_children").alias("of_parent"))
    below = join_counted(full.where("depth > 0"), parents, "up", "parent", "of_parent", full.count())
    columns = [F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return full.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(*columns).unionByName(below.select(*columns))

