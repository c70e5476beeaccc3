"""Exact top-k search by inner product with M-trees.

The largest inner products of a query are its nearest neighbours once every vector x
gets one more component sqrt(R^2 - |x|^2), with R the largest norm, and the query a 0:
then the squared distance is |q|^2 + R^2 - 2 * (q . x). So a metric tree over the
longer vectors answers the search, while scores are integer inner products.

A tree over all vectors is kept in two parts. Its upper levels are regions: a table of routing vectors with covering
radii, split again and again until a region has no more than TREE_ROWS vectors; queries go down it in joins.
Each such region is then an M-tree of pages that one task searches. Every region has an R of its own.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, join_counted, materialize, packed, ship

#: Entries of a node's page; vectors of one tree; regions that a region is split into at most, about; vectors dealt to regions in one task; queries searched together.
PAGE = 64
TREE_ROWS = 4096
FANOUT = 512
DEALT_ROWS = 65_536
QUERY_BLOCK = 2048
#: Regions are split so many times at most: enough for any number of vectors that are not all alike.
MAX_LEVELS = 12
#: Vectors with squared norms below this are in the tree: their scores with each other fit into 64 bits, and so do distances' squares.
MAX_SQUARES = float(1 << 62)
#: Vectors with larger ones are compared one by one, so many queries with so many vectors at a time.
LARGE_QUERIES, LARGE_VECTORS = 256, 4096
#: Bounds are compared with this much to spare of themselves and of the norms, for distances lose so much of these by rounding at most.
SLACK = 1e-6

NODES = "region string, r2 bigint, node int, leaf boolean, parent_distances array<double>, radii array<double>, children array<int>, ids array<bigint>, vectors binary"


def usable(vector_col: str) -> Column:
    """Whether a vector is there, with components that are all finite numbers."""
    x = F.col(vector_col)
    return x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def in_tree(vector_col: str, scale: int) -> Column:
    squares = F.aggregate(vector_col, F.lit(0.0), lambda s, c: s + F.pow(F.abs(c.cast("double") * scale) + 1, F.lit(2.0)))
    return squares < MAX_SQUARES


def quantize(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """id and v, with floor(scale * x) of each component, of the vectors that go into the tree.

    Rows without an id and with null or non-finite components are left out; so are those with a squared norm of 2^62 or more after
    scaling, which ``large`` has.
    """
    x = F.col(vector_col)
    return table.where(F.col(id_col).isNotNull() & usable(vector_col)).where(in_tree(vector_col, scale)).select(
        F.col(id_col).cast("bigint").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("bigint")).alias("v")
    )


def finite(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, x (components as they are) and whether the vector is too large for the tree, of all rows that take part."""
    rows = table.where(F.col(id_col).isNotNull() & usable(vector_col))
    return rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("x"), (~in_tree(vector_col, scale)).alias("large")).distinct()


def _exact(vector: Iterable[float], scale: int) -> list[int]:
    return [math.floor(y) if abs(y := c * scale) < float("inf") else int(c) * scale for c in vector]


def _all_scores(queries: pd.DataFrame, vectors: pd.DataFrame, k: int, scale: int) -> pd.DataFrame:
    """The k best of some queries among some vectors, in integers of any size; scores beyond 64 bits are none."""
    most, out = (1 << 63) - 1, []
    lengths = vectors["x"].map(len).to_numpy()
    for n in set(lengths.tolist()):
        some = vectors[lengths == n]
        ids = some["id"].to_numpy()
        columns = np.array([_exact(x, scale) for x in some["x"]], object).reshape(len(some), n).T
        for own, x in zip(queries["id"], queries["x"]):
            if len(x) == n:
                scores = np.array(_exact(x, scale), object) @ columns if n else np.zeros(len(some), "int64")
                found = ((int(s), -int(i)) for s, i in zip(scores, ids) if i != own and -most <= s <= most)
                out += [(own, -i, s) for s, i in heapq.nlargest(k, found)]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")


def large_pairs(queries: DataFrame, vectors: DataFrame, k: int, scale: int) -> DataFrame:
    """query_id, vec_id, score: candidates of pairs of which one vector at least is too large for the tree.

    Such queries meet all vectors and such vectors all queries, in blocks: each pair of a block of queries and a part of the vectors is a
    group of bounded size, whose integers are exact.
    """
    def compared(asked: DataFrame, others: DataFrame) -> DataFrame:
        blocks, parts = packed(asked.count(), LARGE_QUERIES), packed(others.count(), LARGE_VECTORS)
        q = asked.select("id", "x", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("part"))
        v = others.select("id", "x", F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"))
        return q.groupBy("block", "part").cogroup(v.groupBy("block", "part")).applyInPandas(lambda a, b: _all_scores(a, b, k, scale), "query_id bigint, vec_id bigint, score bigint")

    return compared(queries, vectors.where("large")).unionByName(compared(queries.where("large"), vectors.where("not large")))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n, flat = len(column), column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype("int64").reshape(n, len(flat) // max(1, n))


def longer(x: np.ndarray, r2: int) -> np.ndarray:
    """The vectors with the component that makes all norms equal."""
    return np.concatenate([x, np.sqrt(np.maximum(0, r2 - (x * x).sum(axis=1)))[:, None]], axis=1).astype("float64")


def distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Distance of each row of x to each row of p."""
    squares = (x * x).sum(axis=1)[:, None] + (p * p).sum(axis=1)[None, :] - 2 * (x @ p.T)
    return np.sqrt(np.maximum(squares, 0))


# --- building -------------------------------------------------------------------


def build(ids: np.ndarray, x: np.ndarray, r2: int, seed: int = 7) -> list[dict]:
    """The pages of one M-tree, node 0 its root.

    A leaf's entries are vectors, an inner node's are routing vectors with covering
    radii; each has its distance to the node's own routing vector (0 at the root). Built
    from the top: entries go to the nearest of up to PAGE of their own number.
    """
    pages: list[dict] = []
    long = longer(x, r2)
    draw = np.random.default_rng(seed)

    def page(rows: np.ndarray, parent: np.ndarray | None) -> int:
        number = len(pages)
        pages.append({})
        away = np.zeros(len(rows)) if parent is None else distances(long[rows], parent[None])[:, 0]
        if len(rows) <= PAGE:
            pages[number] = {"leaf": True, "parent_distances": away, "radii": [], "children": [], "ids": ids[rows], "vectors": x[rows]}
            return number
        wanted = min(PAGE, -(-len(rows) // (PAGE // 2)))
        chosen = draw.choice(rows, wanted, replace=False)
        near = distances(long[rows], long[chosen])
        nearest = near.argmin(axis=1)
        if np.bincount(nearest, minlength=wanted).max() == len(rows):  # all alike: any halving is as good
            nearest = np.arange(len(rows)) % wanted
        used = [k for k in range(wanted) if (nearest == k).any()]
        radii = [float(near[nearest == k, k].max()) for k in used]
        children = [page(rows[nearest == k], long[chosen[k]]) for k in used]
        routing = chosen[used]
        up = np.zeros(len(used)) if parent is None else distances(long[routing], parent[None])[:, 0]
        pages[number] = {"leaf": False, "parent_distances": up, "radii": radii, "children": children, "ids": ids[routing], "vectors": x[routing]}
        return number

    if len(ids):
        page(np.arange(len(ids)), None)
    return pages


def _build(rows: pa.Table) -> pa.Table:
    region = rows.column("region")[0].as_py()
    rows = rows.sort_by([("id", "ascending")])
    x = matrix(rows.column("v"))
    r2 = int((x * x).sum(axis=1).max())
    pages = build(rows.column("id").to_numpy(), x, r2)
    return pa.table({
        "region": pa.array([region] * len(pages)),
        "r2": pa.array([r2] * len(pages), pa.int64()),
        "node": pa.array(range(len(pages)), pa.int32()),
        "leaf": pa.array([p["leaf"] for p in pages]),
        "parent_distances": pa.array([list(p["parent_distances"]) for p in pages], pa.list_(pa.float64())),
        "radii": pa.array([list(p["radii"]) for p in pages], pa.list_(pa.float64())),
        "children": pa.array([p["children"] for p in pages], pa.list_(pa.int32())),
        "ids": pa.array([p["ids"].tolist() for p in pages], pa.list_(pa.int64())),
        "vectors": pa.array([p["vectors"].astype("<i8").tobytes() for p in pages], pa.binary()),
    })


# --- searching ------------------------------------------------------------------


class Tree:
    """The pages of one region; ``computed`` counts the inner products and distances that searches have taken."""

    def __init__(self, pages: list[dict], r2: int):
        self.r2, self.pages, self.computed = r2, {}, 0
        for p in pages:
            n = len(p["ids"])
            x = np.frombuffer(p["vectors"], "<i8")
            x = x.reshape(n, len(x) // n)
            self.pages[p["node"]] = (
                p["leaf"], np.array(p["parent_distances"]), np.array(p["radii"]), p["children"], np.array(p["ids"], "i8"), x,
                None if p["leaf"] else longer(x, r2),
            )

    def search(self, own: int, q: np.ndarray, k: int, least: int | None) -> list[tuple[int, int]]:
        """The k best (score, id) but for the id ``own``, and not those below the score ``least`` already reached."""
        base = int((q * q).sum()) + self.r2
        point, rounding = np.append(q, 0).astype("float64"), SLACK * (base + 1) ** 0.5
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        reach = np.inf if least is None else (max(0, base - 2 * least)) ** 0.5
        queue: list[tuple[float, int, float | None]] = [(0.0, 0, None)]
        while queue:
            bound, node, up = heapq.heappop(queue)
            spare = reach * (1 + SLACK) + rounding
            if bound > spare:
                break
            leaf, away, radii, children, ids, x, routing = self.pages[node]
            if leaf:
                # an entry's distance is at least |d(q, parent) - d(entry, parent)|: most need no computing
                rows = np.arange(len(ids)) if up is None else np.flatnonzero(np.abs(away - up) <= spare)
                self.computed += len(rows)
                for score, i in zip((x[rows] @ q).tolist(), ids[rows].tolist()):
                    if i == own or least is not None and score < least:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (score, -i))
                    elif (score, -i) > best[0]:
                        heapq.heapreplace(best, (score, -i))
                if len(best) == k:
                    reach = min(reach, max(0, base - 2 * best[0][0]) ** 0.5)
            else:
                rows = np.arange(len(ids)) if up is None else np.flatnonzero(np.abs(away - up) - radii <= spare)
                self.computed += len(rows)
                apart = point - routing[rows]
                to = np.sqrt((apart * apart).sum(axis=1))
                for r, d in zip(rows.tolist(), to.tolist()):
                    low = max(bound, d - radii[r])
                    if low <= spare:
                        heapq.heappush(queue, (low, children[r], d))
        return sorted(((s, -i) for s, i in best), key=lambda b: (-b[0], b[1]))


def _search(pages: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    out: list[tuple[int, int, int]] = []
    if pages.num_rows and queries.num_rows:
        tree = Tree(pages.to_pylist(), pages.column("r2")[0].as_py())
        for own, q, least in zip(queries.column("id").to_pylist(), matrix(queries.column("v")), queries.column("least").to_pylist()):
            out += [(own, i, s) for s, i in tree.search(own, q, k, least)]
    return pa.table({name: pa.array([x[c] for x in out], pa.int64()) for c, name in enumerate(("query_id", "vec_id", "score"))})


# --- regions --------------------------------------------------------------------


def _deal(rows: pa.Table, centres: pa.Table) -> pa.Table:
    """Vectors of a region to the nearest of its centres, whose regions they become."""
    near, away = np.zeros(rows.num_rows, "int64"), np.zeros(rows.num_rows)
    if rows.num_rows and centres.num_rows:
        centres = centres.sort_by([("id", "ascending")])
        r2 = rows.column("r2")[0].as_py()
        points, x = longer(matrix(centres.column("v")), r2), matrix(rows.column("v"))
        for at in range(0, len(x), 4096):
            apart = distances(longer(x[at : at + 4096], r2), points)
            near[at : at + 4096], away[at : at + 4096] = apart.argmin(axis=1), apart.min(axis=1)
    parent, n = rows.column("region").to_pylist(), max(1, centres.num_rows)
    used = centres.column("v").to_pylist() if centres.num_rows else [[]]
    # a centre comes along with one of its vectors, so that it is kept once for each task
    first = np.zeros(rows.num_rows, bool)
    first[np.unique(near, return_index=True)[1]] = True
    return pa.table({
        "parent": pa.array(parent, pa.string()),
        "region": pa.array([f"{p}/{k}" if n > 1 else p for p, k in zip(parent, near.tolist())], pa.string()),
        "id": rows.column("id"), "v": rows.column("v"), "away": pa.array(away), "parent_r2": rows.column("r2"),
        "centre": pa.array([used[k] if f else None for k, f in zip(near.tolist(), first.tolist())], pa.list_(pa.int64())),
    })


DEALT = "parent string, region string, id bigint, v array<bigint>, away double, parent_r2 bigint, centre array<bigint>"


def _go_down(children: pa.Table, queries: pa.Table, first: bool) -> pa.Table:
    """Queries at a region go on to its children: the nearest one if ``first``, else all that may hold a score of ``least`` or more."""
    rows, found = [], []
    if children.num_rows and queries.num_rows:
        children = children.sort_by([("child", "ascending")])
        r2, q = children.column("r2")[0].as_py(), matrix(queries.column("v"))
        away = distances(np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype("float64"), longer(matrix(children.column("centre")), r2))
        names, radii = children.column("child").to_pylist(), children.column("radius").to_numpy()
        for i, least in enumerate(queries.column("least").to_pylist()):
            if first:
                wanted = [int(away[i].argmin())]
            else:
                base = int((q[i] * q[i]).sum()) + r2
                reach = np.inf if least is None else max(0, base - 2 * least) ** 0.5
                wanted = np.flatnonzero(away[i] - radii <= reach * (1 + SLACK) + SLACK * (base + 1) ** 0.5).tolist()
            found += [names[k] for k in wanted]
            rows += [i] * len(wanted)
    taken = queries.select(["id", "v", "least", "home"]).take(pa.array(rows, pa.int64()))
    return taken.append_column("at", pa.array(found, pa.string()))


ASKED = "id bigint, v array<bigint>, least bigint, home string, at string"


class Index:
    """A metric tree over vectors of any lengths: levels of regions, and the pages of the regions that are not split."""

    def __init__(self, vectors: DataFrame, seed: int = 7):
        """``vectors``: id, v as quantize() gives them.

        All vectors of one length are a region to begin with. A region with more than TREE_ROWS vectors is split:
        some of its vectors, about as many as parts are wanted, are drawn as centres by a hash of their id, and every vector
        goes to the nearest. Regions of any size are dealt in tasks of about DEALT_ROWS vectors. Nothing
        is collected but numbers of rows.
        """
        ship(vectors.sparkSession)
        squares = F.aggregate("v", F.lit(0).cast("bigint"), lambda s, c: s + c * c)
        whole = materialize(vectors.select(F.size("v").cast("string").alias("region"), "id", "v"), "mtree-vectors")
        self.levels: list[DataFrame] = []
        done, left, most, spent = [], whole, None, [whole]
        for level in range(MAX_LEVELS):
            sizes = left.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.max(squares).alias("r2")).withColumnRenamed("region", "r")
            sizes = materialize(sizes, "mtree-sizes")
            total, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
            if largest <= TREE_ROWS or most is not None and largest >= most:
                break
            most = largest
            sized = materialize(join_counted(left, sizes, "region", "r", "n", total), "mtree-sized")
            spent += [sizes, sized]
            large = F.col("n") > TREE_ROWS
            done.append(sized.where(~large).select("region", "id", "v"))
            wanted = F.least(F.lit(FANOUT), F.ceil(F.col("n") / TREE_ROWS) * 2)
            # the number drawn varies; that none is drawn, and the region stays as it is, has a chance of e^-8 at most
            drawn = sized.where(large & (F.pmod(F.xxhash64(F.lit(seed + level), "id"), F.lit(1 << 40)) < (wanted + 6) / F.col("n") * (1 << 40)))
            tasks = F.ceil(F.col("n") / DEALT_ROWS)
            rows = sized.where(large).select("region", F.pmod(F.xxhash64("id"), tasks).alias("task"), "id", "v", "r2")
            centres = drawn.select(F.col("region").alias("of"), F.explode(F.sequence(F.lit(0).cast("bigint"), tasks - 1)).alias("of_task"), "id", "v")
            dealt = rows.groupBy("region", "task").cogroup(centres.groupBy("of", "of_task")).applyInArrow(_deal, DEALT)
            dealt = materialize(dealt, "mtree-dealt", packed(total, DEALT_ROWS))
            children = dealt.groupBy(F.col("region").alias("child")).agg(
                F.min("parent").alias("region"), F.max("away").alias("radius"), F.min("parent_r2").alias("r2"), F.any_value("centre", True).alias("centre")
            )
            self.levels.append(materialize(children.where("child <> region").select("region", "child", "radius", "r2", "centre"), "mtree-level"))
            left = dealt.select("region", "id", "v")
            spent.append(dealt)
        done.append(left)
        rows = done[0]
        for part in done[1:]:
            rows = rows.unionByName(part)
        self.pages = materialize(rows.groupBy("region").applyInArrow(_build, NODES), "mtree-pages")
        discard(*spent)

    def route(self, queries: DataFrame, first: bool, blocks: int) -> DataFrame:
        """(id, v, least, home, at) for the regions that each query (id, v, least, home) is to search.

        ``first``: one region, by the nearest centres. Else all that may hold a score of
        ``least`` or more by their radius, but for ``home``.
        """
        going = queries.withColumn("at", F.size("v").cast("string"))
        for level in self.levels:
            asked, children = in_blocks(going, level, blocks)
            moved = children.groupBy("region", "block").cogroup(asked.groupBy("at", "in_block")).applyInArrow(lambda c, q: _go_down(c, q, first), ASKED)
            # regions that this level doesn't split are where their queries stay
            going = moved.unionByName(going.join(level.select(F.col("region").alias("at")).distinct(), "at", "left_anti").select("id", "v", "least", "home", "at"))
            going = materialize(going, "mtree-routed")
        return going if first else going.where(~F.col("at").eqNullSafe(F.col("home")))

    def search(self, routed: DataFrame, k: int, blocks: int) -> DataFrame:
        """query_id, vec_id, score of the best of each region, searched by blocks of queries."""
        asked, pages = in_blocks(routed, self.pages, blocks)
        return pages.groupBy("region", "block").cogroup(asked.groupBy("at", "in_block")).applyInArrow(
            lambda p, q: _search(p, q, k), "query_id bigint, vec_id bigint, score bigint"
        )


def in_blocks(asked: DataFrame, regions: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Queries with the number of their block, and the regions' rows once for each block that has a query there."""
    asked = asked.withColumn("in_block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    wanted = asked.select(F.col("at").alias("wanted"), F.col("in_block").alias("block")).distinct()
    return asked, regions.join(wanted, F.col("region") == F.col("wanted")).drop("wanted")


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    table: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """The ``k`` highest integer inner products of every query with all other rows of ``table``.

    A tree is built over all vectors; a query first goes down to one region, and with the k-th score found there it
    goes to all that may hold as much. Best-first search within a region: nodes by their smallest possible
    distance, entries passed over by their stored distance to the node's own routing
    vector. Of equal vectors, however many, the k + 1 with the smallest ids are in the tree: ties go to
    the smaller vec_id, so no other can be among a query's best.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id; fewer
    rows than k where there are fewer vectors. Rows with a null id, a null vector, null
    or non-finite components take no part. Vectors so large that their scores might overflow 64 bits are compared with all others one by one, in
    blocks; only a pair whose score does overflow is no pair. Vectors meet those of equal length only. Repeated ids count as the same vector where they are equal, and a query never
    meets its own id. An empty table gives no rows. Other columns are ignored.
    """
    vectors = quantize(table, id_col, vector_col, scale).distinct()
    copies = Window.partitionBy("v").orderBy("id")
    index = Index(vectors.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select("id", "v"))
    asked = quantize(queries, id_col, vector_col, scale).distinct()
    asked = materialize(asked.select("id", "v", F.lit(None).cast("bigint").alias("least"), F.lit(None).cast("string").alias("home")), "mtree-queries")
    blocks = packed(asked.count(), QUERY_BLOCK)
    routed = index.route(asked, True, blocks)
    first = materialize(index.search(routed, k, blocks), "mtree-first")
    reached = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).where(F.col("n") >= k)
    bounded = routed.select("id", "v", F.col("at").alias("home")).join(reached, F.col("id") == F.col("query_id"), "left")
    rest = index.search(index.route(bounded.select("id", "v", F.col("s").alias("least"), "home"), False, blocks), k, blocks)
    found = first.unionByName(rest)
    if not (everything := finite(table, id_col, vector_col, scale)).where("large").isEmpty():
        found = found.unionByName(large_pairs(finite(queries, id_col, vector_col, scale), everything, k, scale))
    return best_of(found, k).select("query_id", "rank", "vec_id", "score")
