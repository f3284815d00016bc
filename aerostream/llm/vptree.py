"""Nearest neighbours by vantage-point trees, one per shard.

A node of a tree holds one of its rows as vantage point and the median distance
of the others to it; nearer rows go inside, the rest outside, down to buckets of
``BUCKET`` rows. A search enters the likelier side first; the other side cannot
hold a row within the best distance found so far, t, if the query is farther than
t from the dividing sphere (triangle inequality). ``factor`` relaxes this: the
side is left out beyond t / factor. Factor one is exact.

Shards: a tree over a bounded sample (at most ``SAMPLE`` rows and ``SAMPLE_BYTES``,
those of smallest hash) of the commonest dimension, cut at some ``SHARD`` rows of
the whole table per leaf and at most ``LEAVES`` leaves, deals out all rows; a leaf that
holds more rows (copies, a crowded region) is dealt by hash into shards of ``SHARD``
rows, any other dimension likewise. Every row is in one shard.

Two rounds: each query searches the shards of its own leaf, which gives t; then
the leaves that the sample's tree does not rule out with that t, under the same
rule. Queries of a shard come in blocks of some ``QUERIES``, a task holds one shard and
one block of queries. Distances are compared in double precision, summed in the
order of the components; candidates come from a matrix product whose error is
allowed for.

Defined results: rows whose id is null or whose vector is null, empty, zero or
holds null or non-finite components take no part; vectors of different length never
meet; a query's own id is never its candidate, whatever rows carry it; rows with
the same id and vector ask once, as candidates each counts; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostream.llm.common import runs, saved, together

BUCKET = 48
SHARD = 4096
QUERIES = 1024
LEAVES = 1024
SAMPLE = 16_384
SAMPLE_BYTES = 32 << 20
SLACK = 1e-9  # allowance for rounding, as a part of the sizes compared


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of x to those of y, the components' squares
    added from the first to the last (numpy's own sums add in another order)."""
    total = np.zeros(len(x))
    for d in (x - y).T:
        total += d * d
    return np.sqrt(total)


def away_from(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.linalg.norm(x - point, axis=1)


class Node:
    __slots__ = ("rows", "point", "radius", "inside", "outside", "leaf")

    def __init__(self, rows: np.ndarray | None = None):
        self.rows, self.leaf = rows, -1


def grow(vectors: np.ndarray, bucket: int, seed: int = 0) -> Node:
    """The tree over the rows of ``vectors``; buckets hold row numbers."""
    rng = np.random.default_rng(seed)

    def node(rows: np.ndarray) -> Node:
        out = Node(rows)
        if len(rows) <= bucket:
            return out
        # of a few candidates the one that spreads the others most
        tried = rng.choice(rows, min(8, len(rows)), replace=False)
        seen = vectors[rng.choice(rows, min(64, len(rows)), replace=False)]
        best = max(tried, key=lambda r: away_from(seen, vectors[r]).std())
        away = away_from(vectors[rows], vectors[best])
        radius = np.partition(away, len(rows) // 2)[len(rows) // 2]
        near = away < radius
        if not near.any():  # equal distances: nothing to divide
            return out
        out.rows, out.point, out.radius = None, vectors[best], radius
        out.inside, out.outside = node(rows[near]), node(rows[~near])
        return out

    return node(np.arange(len(vectors)))


class Best:
    """The k nearest rows so far of each of a block of queries."""

    def __init__(self, k: int, own: np.ndarray, least: np.ndarray):
        self.k, self.own = k, own
        self.bound = least  # rows farther than this are of no use
        self.score = np.full((len(own), k), np.inf)
        self.found = np.zeros((len(own), k), np.int64)
        self.n = np.zeros(len(own), np.int64)
        self.measured = 0

    def add(self, q: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        """Rows (query, score, id) that may be among the nearest."""
        some = np.unique(q)
        held = np.arange(self.k) < self.n[some, None]
        q = np.concatenate([np.repeat(some, self.n[some]), q])
        score = np.concatenate([self.score[some][held], score])
        ident = np.concatenate([self.found[some][held], ident])
        order = np.lexsort((ident, score, q))
        q, score, ident = q[order], score[order], ident[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        q, place = q[keep], place[keep]
        self.score[q, place], self.found[q, place] = score[keep], ident[keep]
        self.n[some] = np.bincount(q, minlength=len(self.n))[some]
        full = some[self.n[some] == self.k]
        self.bound[full] = np.minimum(self.bound[full], self.score[full, -1])


def search(root: Node, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, best: Best, factor: float) -> None:
    """Search the tree for all queries together, into ``best``."""
    size, asked = np.einsum("ij,ij->i", vectors, vectors), np.einsum("ij,ij->i", queries, queries)

    def bucket(rows: np.ndarray, q: np.ndarray) -> None:
        scale = asked[q][:, None] + size[rows]
        near = scale - 2 * queries[q] @ vectors[rows].T
        # what overflows is not ruled out
        a, b = np.nonzero(~(near > (best.bound[q] ** 2)[:, None] + SLACK * scale))
        a, b = q[a], rows[b]
        mine = ids[b] != best.own[a]
        a, b = a[mine], b[mine]
        for at in range(0, len(a), 65_536):
            p, r = a[at:at + 65_536], b[at:at + 65_536]
            d = distances(vectors[r], queries[p])
            use = ~(d > best.bound[p])
            best.add(p[use], d[use], ids[r[use]])
        best.measured += len(q) * len(rows)

    def visit(node: Node, q: np.ndarray) -> None:
        if not len(q):
            return
        if node.rows is not None:
            return bucket(node.rows, q)
        away = away_from(queries[q], node.point)
        best.measured += len(q)
        within = away < node.radius
        visit(node.inside, q[within])
        visit(node.outside, q[~within])
        keep = ~ruled_out(away, node.radius, best.bound[q], factor)
        visit(node.outside, q[within & keep])
        visit(node.inside, q[~within & keep])

    with np.errstate(over="ignore", invalid="ignore"):
        visit(root, np.arange(len(queries)))


def ruled_out(away: np.ndarray, radius: float, bound: np.ndarray, factor: float) -> np.ndarray:
    """Whether the side of the sphere on which the query is not holds nothing of use."""
    return np.abs(away - radius) - SLACK * (away + radius) > bound / factor


def number(node: Node, n: int = 0) -> int:
    """Number the leaves from ``n``; returns the next number."""
    if node.rows is not None:
        node.leaf = n
        return n + 1
    return number(node.outside, number(node.inside, n))


def leaves_of(root: Node, x: np.ndarray, bound: np.ndarray | None, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of x, leaf) pairs: the leaf of each row, or without a row's own leaf
    those that its ``bound`` does not rule out."""
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def visit(node: Node, q: np.ndarray, home: np.ndarray) -> None:
        if not len(q):
            return
        if node.rows is not None:
            take = q[home] if bound is None else q[~home]
            found.append((take, np.full(len(take), node.leaf)))
            return
        away = away_from(x[q], node.point)
        within = away < node.radius
        other = np.zeros(len(q), bool) if bound is None else ~ruled_out(away, node.radius, bound[q], factor)
        for child, here in ((node.inside, within), (node.outside, ~within)):
            go = here | other
            visit(child, q[go], (home & here)[go])

    with np.errstate(over="ignore", invalid="ignore"):
        visit(root, np.arange(len(x)), np.ones(len(x), bool))
    return tuple(np.concatenate(c) if c else np.zeros(0, np.int64) for c in (zip(*found, strict=True) if found else ((), ())))


def _stack(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def _routed(rows: DataFrame, root: Node, dim: int, factor: float, bounded: bool) -> DataFrame:
    """Rows (.., dim, v[, bound]) with the leaf they belong to, or one row per
    leaf to be searched besides their own. Other dimensions have a leaf each."""
    columns = [f for f in rows.schema.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(columns.index("dim")).to_numpy()
            at = np.flatnonzero(dims == dim)
            bound = b.column(columns.index("bound")).to_numpy()[at] if bounded else None
            q, leaf = leaves_of(root, _stack(b.column(columns.index("v")).take(pa.array(at))), bound, factor) if len(at) \
                else (at, at)
            q = at[q]
            if not bounded:
                rest = np.flatnonzero(dims != dim)
                q, leaf = np.concatenate([q, rest]), np.concatenate([leaf, -dims[rest]])
            for i in range(0, len(q), 4096):  # a query may go to many leaves
                part = b.take(pa.array(q[i:i + 4096]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(leaf[i:i + 4096], pa.int64())], names=[*columns, "leaf"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, leaf long")


def _searched(rows: DataFrame, visits: DataFrame, sizes: DataFrame, k: int, factor: float, shard: int, queries: int) -> DataFrame:
    """(qry, query_id, vec_id, score): the nearest in every shard of the leaves
    that queries visit. rows (leaf, id, v), visits (leaf, qry, id, v, bound),
    sizes (leaf, shards)."""
    blocks = visits.groupBy("leaf").agg(F.expr(f"(count(1) + {queries - 1}L) div {queries}L").alias("blocks"))
    work = sizes.join(blocks.withColumnRenamed("leaf", "_l"), F.col("leaf") == F.col("_l")) \
        .select(F.col("leaf").alias("_leaf"), "shards", "blocks")
    up_to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    nothing = F.lit(None).cast("long")
    left = rows.join(work, F.col("leaf") == F.col("_leaf")).select(
        "leaf", F.pmod(F.xxhash64("id", "v"), F.col("shards")).alias("shard"), up_to("blocks").alias("block"),
        F.lit(0).alias("kind"), nothing.alias("qry"), "id", "v", F.lit(None).cast("double").alias("bound"))
    right = visits.join(work, F.col("leaf") == F.col("_leaf")).select(
        "leaf", up_to("shards").alias("shard"), F.pmod(F.xxhash64("qry", F.lit(1)), F.col("blocks")).alias("block"),
        F.lit(1).alias("kind"), "qry", "id", "v", "bound")
    out = pa.schema([("qry", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ("tile", "leaf", "shard", "block")):
            kind = t["kind"].to_numpy()
            mine, asked = t.filter(pa.array(kind == 0)), t.filter(pa.array(kind == 1))
            if not len(mine) or not len(asked):
                continue
            ids, vectors = mine["id"].to_numpy(), _stack(mine["v"])
            order = np.lexsort((*vectors.T[:4], ids))  # the same tree in every run
            ids, vectors = ids[order], vectors[order]
            best = Best(k, asked["id"].to_numpy(), asked["bound"].to_numpy().copy())
            search(grow(vectors, BUCKET), vectors, ids, _stack(asked["v"]), best, factor)
            have = np.arange(k) < best.n[:, None]
            repeat = lambda c: np.repeat(c.to_numpy(), best.n)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (repeat(asked["qry"]), repeat(asked["id"]), best.found[have], best.score[have])],
                                             schema=out)

    tiles = together(left.unionByName(right), ["leaf", "shard", "block"])
    return tiles.mapInArrow(run, "qry long, query_id long, vec_id long, score double")


def usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qry", "query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, factor: float = 1.0, id_col: str = "vec_id",
            vector_col: str = "embedding", shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """Each query's k nearest rows: query_id, rank, vec_id, score. ``is_query``
    is a condition on the columns of ``vectors``."""
    if factor < 1:
        raise ValueError("factor must be at least one")
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")) \
        .where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v").cast("long"))
    rows = saved(rows, "vp-rows")
    common = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    dim, n = common if common else (1, 0)
    limit = min(SAMPLE, max(64, SAMPLE_BYTES // (8 * dim)))
    sample = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("id", "v"), "id").limit(limit).select("v").toArrow()
    leaves = min(LEAVES, -(-n // shard))
    root = grow(_stack(sample["v"]) if len(sample) else np.zeros((0, dim)), max(1, -(-len(sample) // max(1, leaves))))
    number(root)
    placed = saved(_routed(rows, root, dim, factor, bounded=False), "vp-placed")
    sizes = saved(placed.groupBy("leaf").agg(F.expr(f"(count(1) + {shard - 1}L) div {shard}L").alias("shards")), "vp-sizes")
    asked = placed.where("asks").select("leaf", "id", "v", "dim").dropDuplicates(["id", "v"]) \
        .withColumn("qry", F.xxhash64("id", "v")).withColumn("bound", F.lit(float("inf")))
    asked = saved(asked, "vp-queries")
    items = placed.select("leaf", "id", "v")
    visit = ["leaf", "qry", "id", "v", "bound"]
    first = saved(_top(_searched(items, asked.select(*visit), sizes, k, factor, shard, queries), k), "vp-first")
    bounds = first.where(F.col("rank") == k).select(F.col("qry").alias("_q"), F.col("query_id").alias("_id"), F.col("score").alias("_bound"))
    again = asked.join(bounds, (F.col("qry") == F.col("_q")) & (F.col("id") == F.col("_id")), "left") \
        .select("qry", "id", "v", "dim", F.coalesce("_bound", "bound").alias("bound"))
    more = saved(_routed(again.where(F.col("dim") == dim), root, dim, factor, bounded=True).select(*visit), "vp-visits")
    found = first.drop("rank").unionByName(_searched(items, more, sizes, k, factor, shard, queries))
    return _top(found, k).select(F.col("query_id"), F.col("rank").cast("int"), "vec_id", "score")
