"""Near-duplicate embeddings by cross-polytope hashing.

Equal vectors of a label are one class. Each class is turned by ``tables_for`` its dimension times
``HASHES`` fast pseudo-rotations (three rounds of random signs and a Hadamard
transform); a hash is the signed axis nearest to the turned vector, a table's
key joins its hashes. Multiprobe: a table also gets the key in which the hash
with the closest runner-up takes that runner-up. Classes that share a key are
candidates; every candidate pair is verified by its cosine in double precision.

Keys with many classes are dealt into tiles of at most ``TILE`` rows, and tiles
are compared two by two, so a hot key is spread over many tasks that hold two
tiles each. A pair that shares several keys counts under the first one only.
Tiles give sums and a spanning forest of their links, never all pairs; copies
are never expanded.

Defined results: rows with a null label or a vector that is null, zero, or has a
null or non-finite component link with nothing; rows with a null id are rows of
their own, the component id is the smallest id that is not null; equal rows
(repeated ids too) link with each other; vectors of different length never link;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostream.llm.common import components, runs, saved, tiled, together

TABLES = 10
HASHES = 3
TILE = 1024
SEED = 20240130


def tables_for(dim: int) -> int:
    """So many tables that of pairs at a cosine of 0.93 at least 0.99 share a key: a
    table finds fewer of them in more dimensions."""
    return TABLES if dim <= 64 else 16 if dim <= 128 else 20 if dim <= 256 else 32


def signs(dim: int, tables: int, hashes: int, seed: int) -> np.ndarray:
    """(tables * hashes, 3, dim) random signs, the same in every task."""
    rng = np.random.default_rng((seed, dim))
    return rng.integers(0, 2, (tables * hashes, 3, dim)).astype(np.float32) * 2 - 1


def hadamard(x: np.ndarray) -> np.ndarray:
    """Unnormalised fast Hadamard transform along the last axis (a power of two)."""
    h, n = 1, x.shape[-1]
    while h < n:
        y = x.reshape(*x.shape[:-1], n // (2 * h), 2, h)
        x = np.concatenate([y[..., 0:1, :] + y[..., 1:2, :], y[..., 0:1, :] - y[..., 1:2, :]], axis=-2).reshape(x.shape)
        h *= 2
    return x


def keys_of(vectors: np.ndarray, tables: int = TABLES, hashes: int = HASHES, seed: int = SEED) -> np.ndarray:
    """(rows, 2 * tables) keys: each table's own one and its probe."""
    rows, dim = vectors.shape
    wide = 1 << max(1, (dim - 1).bit_length())
    x = np.zeros((rows, wide), np.float32)
    x[:, :dim] = vectors / np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)
    best = np.empty((rows, tables * hashes), np.int64)
    second, gap = best.copy(), np.empty(best.shape, np.float32)
    for i, (a, b, c) in enumerate(signs(wide, tables, hashes, seed)):
        y = hadamard(c * hadamard(b * hadamard(a * x))) / np.float32(wide)
        size = np.abs(y)
        top = np.argpartition(size, -2, axis=1)[:, -2:]
        mag = np.take_along_axis(size, top, 1)
        order = np.argsort(mag, axis=1)
        two, one = np.take_along_axis(top, order, 1).T
        axis = lambda k, y=y: 2 * k + (y[np.arange(rows), k] < 0)
        best[:, i], second[:, i] = axis(one), axis(two)
        gap[:, i] = np.abs(mag[:, 0] - mag[:, 1])
    best, second, gap = (v.reshape(rows, tables, hashes) for v in (best, second, gap))
    weak = gap.argmin(axis=2)[..., None]
    probe = best.copy()
    np.put_along_axis(probe, weak, np.take_along_axis(second, weak, 2), 2)

    def joined(parts: np.ndarray) -> np.ndarray:
        key = np.broadcast_to(np.arange(tables, dtype=np.int64), (rows, tables)).copy()
        for h in range(hashes):
            key = key * (2 * wide) + parts[:, :, h]
        return key

    return np.concatenate([joined(best), joined(probe)], axis=1)


def _hashed(classes: DataFrame, tables: int | None, hashes: int, seed: int) -> DataFrame:
    """Add keys (array of long: every table's own one, then every probe) to
    classes (cls, label, vector, copies)."""
    schema = "cls long, label string, vector array<double>, copies long, keys array<long>"
    out = pa.schema([("cls", pa.int64()), ("label", pa.string()), ("vector", pa.list_(pa.float64())),
                     ("copies", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = b.column(2).to_pylist()
            keys: list = [None] * len(vecs)
            for dim in {len(v) for v in vecs}:
                at = [i for i, v in enumerate(vecs) if len(v) == dim]
                for i, k in zip(at, keys_of(np.array([vecs[i] for i in at]), tables or tables_for(dim), hashes, seed), strict=True):
                    keys[i] = k
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, out.field(4).type)], schema=out)

    return classes.mapInArrow(run, schema)


def first_shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least key that rows of x and y (own keys, then probes) share."""
    t = x.shape[1] // 2
    none = np.int64(2 ** 62)
    best = np.full(len(x), none)
    for i in range(t - 1, -1, -1):  # keys of earlier tables are smaller
        for k in (x[:, i], x[:, t + i]):
            hit = (k == y[:, i]) | (k == y[:, t + i])
            best = np.where(hit & ((best >= none) | (k < best)), k, best)
    return best


def _tile_links(t: pa.Table, least: float) -> list[tuple]:
    """(a, b, n) of one pair of tiles: class a gained n linked vectors; or b is
    a class of the same component."""
    cls, side, copies = t["cls"].to_numpy(), t["side"].to_numpy(), t["copies"].to_numpy()
    key, one = t["key"][0].as_py(), t["tile_a"][0].as_py() == t["tile_b"][0].as_py()
    every = t["keys"].to_numpy(zero_copy_only=False)
    vecs = t["vector"].to_numpy(zero_copy_only=False)
    dims = np.array([len(v) for v in vecs])
    rows: list[tuple] = []
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        keys = np.stack(every[at])
        x = np.stack(vecs[at]).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        p, q = np.nonzero(x @ x.T >= least)
        # within one tile each pair once; between two tiles only pairs across
        keep = p < q if one else (side[at][p] == 0) & (side[at][q] == 1)
        p, q = p[keep], q[keep]
        # a pair that shares an earlier key is counted there
        counted = first_shared(keys[p], keys[q]) == key
        p, q = at[p[counted]], at[q[counted]]
        gained = np.bincount(p, copies[q], len(cls)) + np.bincount(q, copies[p], len(cls))
        rows += [(int(cls[i]), None, int(gained[i])) for i in np.flatnonzero(gained)]
        root = np.arange(len(cls))
        while len(p):
            low = np.minimum(root[p], root[q])
            new = root.copy()
            np.minimum.at(new, p, low)
            np.minimum.at(new, q, low)
            new = np.minimum(new, new[new])
            if (new == root).all():
                break
            root = new
        rows += [(int(cls[i]), int(cls[root[i]]), 0) for i in np.flatnonzero(root != np.arange(len(cls)))]
    return rows


def _verified(tiles: DataFrame, least: float) -> DataFrame:
    """(a, b, n) of all tiles; see ``_tile_links``."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for t in runs(batches, ("tile", "key", "tile_a", "tile_b")):
            held += _tile_links(t, least)
            if len(held) > 50_000:
                yield _links(held, out)
                held = []
        if held:
            yield _links(held, out)

    return together(tiles, ["label", "key", "tile_a", "tile_b"]).drop("label").mapInArrow(run, "a long, b long, n long")


def _links(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    least: float = 0.93, tables: int | None = None, hashes: int = HASHES, seed: int = SEED) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    v = F.col("_v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("_v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    # the class: equal label and vector; 64 bits of hash twice over
    cls = F.when(usable, F.xxhash64("label", v))
    rows = rows.withColumn("cls", cls)
    classes = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.first("label").alias("label"), F.first("_v").alias("vector"), F.count(F.lit(1)).alias("copies"),
        F.min("vec_id").alias("least_id"))
    classes = saved(classes, "vec-classes")
    hashed = saved(_hashed(classes.select("cls", "label", "vector", "copies"), tables, hashes, seed), "vec-keys")
    keyed = hashed.select("cls", "label", F.explode(F.array_distinct("keys")).alias("key"))
    tiles = tiled(keyed, ["label", "key"], "cls", TILE)
    got = saved(_verified(tiles.join(hashed.drop("label"), "cls"), least), "vec-links")
    n = got.where(F.col("b").isNull()).groupBy(F.col("a").alias("_c")).agg(F.sum("n").alias("n"))
    roots = components(got.where(F.col("b").isNotNull()), "vec")
    per = classes.select("cls", "copies", "least_id") \
        .join(n, F.col("cls") == F.col("_c"), "left") \
        .join(roots, F.col("cls") == F.col("node"), "left") \
        .withColumn("root", F.coalesce("root", "cls"))
    least_of = per.groupBy(F.col("root").alias("_r")).agg(F.min("least_id").alias("component_id"))
    per = per.join(least_of, F.col("root") == F.col("_r")).select(
        F.col("cls").alias("_k"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "cls").join(per, F.col("cls") == F.col("_k"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
