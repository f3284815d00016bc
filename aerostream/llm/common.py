"""Helpers shared by the operators: scratch tables, running sums, key filters, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerostream.session import checkpoint_path
from aerostream.sources.tables import read_table

# fixed value: a word is a run of characters other than space, tab, LF, VT, FF and CR
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder of the cluster."""
    return checkpoint_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and
    the rows survive lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def running(df: DataFrame, group: str, cell: str, order: list, value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before each row in its
    group, rows ordered by ``cell`` and, inside a cell, by ``order``.

    Two levels, so that a group that holds most rows is still worked on by many
    tasks: sums per (group, cell) are added up over the few cells of a group,
    and single rows are only ordered within their cell.
    """
    inner = Window.partitionBy(group, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = df.groupBy(group, cell).agg(F.sum(value).alias("_cell_sum"))
    before = Window.partitionBy(group).orderBy(cell).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.select(F.col(group).alias("_g"), F.col(cell).alias("_c"),
                         (F.sum("_cell_sum").over(before) - F.col("_cell_sum")).alias("_before"))
    rows = df.withColumn("_within", F.sum(value).over(inner) - F.col(value))
    return (rows.join(cells, F.col(group).eqNullSafe(F.col("_g")) & (F.col(cell) == F.col("_c")))
            .withColumn(out, F.col("_before") + F.col("_within"))
            .drop("_g", "_c", "_before", "_within"))


def tiled(rows: DataFrame, keys: list[str], item: str, size: int) -> DataFrame:
    """Deal the items of every key into tiles of some ``size`` items and give
    each pair of tiles, and each tile by itself, its rows: (keys, tile_a,
    tile_b, side, item). side is 0 for the rows of tile_a, else 1.

    Keys with one item are left out. An item is sent once per tile of its key,
    so the rows grow with the number of tiles, not with pairs of items.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    counts = counts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.expr(f"(_n + {size - 1}L) div {size}L").alias("_tiles"))
    on = [F.col(k) == F.col(f"_{k}") for k in keys]
    own = F.pmod(F.xxhash64(item, *keys), F.col("_tiles"))
    dealt = rows.join(counts, on).withColumn("_own", own)
    other = dealt.select(*keys, item, "_own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tiles") - 1)).alias("_other"))
    return other.select(*keys, F.least("_own", "_other").alias("tile_a"), F.greatest("_own", "_other").alias("tile_b"),
                        (F.col("_own") > F.col("_other")).cast("int").alias("side"), item)


def together(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of equal keys side by side in one partition, with their hash as tile."""
    return rows.withColumn("tile", F.xxhash64(*keys)).repartition("tile").sortWithinPartitions("tile", *keys)


def runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Stretches of rows with equal (long) keys, as tables; holds one stretch
    and a batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        cols = [b.column(b.schema.get_field_index(k)).to_numpy() for k in keys]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        if b.num_rows:
            change[0] = last is not None and last != tuple(c[0] for c in cols)
            last = tuple(c[-1] for c in cols)
        at = 0
        for cut in np.flatnonzero(change):
            held.append(b.slice(at, cut - at))
            yield pa.Table.from_batches(held)
            held, at = [], cut
        held.append(b.slice(at))
    held = [b for b in held if b.num_rows]
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over the classes of one tile."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while self.up.get(x, x) != x:
            self.up[x] = self.up.get(self.up[x], self.up[x])
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


class KeyFilter:
    """Bloom filter of the keys in a column of a written table: two bits a key, 16
    to 32 bits of room a key up to ``MOST_BITS`` in all (16 MB). It is put together
    by Spark, so the driver sees its words only, never keys. Whatever it turns away
    is no key; of more keys than there is room for it lets more through, so callers
    hold what passes against the table itself.
    """

    MOST_BITS = 1 << 27

    def __init__(self, keys: DataFrame, col: str):
        bits = 1 << max(6, (16 * keys.count() - 1).bit_length())
        self.mask = min(bits, self.MOST_BITS) - 1
        place = F.explode(F.array(*[h.bitwiseAND(F.lit(self.mask)) for h in (self.hashed(col), F.shiftrightunsigned(self.hashed(col), 32))]))
        words = keys.select(place.alias("p")).select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, int(p & 63))").alias("b")) \
            .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
        room = np.zeros((self.mask + 1) // 64, np.int64)
        room[words["w"].to_numpy()] = words["b"].to_numpy()
        self.sent = keys.sparkSession.sparkContext.broadcast(room)

    @staticmethod
    def hashed(col: str) -> Column:
        """What ``test`` takes, of a key column."""
        return F.xxhash64(F.col(col))

    def test(self):
        """A function for tasks: hashes to whether each may be of a key."""
        mask, sent = self.mask, self.sent

        def passes(hashes: np.ndarray) -> np.ndarray:
            room, ok = sent.value, np.ones(len(hashes), bool)
            for h in (hashes, hashes.view(np.uint64) >> np.uint64(32)):
                p = h.astype(np.int64) & mask
                ok &= (room[p >> 6] >> (p & 63)) & 1 == 1
            return ok
        return passes

    def __call__(self, col: str) -> Column:
        """Whether a row's key may be one of the keys."""
        passes = self.test()

        @F.pandas_udf("boolean")
        def may_be(h: pd.Series) -> pd.Series:
            return pd.Series(passes(h.to_numpy()))
        return may_be(self.hashed(col))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges(a, b)``, both long and not null.

    Returns (node, root), root being the smallest node of the component. Labels
    shrink by the least label among the neighbours (``min`` is summed up before
    the shuffle, so a hub costs one row per task), by pointer jumping, and by
    hooking: a node also sends its least label to the node it is labelled with,
    so a whole tree moves at once and rounds grow with the logarithm of a chain's
    length, not with the length. Each round is written to the shared folder, and rounds go on
    until no label changes. No links reach the driver, only whether a label
    changed.
    """
    e = edges.where(F.col("a") != F.col("b")).select("a", "b").distinct()
    both = saved(e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))), f"{name}-edges")
    labels = both.groupBy("a").agg(F.min("b").alias("_m")) \
        .select(F.col("a").alias("node"), F.least("a", "_m").alias("root"))
    labels = saved(labels, f"{name}-labels")
    own = F.struct(F.col("node"), F.least("_least", "_r").alias("root"), F.col("_old"))
    hook = F.struct(F.col("_old").alias("node"), F.col("_least").alias("root"), F.lit(None).cast("long").alias("_old"))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("_near"))
        step = labels.join(near, F.col("node") == F.col("a")) \
            .select("node", F.col("root").alias("_old"), F.least("root", "_near").alias("_least"))
        jump = labels.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        sent = step.join(jump, F.col("_old") == F.col("_n")) \
            .select(F.explode(F.when(F.col("_least") < F.col("_r"), F.array(own, hook)).otherwise(F.array(own))).alias("s"))
        new = sent.groupBy("s.node").agg(F.min("s.root").alias("root"), F.max("s._old").alias("_old"))
        new = saved(new, f"{name}-labels")
        changed = new.where(F.col("root") != F.col("_old")).limit(1).count()
        labels = new.select("node", "root")
        if not changed:
            return labels
