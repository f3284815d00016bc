"""Aggregates and top-k lists kept up to date batch by batch.

A view is kept from signed rows: +1 for a row that is now there, -1 for one that
is no longer. Over a record log every row is +1 (``log_sink``). Over the table of
each key's newest record (``current_sink``) a newer record gives -1 for the row it
replaces, so a flight that changes airline or airport leaves its old group.

``SumView``   counts and exact sums per group; distinct counts by keeping every
              (group, value) pair with the number of rows that hold it, so a value
              counts until its last row is gone
``TotalView`` totals over another view's groups, from that view's changes
``TopView``   the k first rows by an order; from +1 rows only

Each view is a ``FoldedLog``: a batch writes what it changes, partially
aggregated before its one shuffle, and never touches older rows. All sinks are
``foreachBatch`` functions that stay in the JVM; a batch delivered again writes
the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostream.operators.state import latest_by_key, newest_per_partition
from aerostream.schema import SEQUENCED_FLIGHT_SCHEMA
from aerostream.streaming.log import FOLD_EVERY, FoldedLog

SIGN = "_sign"
ROWS = "_rows"  # rows that a group, or a (group, value) pair, has now


@dataclass(frozen=True)
class SumView:
    """Per group: the number of rows, sums of integers and one distinct count.

    ``keep_empty`` keeps groups whose last row is gone, with zeros."""

    keys: dict[str, Column]
    sums: dict[str, Column] = field(default_factory=dict)
    distinct: tuple[str, Column] | None = None
    where: Column | None = None
    keep_empty: bool = False

    @property
    def pair(self) -> list[str]:
        return [*self.keys, *(["_value"] if self.distinct else [])]

    def partial(self, signed: DataFrame) -> DataFrame:
        """What signed rows change: one row per group or (group, value) pair."""
        src = signed.where(self.where) if self.where is not None else signed
        cols = [c.alias(k) for k, c in self.keys.items()]
        if self.distinct:
            cols.append(self.distinct[1].alias("_value"))
        src = src.select(*cols, F.col(SIGN).alias(ROWS), *[
            (F.col(SIGN) * F.coalesce(c.cast("long"), F.lit(0))).cast("decimal(20,0)").alias(k) for k, c in self.sums.items()])
        return self._added(src)

    def _added(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.pair).agg(
            F.sum(ROWS).cast("long").alias(ROWS), *[F.sum(k).cast("decimal(38,0)").alias(k) for k in self.sums])

    def merge(self, rows: DataFrame) -> DataFrame:
        out = self._added(rows)
        return out if self.keep_empty else out.where(F.col(ROWS) != 0)

    def result(self, merged: DataFrame) -> DataFrame:
        """(keys, _rows, sums, distinct count) per group; sums are decimals."""
        if self.distinct:
            there = F.when((F.col(ROWS) > 0) & F.col("_value").isNotNull(), 1)
            merged = merged.groupBy(*self.keys).agg(
                F.sum(ROWS).cast("long").alias(ROWS), *[F.sum(k).cast("decimal(38,0)").alias(k) for k in self.sums],
                F.count(there).alias(self.distinct[0]))
        return merged if self.keep_empty else merged.where(F.col(ROWS) > 0)


@dataclass(frozen=True)
class TotalView:
    """Totals of columns of the view ``of``, kept from its changes."""

    of: str
    sums: tuple[str, ...] = (ROWS,)

    def partial(self, changes: DataFrame) -> DataFrame:
        return changes.groupBy().agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in self.sums])

    merge = partial

    def result(self, merged: DataFrame) -> DataFrame:
        return merged


@dataclass(frozen=True)
class TopView:
    """The ``k`` first rows of ``select`` by ``order``. A batch keeps its own k
    first rows, so merging never sorts more than k rows of each batch."""

    select: Callable[[DataFrame], DataFrame]
    order: Callable[[], list[Column]]
    k: int

    def partial(self, signed: DataFrame) -> DataFrame:
        return self.merge(self.select(signed.where(F.col(SIGN) > 0)))

    def merge(self, rows: DataFrame) -> DataFrame:
        return rows.orderBy(*self.order()).limit(self.k)

    def result(self, merged: DataFrame) -> DataFrame:
        return merged


View = SumView | TotalView | TopView
Views = dict[str, View]


def _log(path: str, name: str, views: Views, schema: T.StructType, spark: SparkSession, every: int, generation: int) -> FoldedLog:
    view = views[name]
    rows = spark.createDataFrame([], schema).withColumn(SIGN, F.lit(1).cast("long"))
    source = views[view.of].partial(rows) if isinstance(view, TotalView) else rows
    return FoldedLog(f"{path}/view={name}", view.partial(source).schema, view.merge, every, generation)


def _advance(path: str, views: Views, signed: DataFrame, schema: T.StructType, batch_id: int, every: int, generation: int) -> None:
    """Write what a batch's signed rows change in every view, totals last."""
    spark = signed.sparkSession
    for name in sorted(views, key=lambda n: isinstance(views[n], TotalView)):
        view, log = views[name], _log(path, name, views, schema, spark, every, generation)
        if not log.begin(spark, batch_id):
            continue
        source = signed
        if isinstance(view, TotalView):
            source = _log(path, view.of, views, schema, spark, every, generation).of_batch(spark, batch_id)
        log.write(view.partial(source), batch_id)


def log_sink(path: str, views: Views, every: int = FOLD_EVERY, generation: int = 0):
    """``foreachBatch`` function that keeps ``views`` over all records."""
    def _sink(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist() if len(views) > 1 else batch  # every view reads it
        try:
            _advance(path, views, kept.withColumn(SIGN, F.lit(1).cast("long")), batch.schema, batch_id, every, generation)
        finally:
            kept.unpersist()
    return _sink


def _state(path: str, schema: T.StructType, key: str, order: str, every: int, generation: int) -> FoldedLog:
    payload = [n for n in schema.names if n != key]
    return FoldedLog(f"{path}/state", schema, lambda rows: newest_per_partition(rows, key, order, payload).select(*schema.names),
                     every, generation)


def changed(batch: DataFrame, before: DataFrame, key: str, order: str) -> DataFrame:
    """(key, new, old) for every key whose newest record is another one after
    ``batch``: the records as structs, ``old`` null for a key not seen before.

    ``batch`` holds a batch's newest records per key (and topic partition).
    Records that are not newer than what is held change nothing.
    """
    names, mine = [n for n in batch.columns if n != key], batch
    touched = mine.select(F.col(key).alias("_key")).distinct()
    held = before.join(touched, F.col(key) == F.col("_key")).select(*batch.columns, F.lit(True).alias("_held"))
    # dealt out anew: the partitions of a union's sides may be coalesced unlike each other
    both = mine.withColumn("_held", F.lit(False)).unionByName(held).repartition(key)
    row = F.struct(*batch.columns)
    after = latest_by_key(both, key, order, names).select(F.col(key).alias("_key"), row.alias("new"))
    past = latest_by_key(both.where("_held"), key, order, names).select(F.col(key).alias("_old_key"), row.alias("old"))
    return after.join(past, F.col("_key") == F.col("_old_key"), "left") \
        .where(F.col("old").isNull() | (F.col(f"new.{order}") != F.col(f"old.{order}"))).select("_key", "new", "old")


def current_sink(path: str, views: Views, key: str, order: str, every: int = FOLD_EVERY, generation: int = 0):
    """``foreachBatch`` function that keeps, under ``path``, each key's newest
    record, the changes of every batch, and ``views`` over the newest records.

    The batch's records are reduced map-side, so a hot key costs one row per task;
    records without a key or an order are left out, as they have no place in the
    order of a key. The last records are found by one scan of the folded state,
    joined to the keys of the batch.
    """
    def _sink(batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        state = _state(path, schema, key, order, every, generation)
        if not state.begin(spark, batch_id):
            return
        row = T.StructType([T.StructField("_key", schema[key].dataType), T.StructField("new", schema), T.StructField("old", schema)])
        moves = FoldedLog(f"{path}/changes", row, lambda rows: rows.limit(0), every, generation)
        moves.begin(spark, batch_id)
        # the batch itself runs once; what follows reads what it left
        rows = batch.where(F.col(key).isNotNull() & F.col(order).isNotNull())
        state.write(newest_per_partition(rows, key, order, [n for n in schema.names if n != key]), batch_id)
        moves.write(changed(state.of_batch(spark, batch_id), state.rows(spark, batch_id), key, order), batch_id)
        _advance(path, views, signed_rows(moves.of_batch(spark, batch_id)), schema, batch_id, every, generation)
    return _sink


def signed_rows(moves: DataFrame) -> DataFrame:
    """Changes as rows with a sign: what is there now, and what it replaced."""
    both = F.array(F.struct(F.lit(1).cast("long").alias(SIGN), F.col("new").alias("row")),
                   F.struct(F.lit(-1).cast("long").alias(SIGN), F.col("old").alias("row")))
    return moves.select(F.explode(both).alias("_m")).where(F.col("_m.row").isNotNull()).select(f"_m.{SIGN}", "_m.row.*")


def read_view(spark: SparkSession, path: str, views: Views, name: str, schema: T.StructType = SEQUENCED_FLIGHT_SCHEMA,
              before: int | None = None, generation: int = 0) -> DataFrame:
    """The view as it is now, or as it was before a batch of the current epoch."""
    log = _log(path, name, views, schema, spark, FOLD_EVERY, generation)
    return views[name].result(log.current(spark, before))


def read_view_changes(spark: SparkSession, path: str, views: Views, name: str, schema: T.StructType = SEQUENCED_FLIGHT_SCHEMA,
                      generation: int = 0) -> DataFrame:
    """What every batch changed in the view, with ``batch``: whole history."""
    return _log(path, name, views, schema, spark, FOLD_EVERY, generation).history(spark)


def read_current(spark: SparkSession, path: str, key: str, order: str, schema: T.StructType = SEQUENCED_FLIGHT_SCHEMA,
                 generation: int = 0) -> DataFrame:
    """Each key's newest record."""
    rows = _state(path, schema, key, order, FOLD_EVERY, generation).rows(spark)
    return latest_by_key(rows, key, order, [n for n in schema.names if n != key]).select(*schema.names)
