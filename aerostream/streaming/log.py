"""State of a stream, kept as a base and the batches that came after it.

Each micro-batch adds its rows in a folder of its own; now and then they are
folded into a base, and later batches go to a new epoch. Readers read the base
of the current epoch and that epoch's batches only, so neither the work of a
batch nor of a reader grows with the age of the stream:

    batches/gen=<g>/epoch=<e>/batch=<b>   rows of one batch
    bases/gen=<g>/epoch=<e>               all batches before <e>, folded
    heads/gen=<g>/epoch=<e>               written last: the epoch is in force

A fold runs before a batch is worked on, over batches that the stream has
committed. If it is cut short before the head is written, readers stay with the
old epoch and the next attempt writes the base again. A batch delivered again
replaces its own folder; one older than the epoch changes nothing. Nothing is
deleted, so ``history`` still has every batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostream.sinks.table import read_if_there

BATCH, EPOCH = "batch", "epoch"
# batches between two folds
FOLD_EVERY = 16


def with_long(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, T.LongType()) for n in names]])


@dataclass(frozen=True)
class FoldedLog:
    """``fold`` turns the rows of many batches into rows that say the same."""

    path: str
    schema: T.StructType
    fold: Callable[[DataFrame], DataFrame]
    every: int = FOLD_EVERY
    generation: int = 0

    def _at(self, kind: str, *more: str) -> str:
        return "/".join([self.path, kind, f"gen={self.generation}", *more])

    def epoch(self, spark: SparkSession) -> int:
        """First batch that is not in the base."""
        heads = read_if_there(spark, self._at("heads"), T.StructType([T.StructField("note", T.StringType())]))
        return max((int(m) for f in heads.inputFiles() for m in re.findall(rf"/heads/gen={self.generation}/{EPOCH}=(\d+)/", f)), default=0)

    def rows(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """What the batches (those ``before`` one, if given) come to."""
        epoch = self.epoch(spark)
        later = read_if_there(spark, self._at("batches", f"{EPOCH}={epoch}"), with_long(self.schema, BATCH))
        if before is not None:
            later = later.where(F.col(BATCH) < before)
        names = self.schema.names
        if not epoch:
            return later.select(*names)
        return read_if_there(spark, self._at("bases", f"{EPOCH}={epoch}"), self.schema).unionByName(later.select(*names))

    def current(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        return self.fold(self.rows(spark, before))

    def history(self, spark: SparkSession) -> DataFrame:
        """The rows of every batch, with ``batch``."""
        return read_if_there(spark, self._at("batches"), with_long(self.schema, EPOCH, BATCH)).drop(EPOCH)

    def of_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return read_if_there(spark, self._at("batches", f"{EPOCH}={self.epoch(spark)}", f"{BATCH}={batch_id}"), self.schema)

    def begin(self, spark: SparkSession, batch_id: int) -> bool:
        """Fold if it is due; False if the batch is in the base already."""
        epoch = self.epoch(spark)
        if batch_id < epoch:
            return False
        if batch_id - epoch >= self.every:
            self.fold_before(spark, batch_id)
        return True

    def fold_before(self, spark: SparkSession, batch_id: int) -> None:
        """Fold all batches before ``batch_id`` and put the new epoch in force."""
        self.current(spark, batch_id).write.mode("overwrite").parquet(self._at("bases", f"{EPOCH}={batch_id}"))
        spark.range(1).select(F.lit("in force").alias("note")).write.mode("overwrite").parquet(self._at("heads", f"{EPOCH}={batch_id}"))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows.select(*self.schema.names).write.mode("overwrite").parquet(
            self._at("batches", f"{EPOCH}={self.epoch(spark)}", f"{BATCH}={batch_id}"))
