"""Tumbling windows that close, with the rows that came too late kept aside.

The watermark of a batch is the latest event time of all batches before it, less
the allowed delay. A row is late if its window had ended by then; it goes to a
table of its own and changes no window. A window is closed once the watermark
of the next batch has reached its end: nothing can change it any more. Closed
windows, open ones and late rows together hold every row once.

Streaming aggregations in append mode close windows by the same rule, but drop
late rows and only count them; here they can be read, and the rule also runs on
plain batches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostream.functions.flight import floor_div
from aerostream.streaming.log import FOLD_EVERY, FoldedLog
from aerostream.streaming.maintained import SIGN, SumView

START, END = "window_start_ms", "window_end_ms"


@dataclass(frozen=True)
class ClosingWindows:
    """Windows of ``width_ms`` over ``time`` (epoch ms), with exact sums.

    Rows without a time belong to no window and are left out."""

    path: str
    schema: T.StructType
    time: str
    width_ms: int
    delay_ms: int
    sums: tuple[tuple[str, str], ...] = ()
    every: int = FOLD_EVERY
    generation: int = 0

    def _start(self) -> Column:
        return floor_div(F.col(self.time), self.width_ms) * F.lit(self.width_ms)

    def _view(self) -> SumView:
        return SumView({START: self._start()}, {name: F.expr(text) for name, text in self.sums})

    def _windows(self, spark: SparkSession) -> FoldedLog:
        view = self._view()
        none = spark.createDataFrame([], self.schema).withColumn(SIGN, F.lit(1).cast("long"))
        return FoldedLog(f"{self.path}/windows", view.partial(none).schema, view.merge, self.every, self.generation)

    def _seen(self) -> FoldedLog:
        """The latest event time of each batch."""
        one = T.StructType([T.StructField("ms", T.LongType())])
        return FoldedLog(f"{self.path}/seen", one, lambda rows: rows.agg(F.max("ms").alias("ms")), self.every, self.generation)

    def _late(self) -> FoldedLog:
        """Late rows are output: they are never folded."""
        return FoldedLog(f"{self.path}/late", self.schema, lambda rows: rows, 1 << 62, self.generation)

    def watermark(self, spark: SparkSession, before: int | None = None) -> int | None:
        latest = self._seen().current(spark, before).agg(F.max("ms")).first()[0]
        return None if latest is None else latest - self.delay_ms

    def sink(self):
        """``foreachBatch`` function that keeps the windows."""
        def _sink(batch: DataFrame, batch_id: int) -> None:
            spark, seen, windows = batch.sparkSession, self._seen(), self._windows(batch.sparkSession)
            if not seen.begin(spark, batch_id):
                return
            windows.begin(spark, batch_id)
            mark = self.watermark(spark, batch_id)
            rows = batch.where(F.col(self.time).isNotNull()).persist()
            try:
                late = F.lit(False) if mark is None else self._start() + self.width_ms <= mark
                self._late().write(rows.where(late), batch_id)
                windows.write(self._view().partial(rows.where(~late).withColumn(SIGN, F.lit(1).cast("long"))), batch_id)
                seen.write(rows.agg(F.max(self.time).alias("ms")), batch_id)
            finally:
                rows.unpersist()
        return _sink

    def read(self, spark: SparkSession) -> DataFrame:
        """(window_start_ms, window_end_ms, closed, _rows, sums) of every window."""
        mark = self.watermark(spark)
        end = F.col(START) + self.width_ms
        closed = F.lit(False) if mark is None else end <= mark
        out = self._view().result(self._windows(spark).current(spark))
        return out.select(START, end.alias(END), closed.alias("closed"), *[c for c in out.columns if c != START])

    def read_late(self, spark: SparkSession) -> DataFrame:
        """The rows that came too late, with ``batch``."""
        return self._late().history(spark)
