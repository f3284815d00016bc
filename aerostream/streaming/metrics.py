"""Progress of running views, batch by batch, as a table.

``counted`` puts observed counters around a view: they are filled while the batch
runs, so nothing is computed a second time. ``ViewMetrics`` listens to the queries
of the session and writes one row per view and batch: rows that came in, rows
the view changed, rows its state holds. A batch that runs again replaces its row.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from aerostream.sinks.table import read_if_there

ROWS_IN, ROWS_CHANGED = "rows_in", "rows_changed"
ROW = T.StructType([T.StructField(n, T.LongType()) for n in (ROWS_IN, ROWS_CHANGED, "state_rows")])
METRICS = T.StructType([*ROW.fields, T.StructField("view", T.StringType()), T.StructField("batch", T.LongType())])


def counted(stream: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``build(stream)`` with the rows before and after it counted."""
    count = F.count(F.lit(1))
    return build(stream.observe(ROWS_IN, count.alias("n"))).observe(ROWS_CHANGED, count.alias("n"))


class ViewMetrics(StreamingQueryListener):
    """Writes the metrics of counted queries to ``path``.

    ``names`` maps a query's name to the view's."""

    def __init__(self, spark: SparkSession, path: str, names: Callable[[str], str | None]):
        self.spark, self.path, self.names = spark, path, names
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        view = self.names(p.name or "")
        seen = p.observedMetrics or {}
        if view is None or ROWS_IN not in seen:
            return
        state = sum(op.numRowsTotal for op in p.stateOperators)
        row = (seen[ROWS_IN]["n"], seen[ROWS_CHANGED]["n"] if ROWS_CHANGED in seen else None, state)
        self.spark.createDataFrame([row], ROW).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/view={view}/batch={p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def wait_for(self, run_id, seconds: float = 60) -> None:
        """Wait until everything a run reported has been written: its end is the
        last event of a run."""
        with self._news:
            if not self._news.wait_for(lambda: str(run_id) in self._ended, seconds):
                raise TimeoutError(f"no end of run {run_id} was reported")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(view, batch, rows_in, rows_changed, state_rows)."""
    return read_if_there(spark, path, METRICS).select("view", "batch", *ROW.names)
