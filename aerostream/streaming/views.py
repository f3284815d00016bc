"""Continuously maintained views: the batch operators run as streaming queries.

Every view is the same ``DataFrame -> DataFrame`` function used in batch; this
module only chooses the output mode and starts the query with a checkpoint in
the shared checkpoint folder (``spark.checkpoint.dir``), so a restarted or
re-scheduled driver resumes from the last committed micro-batch and executor
loss is recovered from the state store checkpoints.

Without a watermark (the original views declare none) aggregation state grows
with the number of keys (airlines, airports, hourly windows, flights); pass
``watermark=`` to ``hourly_flight_summary`` to bound it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerostream.operators import state, views, words
from aerostream.session import checkpoint_path
from aerostream.streaming.retract import retraction_sink

# view name -> (builder over the flight stream, output mode)
FLIGHT_VIEWS: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {
    "delayed_flights": (views.delayed_flights, "append"),
    "airline_performance": (views.airline_performance, "update"),
    "hourly_flight_summary": (views.hourly_flight_summary, "update"),
    "airport_congestion": (views.airport_congestion, "update"),
    "flight_alerts": (views.flight_alerts, "append"),
    "latest_flight": (lambda f: state.latest_flight(f), "update"),
}


def start_view(df: DataFrame, name: str, output_mode: str, sink: str | Callable = "memory",
               checkpoint: str | None = None, trigger: dict | None = None,
               options: dict | None = None) -> StreamingQuery:
    """Start ``df`` as the streaming query ``name``.

    ``sink`` is a format name ("memory", "parquet", "kafka", ...) or a
    ``foreachBatch`` function ``(batch_df, batch_id) -> None``.
    """
    spark = df.sparkSession
    ckpt = checkpoint or checkpoint_path(spark, "views", name)
    w = df.writeStream.queryName(name).outputMode(output_mode).option("checkpointLocation", ckpt)
    if callable(sink):
        w = w.foreachBatch(sink)
    else:
        w = w.format(sink)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def start_flight_view(flights: DataFrame, name: str, sink: str | Callable = "memory", **kw) -> StreamingQuery:
    build, mode = FLIGHT_VIEWS[name]
    return start_view(build(flights), name, mode, sink, **kw)


def start_delayed_by_origin(flights: DataFrame, path: str, name: str = "delayed_by_origin", generation: int = 0, **kw) -> StreamingQuery:
    """Keep the retracting count under ``path``; see ``retract.read_delayed``."""
    return start_view(flights, name, "append", sink=retraction_sink(path, generation), **kw)


def word_count_stream(lines: DataFrame, mode: str = "java", value_col: str = "value") -> DataFrame:
    """Streaming (word, count); write with ``outputMode("update")``."""
    return words.word_count(lines, value_col, mode)


def last_per_key(updates: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Collapse a changelog (rows emitted per micro-batch in update mode) to the
    final row per key: the row of the highest ``order`` (batch id) wins."""
    payload = [c for c in updates.columns if c not in keys and c != order]
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.col(order)).alias("_v"))
    return last.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in payload])

