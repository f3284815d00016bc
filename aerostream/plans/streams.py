"""Catalogue entries that run the streaming path end to end over the test tables.

A table arrives as files, a share of them per micro-batch, in ``STEPS`` batches at
least (file source, ``availableNow``); the streaming operator runs with its state
store, and each micro-batch is written through the real sink into a table under
the shared checkpoint folder; the entry returns that table. Update-mode results
go through the keyed upsert sink (batch id orders the updates), append-mode
results are appended.

``*_steps`` entries let the rows arrive in ``STEPS`` steps by their id, the query
started again from its checkpoint each time, and return the maintained view as
it is after every step (``batch``). They fold their state every second batch.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aerostream.operators import state, views, words
from aerostream.operators.catalog import export_parquet
from aerostream.operators.sinktable import SINK_COLUMNS, flatten_for_table
from aerostream.schema import FLIGHT_FIELDS, FLIGHT_NUMBER, FLIGHT_SCHEMA, SCHEDULED, SEQ, SEQUENCED_FLIGHT_SCHEMA, SINK_KEY
from aerostream.session import checkpoint_path
from aerostream.sinks import kafka as ksink
from aerostream.sinks import table as tbl
from aerostream.sources import kafka as ksrc
from aerostream.sources.files import import_table, parquet_view
from aerostream.sources.tables import flights_from_events, read_table, text_lines
from aerostream.streaming import flightviews
from aerostream.streaming import sql as streamsql
from aerostream.streaming.apps import read_state
from aerostream.streaming.log import with_long
from aerostream.streaming.maintained import SumView, current_sink, log_sink, read_view_changes
from aerostream.streaming.metrics import ViewMetrics, counted, read_metrics
from aerostream.streaming.retract import read_changes, read_delayed, retraction_sink
from aerostream.streaming.views import start_view
from aerostream.streaming.windows import ClosingWindows

# micro-batches, or steps, in which a table arrives
STEPS = 4
# batches between two folds of the entries' state
FOLD_EVERY = 2


def arriving(df: DataFrame, source: str, by: str) -> DataFrame:
    """``df`` as a file stream that arrives by ranges of ``by`` in ``STEPS`` batches."""
    spark = df.sparkSession
    df.repartitionByRange(2 * STEPS, by).write.parquet(source)
    files = len(spark.read.schema(df.schema).parquet(source).inputFiles())
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", max(1, -(-files // STEPS))).parquet(source)


def _table_stream(spark: SparkSession, sf_dir: str, name: str, by: str) -> DataFrame:
    return arriving(read_table(spark, sf_dir, name), os.path.join(_run_dir(spark, f"{name}-files"), "in"), by)


def _run_dir(spark: SparkSession, name: str) -> str:
    return checkpoint_path(spark, "catalogue", name, uuid.uuid4().hex)


def run_update(df: DataFrame, name: str, key: str) -> DataFrame:
    """Run an update-mode stream to completion; return the final row per key."""
    spark = df.sparkSession
    base = _run_dir(spark, name)
    target = os.path.join(base, "table")
    q = start_view(df, f"{name}-{os.path.basename(base)}", "update", sink=tbl.upsert_sink(target, key),
                   checkpoint=os.path.join(base, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    schema = T.StructType([*df.schema.fields, T.StructField("_batch", T.LongType())])
    return tbl.read_keyed(spark, target, key, "_batch", schema).drop("_batch")


def run_append(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    base = _run_dir(spark, name)
    target = os.path.join(base, "table")
    q = start_view(df, f"{name}-{os.path.basename(base)}", "append", sink="parquet",
                   checkpoint=os.path.join(base, "ckpt"), trigger={"availableNow": True},
                   options={"path": target})
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(target)


def _flights_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from_events(_table_stream(spark, sf_dir, "events", "event_id"))


def stepped(table: DataFrame, ident: str, name: str, build: Callable[[DataFrame], DataFrame], sink: Callable[[str], Callable],
            after: Callable[[str, int], None] | None = None, mode: str = "append",
            done: Callable[[StreamingQuery], None] | None = None) -> str:
    """Let ``table`` arrive in ``STEPS`` steps by ``ident``: each step's files are
    added to the input folder, then the query over ``build`` is started again
    from its checkpoint and works off what is new. ``after`` is called with the
    target and the step. Returns the target folder."""
    spark = table.sparkSession
    base = _run_dir(spark, name)
    source, target = os.path.join(base, "in"), os.path.join(base, "table")
    first, last = table.agg(F.min(ident), F.max(ident)).first()
    if first is None:
        return target
    step = F.expr(f"({ident} - {first}L) * {STEPS}L div {last - first + 1}L")
    for k in range(STEPS):
        table.where(step == k).write.parquet(os.path.join(source, f"step-{k}"))
        stream = spark.readStream.schema(table.schema).option("recursiveFileLookup", True).parquet(source)
        q = start_view(build(stream), f"{name}-{os.path.basename(base)}", mode, sink=sink(target),
                       checkpoint=os.path.join(base, "ckpt"), trigger={"availableNow": True})
        q.awaitTermination()
        if done:
            done(q)
        if after:
            after(target, k)
    return target


def _after_steps(spark: SparkSession, sf_dir: str, name: str, sink: Callable[[str], Callable],
                 read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """The view over the flights as it is after each step, with ``batch``."""
    kept: dict = {}

    def keep(target: str, k: int) -> None:
        now = read(spark, target)
        kept["schema"], kept["path"] = now.schema, os.path.join(os.path.dirname(target), "after")
        now.write.parquet(os.path.join(kept["path"], f"batch={k}"))

    target = stepped(read_table(spark, sf_dir, "events"), "event_id", name, flights_from_events, sink, keep)
    if not kept:
        return read(spark, target).withColumn("batch", F.lit(0).cast("long"))
    return spark.read.schema(with_long(kept["schema"], "batch")).parquet(kept["path"])


def report_after_steps(name: str, kept: tuple[str, ...], read: Callable[[SparkSession, str], DataFrame], current: bool = False):
    """A report kept over the record log, or over each flight's newest record."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        every = flightviews.report_views()
        mine = {n: every[n] for n in kept}

        def sink(path: str):
            if current:
                return current_sink(path, mine, FLIGHT_NUMBER, SEQ, FOLD_EVERY)
            return log_sink(path, mine, FOLD_EVERY)

        return _after_steps(spark, sf_dir, name, sink, read)
    return run


def _retracted(spark: SparkSession, sf_dir: str) -> str:
    return stepped(read_table(spark, sf_dir, "events"), "event_id", "delayed_by_origin", flights_from_events,
                   lambda path: retraction_sink(path, every=FOLD_EVERY))


def delayed_by_origin_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts after the last step; an origin that fell to 0 stays."""
    return read_delayed(spark, _retracted(spark, sf_dir))


def delayed_by_origin_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed change and new count per origin after each step."""
    return read_changes(spark, _retracted(spark, sf_dir))


def word_changelog_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog topic's records of every step: each word that the step's
    documents hold, and its count after the step as 8 bytes (in hex)."""
    kept = {"words": SumView({"word": F.col("word")})}
    schema = T.StructType([T.StructField("word", T.StringType())])
    target = stepped(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "word_changelog",
                     lambda docs: words.words(text_lines(docs)), lambda path: log_sink(path, kept, FOLD_EVERY))
    return word_changes(read_view_changes(spark, target, kept, "words", schema))


def word_changes(changes: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    so_far = Window.partitionBy("word").orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = changes.select("batch", "word", F.sum("_rows").over(so_far).alias("count"))
    return counts.select("batch", F.col("word").alias("key"), F.hex(ksink.long_be_bytes(F.col("count"))).alias("value"))


def latest_flight_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_update(state.latest_flight(_flights_stream(spark, sf_dir)), "latest_flight", "flightNumber")
    return out.select(*FLIGHT_FIELDS)


def word_count_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table_stream(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    lines = text_lines(docs)
    return run_update(words.word_count(lines), "word_count", "word").select("word", "count")


def flight_status_sink_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records -> per-record sink transform -> keyed upsert (last write wins)."""
    rows = flatten_for_table(_flights_stream(spark, sf_dir), keep_seq=True)
    base = _run_dir(spark, "flight_status_sink")
    target = os.path.join(base, "table")
    q = start_view(rows, f"flight_status_sink-{os.path.basename(base)}", "append",
                   sink=tbl.upsert_sink(target, SINK_KEY, "stored_seq"),
                   checkpoint=os.path.join(base, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    return tbl.read_keyed(spark, target, SINK_KEY, "stored_seq", rows.schema).select(*SINK_COLUMNS)


def flight_alerts_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_append(views.flight_alerts(_flights_stream(spark, sf_dir)), "flight_alerts")


def view_streamed(name: str, key: str | None):
    """A maintained view run as a stream over the events table: update-mode views
    are upserted by ``key``, append-mode views (``key=None``) appended."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from aerostream.streaming.views import FLIGHT_VIEWS

        build, _mode = FLIGHT_VIEWS[name]
        out = build(_flights_stream(spark, sf_dir))
        if key is None:
            return run_append(out, name)
        return run_update(out, name, key).select(*out.columns)
    return run


# ------------------------------------------------------------------- topics, SQL text, metrics, import

FLIGHTS_TOPIC = ksrc.Topic("flights", key="long", value="json", value_schema=FLIGHT_SCHEMA)
LINES_TOPIC = ksrc.Topic("lines", value="string")
# fixed values: of the rendered records these cannot be read
BAD_VALUE, BAD_KEY, BAD_TEXT = "event_id % 97 = 0", "event_id % 89 = 0", "doc_id % 50 = 0"


def flight_records(events: DataFrame, bad: bool = True) -> DataFrame:
    """Events as the records of the flight topic: keyed by an 8-byte number, JSON
    values; with ``bad``, some values are cut short and some keys, too."""
    f = flights_from_events(events.where(F.col("event_id").isNotNull()))
    json = F.to_json(F.struct(*FLIGHT_FIELDS), {"ignoreNullFields": "false"})
    user = F.substring(FLIGHT_NUMBER, 3, 30).cast("long")
    key, seq = ksink.long_be_bytes(user), F.col(SEQ).alias("event_id")
    rows = f.select(seq, key.alias("key"), json.alias("json"), F.col(SCHEDULED).alias("ms"), (user % 3).cast("int").alias("partition"))
    if bad:
        rows = rows.withColumns({"json": F.expr(f"if({BAD_VALUE}, left(json, length(json) - 5), json)"),
                                 "key": F.expr(f"if({BAD_KEY}, substring(key, 2, 7), key)")})
    return rows.select("key", F.encode("json", "utf-8").alias("value"), F.lit(FLIGHTS_TOPIC.name).alias("topic"), "partition",
                       F.col("event_id").alias("offset"), F.timestamp_millis("ms").alias("timestamp"))


def line_records(docs: DataFrame) -> DataFrame:
    """Texts as the records of the line topic, some not UTF-8."""
    value = F.expr(f"if({BAD_TEXT}, concat(unhex('FF'), encode(text, 'utf-8')), encode(text, 'utf-8'))")
    return docs.select(F.lit(None).cast("binary").alias("key"), value.alias("value"), F.lit(LINES_TOPIC.name).alias("topic"),
                       F.lit(0).alias("partition"), F.col("doc_id").alias("offset"), F.timestamp_seconds(F.lit(0)).alias("timestamp"))


def topic_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the flight topic that can be read, with their place in it."""
    rows = ksrc.flight_rows(flight_records(read_table(spark, sf_dir, "events")), FLIGHTS_TOPIC)
    return rows.select(F.col(f"{SEQ}.partition").alias("partition"), F.col(f"{SEQ}.offset").alias("offset"), *FLIGHT_FIELDS)


def topic_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those of both topics that cannot, with the reason."""
    records = flight_records(read_table(spark, sf_dir, "events")).unionByName(line_records(read_table(spark, sf_dir, "documents")))
    return ksrc.bad_records(records, [FLIGHTS_TOPIC, LINES_TOPIC])


# the views' statements; {flights} and {delayed} are the names of the views they read
DELAYED_SQL = """SELECT flightNumber, airline, origin, destination, scheduledDeparture, actualDeparture,
  (actualDeparture - scheduledDeparture) / 60000D AS delay_minutes, status
FROM {flights} WHERE actualDeparture > scheduledDeparture + 900000"""
ALERTS_SQL = """SELECT flightNumber, airline, origin, destination, delay_minutes, 'CRITICAL_DELAY' AS alert_type,
  timestampadd(SECOND, actualDeparture div 1000, timestamp_ntz'1970-01-01 00:00:00') AS alert_timestamp
FROM {delayed} WHERE delay_minutes > 60"""
AIRLINES_SQL = """SELECT airline, count(*) AS total_flights, count_if(status = 'DELAYED') AS delayed_count,
  count_if(status = 'CANCELLED') AS cancelled_count,
  ((count_if(status = 'DELAYED') * 20000 + count(*)) div (2 * count(*))) / 100D AS delay_percentage,
  CAST(sum(greatest(coalesce(actualDeparture - scheduledDeparture, 0), 0)) AS DOUBLE) / CAST(count(*) * 60000 AS DOUBLE) AS avg_delay_minutes
FROM {flights} GROUP BY airline"""


def sql_streamed(name: str, statement: str, key: str | None):
    """A statement over the flight topic's view, run as a query in several batches."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = _run_dir(spark, name)
        prefix = f"t{uuid.uuid4().hex}_"
        records = arriving(flight_records(read_table(spark, sf_dir, "events"), bad=False), os.path.join(base, "in"), "offset")
        topic, delayed = ksrc.register_topics(records, [FLIGHTS_TOPIC], prefix)[0], f"{prefix}delayed"
        try:
            streamsql.sql_view(spark, delayed, DELAYED_SQL.replace("{flights}", topic))
            text = statement.replace("{flights}", topic).replace("{delayed}", delayed)
            q = streamsql.start_sql(spark, f"{name}-{os.path.basename(base)}", text, os.path.join(base, "table"),
                                    os.path.join(base, "ckpt"), key, {"availableNow": True})
            q.query.awaitTermination()
            return q.result()
        finally:
            for view in (topic, delayed):
                spark.catalog.dropTempView(view)
    return run


def view_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in, airlines changed and airlines held of each step of a running view."""
    path = _run_dir(spark, "view_metrics-rows")
    listener = ViewMetrics(spark, path, lambda n: "airline_performance" if n.startswith("view_metrics-") else None)
    spark.streams.addListener(listener)
    try:
        stepped(read_table(spark, sf_dir, "events"), "event_id", "view_metrics",
                lambda ev: counted(flights_from_events(ev), views.airline_performance),
                lambda target: tbl.upsert_sink(target, "airline"), mode="update", done=lambda q: listener.wait_for(q.runId))
    finally:
        spark.streams.removeListener(listener)
    return read_metrics(spark, path)


def state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per airline, read from the state of a stopped query's checkpoint."""
    base = _run_dir(spark, "state_rows")
    counts = _flights_stream(spark, sf_dir).groupBy("airline").agg(F.count(F.lit(1)).alias("records"))
    start_view(counts, f"state_rows-{os.path.basename(base)}", "update", sink=tbl.upsert_sink(os.path.join(base, "table"), "airline"),
               checkpoint=os.path.join(base, "ckpt"), trigger={"availableNow": True}).awaitTermination()
    rows = read_state(spark, os.path.join(base, "ckpt"))
    return rows.select(F.col("key.airline").alias("airline"), F.col("value.count").alias("records"))


def replayed_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record log after a reset: a second generation, replayed from the start."""
    name = f"replayed-{uuid.uuid4().hex}"
    stream, target = _flights_stream(spark, sf_dir), os.path.join(_run_dir(spark, "replayed_flights"), "table")
    for generation in (1, 2):
        tbl.replay(lambda: stream, name, generation, target, trigger={"availableNow": True}).awaitTermination()
    return tbl.read_replayed(spark, target, 2)


def exported_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights, exported to Parquet by airline and read back as a view."""
    path = os.path.join(_run_dir(spark, "exported_flights"), "parquet")
    export_parquet(flights_from_events(read_table(spark, sf_dir, "events")), path, partition_by=["airline"])
    return parquet_view(spark, path, f"exported_{uuid.uuid4().hex}").select(SEQ, *FLIGHT_FIELDS)


# fixed values: windows of an hour, rows may be a day late; every tenth event comes half the table late
HOUR_MS, DAY_MS, LATE = 3_600_000, 86_400_000, 10


def closing_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights per hour from events that come out of order: closed and open
    windows, and how many rows of an hour came after it had closed."""
    events = read_table(spark, sf_dir, "events")
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    span = 0 if first is None else last - first + 1
    events = events.withColumn("arrives", F.col("event_id") + F.when(F.col("event_id") % LATE == 0, F.lit(span // 2)).otherwise(F.lit(0)))
    kept = {}

    def sink(path: str):
        kept["windows"] = ClosingWindows(path, SEQUENCED_FLIGHT_SCHEMA, SCHEDULED, HOUR_MS, DAY_MS, every=FOLD_EVERY)
        return kept["windows"].sink()

    stepped(events, "arrives", "closing_windows", flights_from_events, sink)
    if not kept:
        return spark.createDataFrame([], "state string, window_start_ms long, flights long")
    w = kept["windows"]
    state_of = F.when(F.col("closed"), "closed").otherwise("open")
    late = w.read_late(spark).select(((F.col(SCHEDULED) - F.pmod(SCHEDULED, F.lit(HOUR_MS)))).alias("window_start_ms")) \
        .groupBy("window_start_ms").agg(F.count(F.lit(1)).alias("flights"))
    return w.read(spark).select(state_of.alias("state"), "window_start_ms", F.col("_rows").alias("flights")) \
        .unionByName(late.select(F.lit("late").alias("state"), "window_start_ms", "flights"))


def evolving_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose columns grow from step to step, in a table that keeps its
    schema: new columns, an int that becomes a bigint, a float that becomes a double."""
    shapes = [("event_id int", "event_type string"), ("event_id int", "event_type string", "value float"),
              ("event_id bigint", "event_type string", "value double", "user_id int"), ("event_id int", "user_id bigint")]

    def shaped(batch: DataFrame, batch_id: int) -> DataFrame:
        return batch.selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in shapes[batch_id % len(shapes)]])

    target = stepped(read_table(spark, sf_dir, "events"), "event_id", "evolving_table", lambda ev: ev,
                     lambda path: tbl.evolving_sink(path, shaped))
    return tbl.read_evolving(spark, target)


def import_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read of the events that ends in time and one that never does: rows
    imported, and whether the stand-in took the table's place."""
    out = None
    for name, seconds in (("in time", 600.0), ("too slow", 2.0)):
        read = lambda slow=name == "too slow": _endless(_events_read(spark, sf_dir)) if slow else _events_read(spark, sf_dir)
        got = import_table(spark, read, os.path.join(_run_dir(spark, "import_limits"), "table"), seconds)
        row = got.table.agg(F.lit(name).alias("read"), F.count(F.lit(1)).alias("rows"), F.lit(got.cut).alias("cut"))
        out = row if out is None else out.unionByName(row)
    return out


def _events_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from_events(read_table(spark, sf_dir, "events"))


def _endless(df: DataFrame) -> DataFrame:
    """``df`` from a source that stops answering after its first rows."""
    def stall(batches):
        import time

        yield from batches
        while True:
            time.sleep(0.1)

    return df.mapInArrow(stall, df.schema)


STREAM_QUERIES = {
    "delayed_flights_stream": view_streamed("delayed_flights", None),
    "airline_performance_stream": view_streamed("airline_performance", "airline"),
    "hourly_flight_summary_stream": view_streamed("hourly_flight_summary", "window_start"),
    "airport_congestion_stream": view_streamed("airport_congestion", "airport"),
    "delayed_by_origin_stream": delayed_by_origin_streamed,
    "delayed_by_origin_changes": delayed_by_origin_changes,
    "latest_flight_stream": latest_flight_streamed,
    "word_count_stream": word_count_streamed,
    "flight_status_sink_stream": flight_status_sink_streamed,
    "flight_alerts_stream": flight_alerts_streamed,
    # maintained reports after each step
    "word_changelog_steps": word_changelog_steps,
    "busiest_routes_steps": report_after_steps("busiest_routes", ("routes",), flightviews.busiest_routes),
    "delay_buckets_steps": report_after_steps("delay_buckets", ("buckets",), flightviews.delay_buckets),
    "status_share_steps": report_after_steps("status_share", ("statuses", "flights"), flightviews.status_share),
    "worst_delays_steps": report_after_steps("worst_delays", ("worst",), flightviews.worst_delays),
    "recent_flights_steps": report_after_steps("recent_flights", ("recent",), flightviews.recent_flights),
    "current_routes_steps": report_after_steps(
        "current_routes", ("routes",), lambda s, p: flightviews.busiest_routes(s, p, min_flights=1), current=True),
    "current_buckets_steps": report_after_steps("current_buckets", ("buckets",), flightviews.delay_buckets, current=True),
    # topics by declared decoders, SQL text as streams, progress of a view, imports
    "topic_flights": topic_flights,
    "topic_bad_records": topic_bad_records,
    "sql_delayed_flights_stream": sql_streamed("sql_delayed_flights", DELAYED_SQL, None),
    "sql_flight_alerts_stream": sql_streamed("sql_flight_alerts", ALERTS_SQL, None),
    "sql_airline_performance_stream": sql_streamed("sql_airline_performance", AIRLINES_SQL, "airline"),
    "view_metrics": view_metrics,
    "closing_windows": closing_windows,
    "state_rows": state_rows,
    "replayed_flights": replayed_flights,
    "exported_flights": exported_flights,
    "evolving_table": evolving_table,
    "import_limits": import_limits,
}

# the batch query whose oracle an entry equals after each step, over the records so far or over the newest of each flight
STEPS_ORACLE_OF = {f"{name}_steps": name for name in ("busiest_routes", "delay_buckets", "status_share", "worst_delays", "recent_flights")}
CURRENT_ORACLE_OF = {"current_routes_steps": "busiest_routes", "current_buckets_steps": "delay_buckets"}

# the batch query whose oracle each streamed entry must equal
STREAM_ORACLE_OF = {
    "delayed_flights_stream": "delayed_flights",
    "airline_performance_stream": "airline_performance",
    "hourly_flight_summary_stream": "hourly_flight_summary",
    "airport_congestion_stream": "airport_congestion",
    "latest_flight_stream": "latest_flight",
    "word_count_stream": "word_count_java",
    "flight_status_sink_stream": "flight_status_sink",
    "flight_alerts_stream": "flight_alerts",
    "sql_delayed_flights_stream": "delayed_flights",
    "sql_flight_alerts_stream": "flight_alerts",
    "sql_airline_performance_stream": "airline_performance",
}
