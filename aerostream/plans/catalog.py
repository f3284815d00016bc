"""Named catalogue of the queries, bound to the generated test tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads whole tables; lookup
entries take their key from fixed example values that exist in every scale.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostream.functions.flight import status_severity, trunc_div
from aerostream.operators import analytics, catalog, recent, sinktable, state, views, words
from aerostream.schema import ACTUAL, FLIGHT_FIELDS, FLIGHT_NUMBER, ORIGIN, SCHEDULED, SEQ, STATUS
from aerostream.session import checkpoint_path
from aerostream.sinks import kafka as ksink
from aerostream.sinks import table as tbl
from aerostream.sources.tables import TEST_AS_OF_MS, flights, lines, read_table

Query = Callable[[SparkSession, str], DataFrame]

# fixed values: example lookup keys used by the registered point lookups
EXAMPLE_FLIGHT = "FL1"
EXAMPLE_AIRPORT = "AP3"
EXAMPLE_WORD = "the"
UNKNOWN = "none"
UNKNOWN_WORD = "no word"


def _f(fn):
    return lambda spark, sf_dir: fn(flights(spark, sf_dir))


def _sink(fn, keep_seq=False):
    return lambda spark, sf_dir: fn(sinktable.flight_status_table(flights(spark, sf_dir), keep_seq=keep_seq))


def _recent_flights(f: DataFrame) -> DataFrame:
    return f.orderBy(F.desc(SCHEDULED), F.desc(SEQ)).limit(10).select(*FLIGHT_FIELDS)


def _worst_delays(f: DataFrame) -> DataFrame:
    d = views.delayed_flights(f, keep_seq=True)
    return d.orderBy(F.desc("delay_minutes"), F.desc(SEQ)).limit(20).drop(SEQ)


def _airlines_by_delay(f: DataFrame) -> DataFrame:
    return views.airline_performance(f).orderBy(F.desc("delay_percentage"), F.asc("airline"))


def _last_windows(f: DataFrame) -> DataFrame:
    return views.hourly_flight_summary(f).orderBy(F.desc("window_start")).limit(24)


def _top_congested(f: DataFrame) -> DataFrame:
    return views.airport_congestion(f).orderBy(F.desc("delay_rate_percentage"), F.asc("airport")).limit(10)


def _word_count_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as JSON records with a ``message`` field, counted by word."""
    docs = read_table(spark, sf_dir, "documents")
    return words.word_count_json(ksink.json_documents(docs.select(F.col("text").alias("message")), "value"))


def _word_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog topic's records: word, and its count as 8 bytes (in hex)."""
    return ksink.encode_word_counts(words.word_count(lines(spark, sf_dir))).select("key", F.hex("value").alias("value"))


def _alert_records(f: DataFrame) -> DataFrame:
    """The alert topic's records: the last alert of each flight as JSON, by flight."""
    return ksink.encode_alerts(views.flight_alerts_table(f))


def _severity(f: DataFrame) -> DataFrame:
    return state.latest_flight(f).select(FLIGHT_NUMBER, STATUS, status_severity(F.col(STATUS)).alias("severity"))


def _in_seconds(f: DataFrame) -> DataFrame:
    """The records with their times in epoch seconds."""
    return f.withColumns({c: trunc_div(F.col(c), 1000) for c in (SCHEDULED, ACTUAL)})


def _kept(df: DataFrame, key: str, order: str) -> Callable[[object], DataFrame]:
    """Point lookup in a keyed table that holds ``df``: the rows are added as a
    batch, then the key's row is read from the table."""
    spark = df.sparkSession
    path = checkpoint_path(spark, "lookups", uuid.uuid4().hex)
    tbl.upsert(df, path, key, order, 0)
    return lambda value: tbl.lookup(spark, path, key, value, order, df.schema)


def _flight_in_table(number: str):
    return _f(lambda f: _kept(f, FLIGHT_NUMBER, SEQ)(number).select(*FLIGHT_FIELDS))


def _delayed_in_table(airport: str):
    return _f(lambda f: state.get_delayed(_kept(state.delayed_by_origin(f), ORIGIN, "delayed_count")(airport), airport))


def _word_in_table(word: str):
    return lambda s, d: _kept(words.word_count(lines(s, d)), "word", "count")(word).select("word", "count")


QUERIES: dict[str, Query] = {
    # word counts over the text stream (documents as lines)
    "word_count_java": lambda s, d: words.word_count(lines(s, d), mode="java"),
    "word_count_sql": lambda s, d: words.word_count(lines(s, d), mode="sql"),
    "get_word": lambda s, d: words.lookup_word(lines(s, d), EXAMPLE_WORD, mode="java"),
    # keyed latest table, retracting count and lookups
    "latest_flight": _f(state.latest_flight),
    "delayed_by_origin": _f(lambda f: state.delayed_by_origin(f)),
    "get_flight": _f(lambda f: state.lookup_flight(f, EXAMPLE_FLIGHT)),
    "get_delayed": _f(lambda f: state.get_delayed(state.delayed_by_origin(f), EXAMPLE_AIRPORT)),
    "all_delayed": _f(lambda f: state.all_delayed(state.delayed_by_origin(f))),
    # the same records as JSON, as changelog records, and lookups in maintained tables
    "word_count_json": _word_count_json,
    "word_changelog": _word_changelog,
    "flight_severity": _f(_severity),
    "flight_alert_records": _f(_alert_records),
    "get_flight_table": _flight_in_table(EXAMPLE_FLIGHT),
    "get_flight_unknown": _flight_in_table(UNKNOWN),
    "get_delayed_table": _delayed_in_table(EXAMPLE_AIRPORT),
    "get_delayed_unknown": _delayed_in_table(UNKNOWN),
    "get_word_table": _word_in_table(EXAMPLE_WORD),
    "get_word_unknown": _word_in_table(UNKNOWN_WORD),
    # maintained views, the alert sink and the reads over them
    "delayed_flights": _f(views.delayed_flights),
    "airline_performance": _f(views.airline_performance),
    "hourly_flight_summary": _f(views.hourly_flight_summary),
    "airport_congestion": _f(views.airport_congestion),
    "flight_alerts": _f(views.flight_alerts),
    "flight_alerts_table": _f(views.flight_alerts_table),
    "recent_flights": _f(_recent_flights),
    "worst_delays": _f(_worst_delays),
    "airlines_by_delay": _f(_airlines_by_delay),
    "last_windows": _f(_last_windows),
    "top_congested": _f(_top_congested),
    # time-relative catalogue queries
    "recent_cancelled": _f(lambda f: recent.recent_cancelled(f, as_of_ms=TEST_AS_OF_MS)),
    "enriched_flights": _f(lambda f: recent.enriched_flights(f, as_of_ms=TEST_AS_OF_MS)),
    # snapshot analytics
    "flight_count": _f(analytics.flight_count),
    "flight_columns": _f(analytics.described),
    "delay_by_airline": _f(analytics.delay_by_airline),
    "busiest_routes": _f(analytics.busiest_routes),
    "delay_by_hour": _f(analytics.delay_by_hour),
    "delay_by_hour_seconds": _f(lambda f: analytics.delay_by_hour(_in_seconds(f), unit="s")),
    "airport_comparison": _f(analytics.airport_comparison),
    "status_share": _f(analytics.status_share),
    "delay_by_weekday": _f(analytics.delay_by_weekday),
    "delay_buckets": _f(analytics.delay_buckets),
    "snapshot": _f(lambda f: catalog.snapshot(f, 100)),
    # relational sink table and its reads
    "flight_status_sink": _sink(lambda t: t),
    "sink_overview": _sink(sinktable.overview),
    "sink_count": _sink(sinktable.table_count),
    "sink_columns": _sink(analytics.described),
    "sink_recent": _sink(sinktable.recent, keep_seq=True),
    "sink_by_status": _sink(sinktable.by_status),
    "sink_by_airline": _sink(sinktable.by_airline),
    "sink_late": _sink(sinktable.late_rows),
}

from aerostream.plans.streams import STREAM_QUERIES  # noqa: E402

QUERIES.update(STREAM_QUERIES)

FLAGSHIP = "airline_performance"
