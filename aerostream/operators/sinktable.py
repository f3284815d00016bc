"""The relational flight-status table kept by the upsert sink, and its reads.

``flight_status_table`` is what the keyed upsert converges to: the last record
per flight (arrival order), times formatted as UTC ``yyyy-MM-dd HH:mm:ss``
strings, fields renamed. ``stored_seq`` (kept on request) plays the role of the
row id of the most recent write, used by ``recent``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostream.functions.flight import format_epoch
from aerostream.operators.state import latest_flight
from aerostream.schema import ACTUAL, SCHEDULED, SEQ, SINK_KEY, SINK_RENAMES, SINK_TIME_FORMAT

SINK_COLUMNS = list(SINK_RENAMES.values())


def flatten_for_table(records: DataFrame, unit: str = "ms", keep_seq: bool = False) -> DataFrame:
    """Per-record transform of the sink: format the two times, then rename."""
    cols = []
    for src, dst in SINK_RENAMES.items():
        c = format_epoch(src, unit, SINK_TIME_FORMAT) if src in (SCHEDULED, ACTUAL) else F.col(src)
        cols.append(c.alias(dst))
    if keep_seq:
        cols.append(F.col(SEQ).alias("stored_seq"))
    return records.select(*cols)


def flight_status_table(flights: DataFrame, unit: str = "ms", keep_seq: bool = False) -> DataFrame:
    latest = latest_flight(flights, keep_order=keep_seq)
    return flatten_for_table(latest, unit, keep_seq)


def overview(table: DataFrame, limit: int = 10) -> DataFrame:
    """Earliest scheduled rows."""
    return table.select(*SINK_COLUMNS).orderBy(
        F.asc("scheduled_departure_time"), F.asc(SINK_KEY)).limit(limit)


def table_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("row_count"))


def recent(table: DataFrame, limit: int = 5) -> DataFrame:
    """Most recently written rows (needs ``stored_seq``)."""
    return table.orderBy(F.desc("stored_seq")).limit(limit).select(
        SINK_KEY, "airline", "departure_airport", "arrival_airport", "scheduled_departure_time", "status")


def by_status(table: DataFrame) -> DataFrame:
    return table.groupBy("status").agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.desc("count"), F.asc("status"))


def by_airline(table: DataFrame) -> DataFrame:
    return table.groupBy("airline").agg(F.count(F.lit(1)).alias("flight_count")) \
        .orderBy(F.desc("flight_count"), F.asc("airline"))


def late_rows(table: DataFrame, limit: int = 10) -> DataFrame:
    """Rows whose actual time string sorts after the scheduled one (seconds
    resolution, as stored), latest scheduled first."""
    a, s = F.col("actual_departure_time"), F.col("scheduled_departure_time")
    return table.where(a.isNotNull() & (a > s)).select(*SINK_COLUMNS) \
        .orderBy(F.desc("scheduled_departure_time"), F.asc(SINK_KEY)).limit(limit)
