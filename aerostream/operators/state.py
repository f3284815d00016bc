"""Keyed latest-value table and the retracting delayed count, batch form.

``latest_flight`` keeps, per flight, the record that arrived last (arrival order
``seq``, never event time); see ``latest_by_key`` for its rule on nulls and ties.

``delayed_by_origin`` counts currently-delayed flights per origin over that
table. Because it starts from the latest record per flight, a flight that
changed origin or stopped being delayed is counted only where it is now, which
is exactly what the streaming subtractor achieves incrementally
(``aerostream.streaming.retract``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostream.functions.flight import count_severity, status_is
from aerostream.schema import DELAYED, FLIGHT_FIELDS, FLIGHT_NUMBER, ORIGIN, SEQ


# fixed values: fields of an arrival order read from a topic (see ``sources.kafka.arrival``)
ARRIVAL_FIELDS = ["partition", "offset", "ms"]


def _by_partition(df: DataFrame, order: str) -> bool:
    dt = df.schema[order].dataType
    return isinstance(dt, T.StructType) and dt.names == ARRIVAL_FIELDS


def newest_per_partition(df: DataFrame, key: str, order: str, payload: list[str], first: tuple[str, ...] = (),
                         last: tuple[str, ...] = ()) -> DataFrame:
    """The rows that can still be a key's newest: one per key, or one per key
    and topic partition where ``order`` is an arrival struct, as only offsets of
    one partition tell which record came later. ``first`` and ``last`` are columns
    that count before and after the order."""
    by = [F.col(f"{order}.partition").alias("_partition")] if _by_partition(df, order) else []
    rest = [c for c in payload if c not in (order, *first, *last)]
    top = df.groupBy(key, *by).agg(F.max(F.struct(*first, order, *last, *rest)).alias("_last"))
    return top.select(key, *[F.col(f"_last.{c}").alias(c) for c in dict.fromkeys([*payload, *first, order, *last])])


def latest_by_key(df: DataFrame, key: str, order: str, payload: list[str], first: tuple[str, ...] = (),
                  last: tuple[str, ...] = ()) -> DataFrame:
    """Row with the highest ``order`` per ``key``, one plan for every size.

    ``max(struct(order, payload))``: a null order loses against any other, equal
    orders go to the greater payload, so the result never depends on the plan or
    on the order of rows. A null key is a key of its own. Partial aggregation
    runs before the shuffle (a sort-based aggregate that spills), so a hot key
    costs one row per task. Works on batch and streaming input.

    An arrival struct orders the records of a partition by offset; the newest of
    each partition are then held against each other by time. That takes two
    groupings, which streaming aggregations do not allow: such streams keep their
    newest records in a sink (``streaming.maintained``, ``sinks.table``).
    """
    rows = newest_per_partition(df, key, order, payload, first, last)
    if not _by_partition(df, order):
        return rows.select(key, *payload)
    rest = [c for c in payload if c not in (order, *first, *last)]
    top = rows.groupBy(key).agg(F.max(F.struct(*first, F.col(f"{order}.ms").alias("_ms"), order, *last, *rest)).alias("_last"))
    return top.select(key, *[F.col(f"_last.{c}").alias(c) for c in payload])


def latest_flight(flights: DataFrame, order: str = SEQ, keep_order: bool = False) -> DataFrame:
    """Last record per ``flightNumber`` by ``order``. Records without a flight
    number have no place in a table keyed by it and are left out."""
    payload = [c for c in FLIGHT_FIELDS if c != FLIGHT_NUMBER]
    if keep_order:
        payload.append(order)
    return latest_by_key(flights.where(F.col(FLIGHT_NUMBER).isNotNull()), FLIGHT_NUMBER, order, payload)


def delayed_by_origin(flights: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """(origin, delayed_count): current flights per origin whose status is DELAYED."""
    cur = latest if latest is not None else latest_flight(flights)
    return (
        cur.where(F.col(ORIGIN).isNotNull())
        .groupBy(ORIGIN)
        .agg(F.sum(F.when(status_is(DELAYED), F.lit(1)).otherwise(F.lit(0))).cast("long").alias("delayed_count"))
    )


def get_flight(latest: DataFrame, flight_number: str) -> DataFrame:
    """The current record of one flight; empty result = not found."""
    return latest.where(F.col(FLIGHT_NUMBER) == F.lit(flight_number))


def lookup_flight(flights: DataFrame, flight_number: str, order: str = SEQ) -> DataFrame:
    """Current record of one flight straight from the record log: the key
    predicate is applied before the latest-record step, so it reaches the scan
    (row groups of a log sorted by flight are skipped by their statistics)."""
    return latest_flight(flights.where(F.col(FLIGHT_NUMBER) == F.lit(flight_number)), order)


def get_delayed(delayed: DataFrame, airport: str) -> DataFrame:
    """Exactly one row (airport, delayedCount); 0 for an unknown airport.

    A global aggregate always yields one row, so no join or driver round trip
    is needed for the default.
    """
    hit = delayed.where(F.col(ORIGIN) == F.lit(airport))
    return hit.agg(F.coalesce(F.sum("delayed_count"), F.lit(0)).cast("long").alias("delayedCount")) \
        .select(F.lit(airport).alias("airport"), "delayedCount")


def all_delayed(delayed: DataFrame) -> DataFrame:
    """Every airport with its count and dashboard severity, most delayed first."""
    return delayed.select(
        F.col(ORIGIN).alias("airport"),
        F.col("delayed_count"),
        count_severity(F.col("delayed_count")).alias("severity"),
    ).orderBy(F.desc("delayed_count"), F.asc("airport"))
