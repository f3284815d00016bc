"""Time-relative catalogue queries ("now" is a parameter, epoch ms).

With ``as_of_ms=None`` the current time of the query is used, as the original
``NOW()`` / ``CURRENT_TIMESTAMP`` do; tests pass a fixed instant. The time
filter is on the raw ``scheduledDeparture`` column, so on a table partitioned
or sorted by it the predicate prunes files / row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostream.functions.flight import (
    departure_status, epoch_to_ts, hour_of_day, per_second, scheduled_between, time_of_day, whole_delay_minutes,
)
from aerostream.sources.layout import DATE_COL
from aerostream.schema import ACTUAL, AIRLINE, CANCELLED, DESTINATION, FLIGHT_NUMBER, ORIGIN, SCHEDULED, STATUS

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def _now_ms(as_of_ms: int | None) -> Column:
    return F.lit(as_of_ms).cast("long") if as_of_ms is not None else F.unix_millis(F.current_timestamp())


def _now_in_unit(as_of_ms: int | None, unit: str) -> Column:
    """Now in the record's time unit (fractional seconds kept for ``unit="s"``)."""
    now = _now_ms(as_of_ms)
    return now if unit == "ms" else now / F.lit(1000.0)


def _now_ts(as_of_ms: int | None) -> Column:
    """The instant as ``timestamp_ntz`` (UTC wall clock, millisecond precision)."""
    return F.timestamp_add("MILLISECOND", _now_ms(as_of_ms), F.expr(_EPOCH_NTZ))


def _prune_dates(flights: DataFrame, lo: Column, hi: Column | None, unit: str) -> DataFrame:
    """Add a redundant predicate on the ``dep_date`` partition column when the
    input has one (see ``sources.layout``): the window bounds are constants
    after folding, so only the matching date folders are listed and read."""
    if DATE_COL not in flights.columns:
        return flights
    to_date = (lambda c: F.to_date(epoch_to_ts(F.floor(c).cast("long"), unit)))
    cond = F.col(DATE_COL) >= to_date(lo)
    if hi is not None:
        cond = cond & (F.col(DATE_COL) <= to_date(hi))
    return flights.where(cond)


def recent_cancelled(flights: DataFrame, as_of_ms: int | None = None, seconds: int = 3600,
                     unit: str = "ms") -> DataFrame:
    """Cancelled flights per (airline, origin) scheduled in the last ``seconds``."""
    hi = _now_in_unit(as_of_ms, unit)
    lo = hi - F.lit(seconds * per_second(unit))
    cond = (F.col(STATUS) == F.lit(CANCELLED)) & scheduled_between(lo, hi)
    return _prune_dates(flights, lo, hi, unit).where(cond).groupBy(AIRLINE, ORIGIN).agg(
        F.count(F.lit(1)).alias("total_canceled_flights")
    ).select(AIRLINE, ORIGIN, "total_canceled_flights", _now_ts(as_of_ms).alias("calculation_time"))


def enriched_flights(flights: DataFrame, as_of_ms: int | None = None, seconds: int = 604800,
                     unit: str = "ms", limit: int | None = None) -> DataFrame:
    """Records scheduled in the last ``seconds`` with departure status, whole
    minutes late, hour of day and day part. ``limit`` reproduces the sample
    size of the original report (ordered by schedule for determinism)."""
    lo = _now_in_unit(as_of_ms, unit) - F.lit(seconds * per_second(unit))
    hour = hour_of_day(unit)
    out = _prune_dates(flights, lo, None, unit).where(F.col(SCHEDULED) >= lo).select(
        F.col(FLIGHT_NUMBER),
        epoch_to_ts(SCHEDULED, unit).alias("scheduled_departure_time"),
        F.col(AIRLINE), F.col(ORIGIN), F.col(DESTINATION),
        epoch_to_ts(ACTUAL, unit).alias("actual_departure_time"),
        departure_status().alias("departure_status"),
        whole_delay_minutes(unit).alias("delay_minutes"),
        hour.alias("hour_of_day"),
        time_of_day(hour).alias("time_of_day"),
        _now_ts(as_of_ms).alias("processing_time"),
    )
    if limit is not None:
        out = out.orderBy(F.desc("scheduled_departure_time"), F.asc(FLIGHT_NUMBER)).limit(limit)
    return out
