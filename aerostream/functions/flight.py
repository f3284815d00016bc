"""Column expressions over the flight record (projections, predicates, buckets).

Every function returns a ``Column`` built from built-in Spark functions, so the
expressions stay inside whole-stage codegen. Times are epoch milliseconds;
``unit="s"`` treats the two time fields as epoch seconds instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerostream.schema import ACTUAL, CANCELLED, DELAYED, ON_TIME, SCHEDULED, STATUS

_UNIT_PER_MINUTE = {"ms": 60000, "s": 60}
_UNIT_PER_SECOND = {"ms": 1000, "s": 1}

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def per_minute(unit: str = "ms") -> int:
    try:
        return _UNIT_PER_MINUTE[unit]
    except KeyError:
        raise ValueError(f"unit must be 'ms' or 's', got {unit!r}") from None


def per_second(unit: str = "ms") -> int:
    per_minute(unit)
    return _UNIT_PER_SECOND[unit]


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- time values

def epoch_ms_of_ntz(ts: str | Column) -> Column:
    """Epoch milliseconds (floor) of a ``timestamp_ntz`` column, time-zone free."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), col(ts))
    return floor_div(micros, 1000)


def trunc_div(c: Column, k: int) -> Column:
    """Integer division truncating toward zero (bigint ``/`` in SQL engines)."""
    return F.call_function("div", c.cast("long"), F.lit(k))


def floor_div(c: Column, k: int) -> Column:
    """Integer division rounding down, exact for every long."""
    return trunc_div(c - F.pmod(c, F.lit(k)), k)


def epoch_seconds_to_ntz(seconds: Column) -> Column:
    """Whole epoch seconds -> ``timestamp_ntz`` (UTC wall clock)."""
    return F.timestamp_add("SECOND", seconds, F.expr(_EPOCH_NTZ))


def micros_to_ntz(micros: Column) -> Column:
    """Epoch microseconds -> ``timestamp_ntz`` (UTC wall clock)."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH_NTZ))


def epoch_to_ts(c: str | Column, unit: str = "ms") -> Column:
    """Epoch value -> ``timestamp_ntz`` truncated to whole seconds.

    Integer division truncates toward zero, as ``TO_TIMESTAMP(ms / 1000)`` does on
    bigint input in the streaming SQL engines.
    """
    c = col(c)
    secs = c if unit == "s" else trunc_div(c, per_second(unit))
    return epoch_seconds_to_ntz(secs.cast("long"))


def scheduled_ts(unit: str = "ms") -> Column:
    return epoch_to_ts(SCHEDULED, unit)


def format_epoch(c: str | Column, unit: str = "ms", fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch value -> formatted UTC string; null stays null (floor to seconds)."""
    c = col(c)
    secs = floor_div(c, per_second(unit)) if unit != "s" else c
    return F.date_format(epoch_seconds_to_ntz(secs), fmt)


def hour_of_day(unit: str = "ms") -> Column:
    """UTC hour of the scheduled departure as BIGINT."""
    return F.hour(scheduled_ts(unit)).cast("long")


def day_name(unit: str = "ms") -> Column:
    return F.date_format(scheduled_ts(unit), "EEEE")


def day_num(unit: str = "ms") -> Column:
    """Day of week with Sunday = 0 (BIGINT)."""
    return (F.dayofweek(scheduled_ts(unit)) - 1).cast("long")


# ---------------------------------------------------------------- delays

def delay(unit: str = "ms") -> Column:
    """actual - scheduled in the record's unit (null when not departed)."""
    return F.col(ACTUAL) - F.col(SCHEDULED)


def delay_minutes(unit: str = "ms") -> Column:
    """Fractional delay in minutes; early departures are negative."""
    return delay(unit) / F.lit(float(per_minute(unit)))


def late_delay(unit: str = "ms") -> Column:
    """Delay when actual > scheduled, else 0 (nulls count as 0)."""
    return F.when(is_late(), delay(unit)).otherwise(F.lit(0).cast("long"))


def whole_delay_minutes(unit: str = "ms") -> Column:
    """Whole minutes late (integer division), 0 unless late."""
    return F.when(is_late(), trunc_div(delay(unit), per_minute(unit))).otherwise(F.lit(0).cast("long"))


# ---------------------------------------------------------------- predicates

def departed() -> Column:
    return F.col(ACTUAL).isNotNull()


def is_late(threshold: int = 0) -> Column:
    """actual is set and actual > scheduled + threshold (strict)."""
    return departed() & (F.col(ACTUAL) > F.col(SCHEDULED) + F.lit(threshold))


def late_over_minutes(minutes: int, unit: str = "ms") -> Column:
    """More than ``minutes`` late (strict)."""
    return is_late(minutes * per_minute(unit))


def status_is(value: str) -> Column:
    """Case-insensitive status equality."""
    return F.upper(F.col(STATUS)) == F.lit(value.upper())


def scheduled_between(lo_ms: Column | int, hi_ms: Column | int) -> Column:
    return F.col(SCHEDULED).between(lo_ms, hi_ms)


# ---------------------------------------------------------------- labels

def route_label() -> Column:
    return F.concat(F.col("origin"), F.lit(" → "), F.col("destination"))


def departure_status() -> Column:
    """CANCELLED / NOT_DEPARTED / ON_TIME / DELAYED / UNKNOWN, first match wins."""
    return (
        F.when(F.col(STATUS) == F.lit(CANCELLED), F.lit(CANCELLED))
        .when(F.col(ACTUAL).isNull(), F.lit("NOT_DEPARTED"))
        .when(F.col(ACTUAL) <= F.col(SCHEDULED), F.lit("ON_TIME"))
        .when(F.col(ACTUAL) > F.col(SCHEDULED), F.lit(DELAYED))
        .otherwise(F.lit("UNKNOWN"))
    )


def time_of_day(hour: Column) -> Column:
    # fixed values: hour ranges of the day-part labels (inclusive bounds)
    return (
        F.when(hour.between(5, 9), F.lit("MORNING"))
        .when(hour.between(10, 15), F.lit("MIDDAY"))
        .when(hour.between(16, 19), F.lit("EVENING"))
        .otherwise(F.lit("NIGHT"))
    )


def delay_category(delay_value: Column, per_min: int = 60000) -> Column:
    """Bucket of a delay given in the record's unit (``per_min`` units per minute).

    Compared as integers (``delay < 15 * per_min``) so bucket edges are exact.
    """
    # fixed values: delay bucket labels and upper bounds in minutes
    return (
        F.when(delay_value < 15 * per_min, F.lit("Short Delay (<15min)"))
        .when(delay_value < 60 * per_min, F.lit("Medium Delay (15-60min)"))
        .when(delay_value < 180 * per_min, F.lit("Long Delay (1-3hr)"))
        .otherwise(F.lit("Very Long Delay (>3hr)"))
    )


def count_severity(count: Column) -> Column:
    """Dashboard severity of a delayed count: >5 bad, 1..5 warn, 0 good."""
    return F.when(count > 5, F.lit("bad")).when(count > 0, F.lit("warn")).otherwise(F.lit("good"))


def status_severity(status: Column) -> Column:
    return F.when(status == F.lit(DELAYED), F.lit("bad")).when(status == F.lit(ON_TIME), F.lit("good")) \
        .otherwise(F.lit("neutral"))
