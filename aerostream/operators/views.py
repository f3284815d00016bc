"""The maintained views over the raw flight stream (every status update counts).

Each function is a plain ``DataFrame -> DataFrame`` transformation, so the same
code runs as a batch query and, in ``aerostream.streaming.views``, as a
streaming query. Aggregations are single-key ``groupBy``s with partial
aggregation before the shuffle; the tumbling window is computed per row
(no Expand) because the window width equals the slide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostream.functions.agg import count_if, exact_mean, percent
from aerostream.functions.flight import (
    delay_minutes, epoch_to_ts, late_delay, late_over_minutes, micros_to_ntz, per_minute, per_second,
    scheduled_ts, trunc_div,
)
from aerostream.operators.state import latest_by_key
from aerostream.schema import (
    ACTUAL, AIRLINE, CANCELLED, DELAYED, DESTINATION, FLIGHT_NUMBER, ON_TIME, ORIGIN, SCHEDULED, SEQ, STATUS,
)


def delayed_flights(flights: DataFrame, minutes: int = 15, unit: str = "ms", keep_seq: bool = False) -> DataFrame:
    """Records more than ``minutes`` late, with the fractional delay in minutes."""
    cols = [FLIGHT_NUMBER, AIRLINE, ORIGIN, DESTINATION, SCHEDULED, ACTUAL]
    extra = [SEQ] if keep_seq else []
    return flights.where(late_over_minutes(minutes, unit)).select(
        *extra, *cols, delay_minutes(unit).alias("delay_minutes"), STATUS
    )


def airline_performance(flights: DataFrame, unit: str = "ms") -> DataFrame:
    """Per airline: totals, delayed / cancelled counts, delay %, mean late minutes."""
    total = F.count(F.lit(1))
    delayed = count_if(F.col(STATUS) == F.lit(DELAYED))
    return flights.groupBy(AIRLINE).agg(
        total.alias("total_flights"),
        delayed.alias("delayed_count"),
        count_if(F.col(STATUS) == F.lit(CANCELLED)).alias("cancelled_count"),
        percent(delayed, total).alias("delay_percentage"),
        exact_mean(late_delay(unit), per_minute(unit), count=total).alias("avg_delay_minutes"),
    )


def hourly_flight_summary(flights: DataFrame, width: str = "1 hour", unit: str = "ms",
                          watermark: str | None = None) -> DataFrame:
    """Tumbling windows on the scheduled time (seconds resolution).

    Without ``watermark`` (as declared by the original view) the window state is
    kept forever; with one, windows older than the watermark are finalised,
    emitted once in append mode and dropped from state. Watermarks need an
    instant, so the watermarked form windows on ``timestamp_seconds`` and turns
    the bounds back into ``timestamp_ntz`` through epoch microseconds (no time
    zone involved), giving the same rows either way.
    """
    if watermark:
        secs = F.col(SCHEDULED) if unit == "s" else trunc_div(F.col(SCHEDULED), per_second(unit))
        src = flights.withColumn("_event_ts", F.timestamp_seconds(secs)).withWatermark("_event_ts", watermark)
        w = F.window("_event_ts", width)
    else:
        src = flights.withColumn("scheduled_ts", scheduled_ts(unit))
        w = F.window("scheduled_ts", width)
    total = F.count(F.lit(1))
    on_time = count_if(F.col(STATUS) == F.lit(ON_TIME))
    agg = src.groupBy(w.alias("w")).agg(
        total.alias("flights_scheduled"),
        on_time.alias("on_time_flights"),
        count_if(F.col(STATUS) == F.lit(DELAYED)).alias("delayed_flights"),
        count_if(F.col(STATUS) == F.lit(CANCELLED)).alias("cancelled_flights"),
        percent(on_time, total).alias("on_time_percentage"),
    )
    start, end = F.col("w.start"), F.col("w.end")
    if watermark:
        start, end = micros_to_ntz(F.unix_micros(start)), micros_to_ntz(F.unix_micros(end))
    return agg.select(
        start.alias("window_start"), end.alias("window_end"),
        "flights_scheduled", "on_time_flights", "delayed_flights", "cancelled_flights", "on_time_percentage",
    )


def airport_congestion(flights: DataFrame, min_rows: int = 5) -> DataFrame:
    """Per origin airport with more than ``min_rows`` departures."""
    total = F.count(F.lit(1))
    delayed = count_if(F.col(STATUS) == F.lit(DELAYED))
    agg = flights.groupBy(F.col(ORIGIN).alias("airport")).agg(
        total.alias("departing_flights"),
        delayed.alias("delayed_departures"),
        percent(delayed, total).alias("delay_rate_percentage"),
    )
    return agg.where(F.col("departing_flights") > F.lit(min_rows))


def flight_alerts(flights: DataFrame, minutes: int = 60, unit: str = "ms", keep_seq: bool = False) -> DataFrame:
    """Alerts for delays above ``minutes``, read from ``delayed_flights`` (view on view)."""
    src = delayed_flights(flights, unit=unit, keep_seq=keep_seq)
    extra = [SEQ] if keep_seq else []
    return src.where(F.col("delay_minutes") > F.lit(float(minutes))).select(
        *extra, FLIGHT_NUMBER, AIRLINE, ORIGIN, DESTINATION, "delay_minutes",
        F.lit("CRITICAL_DELAY").alias("alert_type"),
        epoch_to_ts(ACTUAL, unit).alias("alert_timestamp"),
    )


def flight_alerts_table(flights: DataFrame, minutes: int = 60, unit: str = "ms") -> DataFrame:
    """What the upsert sink keyed by ``flightNumber`` ends up holding: the last
    alert per flight in arrival order."""
    alerts = flight_alerts(flights, minutes, unit, keep_seq=True)
    cols = [c for c in alerts.columns if c not in (SEQ, FLIGHT_NUMBER)]
    return latest_by_key(alerts, FLIGHT_NUMBER, SEQ, cols)

