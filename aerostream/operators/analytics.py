"""Snapshot analytics over the flight table (every stored record counts).

All are one scan + one (partial -> final) aggregation; the top-k reports end in
``TakeOrderedAndProject`` (per-partition top-k, no global sort). Averages are
exact (see ``functions.agg``) so they do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostream.functions.agg import count_if, exact_mean, percent
from aerostream.functions.flight import (
    day_name, day_num, delay, delay_category, departed, hour_of_day, is_late, per_minute, route_label,
)
from aerostream.schema import AIRLINE, CANCELLED, DELAYED, DESTINATION, ON_TIME, ORIGIN, STATUS


def flight_count(flights: DataFrame) -> DataFrame:
    return flights.agg(F.count(F.lit(1)).alias("flight_count"))


def described(df: DataFrame) -> DataFrame:
    """One row per column: place, column, type, the table's rows and those in
    which the column is not null; one scan and one aggregation."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{f.name}`")).alias(f"_n{i}") for i, f in enumerate(df.schema.fields)])
    rows = [F.struct(F.lit(i).alias("place"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                     F.col("_rows").alias("rows"), F.col(f"_n{i}").alias("filled")) for i, f in enumerate(df.schema.fields)]
    return counts.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def _mean_delay(unit: str, cond=None, count=None):
    d = delay(unit) if cond is None else F.when(cond, delay(unit))
    return exact_mean(d, per_minute(unit), count=count)


def delay_by_airline(flights: DataFrame, unit: str = "ms", limit: int | None = 10) -> DataFrame:
    total = F.count(F.lit(1))
    late = count_if(is_late())
    out = flights.where(departed()).groupBy(AIRLINE).agg(
        total.alias("total_flights"),
        _mean_delay(unit).alias("avg_delay_minutes"),
        late.alias("delayed_flights"),
        percent(late, total).alias("delay_percentage"),
    )
    return _top(out, [F.desc("avg_delay_minutes"), F.asc(AIRLINE)], limit)


def busiest_routes(flights: DataFrame, unit: str = "ms", min_flights: int = 5, limit: int | None = 20) -> DataFrame:
    out = flights.groupBy(ORIGIN, DESTINATION).agg(
        F.count(F.lit(1)).alias("flight_count"),
        F.countDistinct(AIRLINE).alias("airlines_serving"),
        _mean_delay(unit).alias("avg_delay_minutes"),
        count_if(F.col(STATUS) == F.lit(ON_TIME)).alias("on_time_count"),
        count_if(F.col(STATUS) == F.lit(DELAYED)).alias("delayed_count"),
        count_if(F.col(STATUS) == F.lit(CANCELLED)).alias("cancelled_count"),
    ).where(F.col("flight_count") >= F.lit(min_flights))
    out = out.select(
        route_label().alias("route"), "flight_count", "airlines_serving", "avg_delay_minutes",
        "on_time_count", "delayed_count", "cancelled_count",
    )
    return _top(out, [F.desc("flight_count"), F.asc("route")], limit)


def delay_by_hour(flights: DataFrame, unit: str = "ms") -> DataFrame:
    total = F.count(F.lit(1))
    cancelled = count_if(F.col(STATUS) == F.lit(CANCELLED))
    zero_if_missing = F.coalesce(delay(unit), F.lit(0).cast("long"))
    return flights.groupBy(hour_of_day(unit).alias("departure_hour")).agg(
        total.alias("scheduled_flights"),
        exact_mean(zero_if_missing, per_minute(unit), count=total).alias("avg_delay_minutes"),
        cancelled.alias("cancellations"),
        percent(cancelled, total).alias("cancellation_rate"),
    ).orderBy("departure_hour")


def airport_comparison(flights: DataFrame, unit: str = "ms", min_flights: int = 10,
                       limit: int | None = 15) -> DataFrame:
    """Per airport: departure delay (as origin), "arrival" delay (the departure
    delay of flights with that destination), their unweighted mean, and flights
    counted once per role.

    One scan: each departed record is emitted twice (origin role, destination
    role) and a single aggregation per airport keeps both roles' sums apart, so
    there is one shuffle.
    """
    roles = F.explode(F.array(
        F.struct(F.col(ORIGIN).alias("airport"), F.lit(True).alias("dep")),
        F.struct(F.col(DESTINATION).alias("airport"), F.lit(False).alias("dep")),
    ))
    d = delay(unit)
    per = flights.where(departed()).select(roles.alias("r"), d.alias("d"))
    is_dep = F.col("r.dep")
    agg = per.groupBy(F.col("r.airport").alias("airport")).agg(
        count_if(is_dep).alias("n_dep"),
        count_if(~is_dep).alias("n_arr"),
        exact_mean(F.when(is_dep, F.col("d")), per_minute(unit)).alias("departure_delay"),
        exact_mean(F.when(~is_dep, F.col("d")), per_minute(unit)).alias("arrival_delay"),
    )
    dep, arr = F.col("departure_delay"), F.col("arrival_delay")
    overall = (
        F.when(dep.isNotNull() & arr.isNotNull(), (dep + arr) / F.lit(2.0))
        .otherwise(F.coalesce(dep, arr))
    )
    # A role is present when the airport has departed records in it.
    out = agg.select(
        "airport",
        (F.col("n_dep") + F.col("n_arr")).alias("total_flights"),
        overall.alias("overall_avg_delay"),
        "departure_delay",
        "arrival_delay",
    ).where(F.col("total_flights") >= F.lit(min_flights))
    return _top(out, [F.desc("overall_avg_delay"), F.asc("airport")], limit)


def status_share(flights: DataFrame, unit: str = "ms") -> DataFrame:
    """Per status: count, share of all records (%), mean delay of DELAYED rows.

    The share needs the grand total; it is taken with a window over the
    aggregated rows, one row per distinct status (a small, bounded set).
    """
    agg = flights.groupBy(STATUS).agg(
        F.count(F.lit(1)).alias("flight_count"),
        _mean_delay(unit, cond=(F.col(STATUS) == F.lit(DELAYED)) & departed()).alias(
            "avg_delay_for_delayed_flights"),
    )
    grand = F.sum("flight_count").over(Window.partitionBy())
    return agg.select(
        STATUS, "flight_count", percent(F.col("flight_count"), grand).alias("percentage"),
        "avg_delay_for_delayed_flights",
    ).orderBy(F.desc("flight_count"), F.asc(STATUS))


def delay_by_weekday(flights: DataFrame, unit: str = "ms") -> DataFrame:
    total = F.count(F.lit(1))
    cancelled = count_if(F.col(STATUS) == F.lit(CANCELLED))
    return flights.where(departed()).groupBy(
        day_name(unit).alias("day_of_week"), day_num(unit).alias("day_num")
    ).agg(
        total.alias("total_flights"),
        _mean_delay(unit).alias("avg_delay_minutes"),
        cancelled.alias("cancellations"),
        percent(cancelled, total).alias("cancellation_rate"),
    ).orderBy("day_num")


def delay_buckets(flights: DataFrame, unit: str = "ms") -> DataFrame:
    pm = per_minute(unit)
    d = delay(unit)
    return flights.where(is_late()).groupBy(delay_category(d, pm).alias("delay_category")).agg(
        F.count(F.lit(1)).alias("flight_count"),
        _mean_delay(unit).alias("avg_delay_minutes"),
        F.countDistinct(AIRLINE).alias("airlines_affected"),
    ).orderBy("avg_delay_minutes")


def _top(df: DataFrame, order: list, limit: int | None) -> DataFrame:
    out = df.orderBy(*order)
    return out.limit(limit) if limit is not None else out
