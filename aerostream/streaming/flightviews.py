"""The flight reports as maintained views, and their results.

Each report is kept over the record log (every stored record counts) or over the
newest record of each flight; its result equals the batch operator over the same
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostream.functions.agg import percent
from aerostream.functions.flight import delay, delay_category, departed, is_late, per_minute, route_label, status_is
from aerostream.operators import views
from aerostream.schema import AIRLINE, CANCELLED, DELAYED, DESTINATION, FLIGHT_FIELDS, ON_TIME, ORIGIN, SCHEDULED, SEQ, STATUS
from aerostream.streaming.maintained import ROWS, SumView, TopView, TotalView, Views, read_view


def _one_if(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def _mean(total: str, n: str, scale: int) -> Column:
    return F.when(F.col(n) > 0, F.col(total).cast("double") / (F.col(n) * F.lit(scale)).cast("double"))


def report_views(unit: str = "ms") -> Views:
    status = F.col(STATUS)
    return {
        "routes": SumView(
            {ORIGIN: F.col(ORIGIN), DESTINATION: F.col(DESTINATION)},
            {"delay": delay(unit), "departed": _one_if(departed()), "on_time": _one_if(status == ON_TIME),
             "delayed": _one_if(status == DELAYED), "cancelled": _one_if(status == CANCELLED)},
            ("airlines", F.col(AIRLINE))),
        "buckets": SumView(
            {"delay_category": delay_category(delay(unit), per_minute(unit))}, {"delay": delay(unit)}, ("airlines", F.col(AIRLINE)), is_late()),
        "statuses": SumView(
            {STATUS: status}, {"delay": F.when((status == DELAYED) & departed(), delay(unit)),
                               "departed": _one_if((status == DELAYED) & departed())}),
        "flights": TotalView("statuses"),
        "worst": TopView(lambda f: views.delayed_flights(f, keep_seq=True),
                         lambda: [F.desc("delay_minutes"), F.desc(SEQ)], 20),
        "recent": TopView(lambda f: f.select(SEQ, *FLIGHT_FIELDS), lambda: [F.desc(SCHEDULED), F.desc(SEQ)], 10),
    }


def delayed_view() -> Views:
    """Delayed flights per origin; an origin that falls to 0 stays at 0."""
    return {"delayed": SumView({ORIGIN: F.col(ORIGIN)}, {"delayed_count": _one_if(status_is(DELAYED))},
                               where=F.col(ORIGIN).isNotNull(), keep_empty=True)}


def _top(df: DataFrame, order: list[Column], limit: int | None) -> DataFrame:
    return df.orderBy(*order) if limit is None else df.orderBy(*order).limit(limit)


def busiest_routes(spark: SparkSession, path: str, unit: str = "ms", min_flights: int = 5, limit: int | None = 20, **at) -> DataFrame:
    rows = read_view(spark, path, report_views(unit), "routes", **at).where(F.col(ROWS) >= min_flights)
    out = rows.select(
        route_label().alias("route"), F.col(ROWS).alias("flight_count"), F.col("airlines").alias("airlines_serving"),
        _mean("delay", "departed", per_minute(unit)).alias("avg_delay_minutes"), F.col("on_time").cast("long").alias("on_time_count"),
        F.col("delayed").cast("long").alias("delayed_count"), F.col("cancelled").cast("long").alias("cancelled_count"))
    return _top(out, [F.desc("flight_count"), F.asc("route")], limit)


def delay_buckets(spark: SparkSession, path: str, unit: str = "ms", **at) -> DataFrame:
    rows = read_view(spark, path, report_views(unit), "buckets", **at)
    return rows.select("delay_category", F.col(ROWS).alias("flight_count"), _mean("delay", ROWS, per_minute(unit)).alias("avg_delay_minutes"),
                       F.col("airlines").alias("airlines_affected")).orderBy("avg_delay_minutes")


def status_share(spark: SparkSession, path: str, unit: str = "ms", **at) -> DataFrame:
    """The share is of the kept total, read as one value."""
    kept = report_views(unit)
    total = read_view(spark, path, kept, "flights", **at).select(F.col(ROWS).cast("long")).scalar()
    rows = read_view(spark, path, kept, "statuses", **at)
    return rows.select(STATUS, F.col(ROWS).alias("flight_count"), percent(F.col(ROWS), total).alias("percentage"),
                       _mean("delay", "departed", per_minute(unit)).alias("avg_delay_for_delayed_flights")) \
        .orderBy(F.desc("flight_count"), F.asc(STATUS))


def worst_delays(spark: SparkSession, path: str, **at) -> DataFrame:
    return read_view(spark, path, report_views(), "worst", **at).drop(SEQ)


def recent_flights(spark: SparkSession, path: str, **at) -> DataFrame:
    return read_view(spark, path, report_views(), "recent", **at).select(*FLIGHT_FIELDS)
