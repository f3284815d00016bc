"""Physical layout of the flight log for large scans.

``write_flight_log`` stores records as Parquet partitioned by the UTC date of
the scheduled departure (``dep_date``). Rows are dealt to writer tasks by ranges
of (date, flight, arrival order), so a date, or a flight, that holds a third of
all rows is written by a third of the tasks, and rows are sorted by flight and
arrival order inside each file, so per-flight lookups prune row groups. Time-relative
queries add a ``dep_date`` predicate (see ``operators.recent``), which Spark turns
into partition pruning: "the last hour" lists one or two date folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostream.functions.flight import scheduled_ts
from aerostream.schema import FLIGHT_NUMBER, SEQ

DATE_COL = "dep_date"


def with_dep_date(flights: DataFrame, unit: str = "ms") -> DataFrame:
    return flights.withColumn(DATE_COL, F.to_date(scheduled_ts(unit)))


def write_flight_log(flights: DataFrame, path: str, unit: str = "ms",
                     max_records_per_file: int = 5_000_000, mode: str = "overwrite") -> None:
    # ranges over (date, flight, arrival): a date or a flight with many rows gets as many tasks as its rows need
    out = (with_dep_date(flights, unit)
           .repartitionByRange(DATE_COL, FLIGHT_NUMBER, SEQ)
           .sortWithinPartitions(DATE_COL, FLIGHT_NUMBER, SEQ))
    (out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(DATE_COL).parquet(path))


def read_flight_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
