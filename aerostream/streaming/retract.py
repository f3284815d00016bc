"""Retracting count of currently delayed flights per origin, as a stream.

The newest record of each flight is kept (``maintained.current_sink``); a record
that replaces another takes the flight out of the old origin's count and adds it
to the new one's. Older records, and records delivered again, change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostream.schema import FLIGHT_NUMBER, ORIGIN, SEQ, SEQUENCED_FLIGHT_SCHEMA
from aerostream.streaming.flightviews import delayed_view
from aerostream.streaming.log import FOLD_EVERY
from aerostream.streaming.maintained import current_sink, read_view, read_view_changes


def retraction_sink(path: str, generation: int = 0, every: int = FOLD_EVERY):
    """``foreachBatch`` function that keeps the counts under ``path``."""
    def _sink(batch: DataFrame, batch_id: int) -> None:
        current_sink(path, delayed_view(), FLIGHT_NUMBER, SEQ, every, generation)(batch, batch_id)
    return _sink


def read_changes(spark: SparkSession, path: str, generation: int = 0, schema: T.StructType = SEQUENCED_FLIGHT_SCHEMA) -> DataFrame:
    """(batch, origin, delta, delayed_count): the changelog of the counts, with
    the count after each batch. An origin has one row per batch that names it."""
    so_far = Window.partitionBy(ORIGIN).orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = read_view_changes(spark, path, delayed_view(), "delayed", schema, generation)
    return rows.select("batch", ORIGIN, F.col("delayed_count").cast("long").alias("delta")) \
        .withColumn("delayed_count", F.sum("delta").over(so_far))


def read_delayed(spark: SparkSession, path: str, generation: int = 0, schema: T.StructType = SEQUENCED_FLIGHT_SCHEMA) -> DataFrame:
    """(origin, delayed_count) now; origins that fell to 0 stay at 0."""
    return read_view(spark, path, delayed_view(), "delayed", schema, generation=generation) \
        .select(ORIGIN, F.col("delayed_count").cast("long").alias("delayed_count"))
