"""Batch sources over the generated test tables.

``flights_from_events`` derives the flight-status record stream from the
``events`` table: each user is one flight that receives many status updates
(it changes origin over time, is late, early or not departed), ``event_id`` is
the arrival order. ``text_lines`` turns ``documents`` into the line records of
the text stream. Both are narrow projections, so they stream through the scan
with no shuffle and keep Parquet column pruning.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostream.functions.flight import epoch_ms_of_ntz, scheduled_ts
from aerostream.functions.text import split_lines
from aerostream.schema import (
    ACTUAL, AIRLINE, DESTINATION, FLIGHT_NUMBER, ORIGIN, SCHEDULED, SEQ, STATUS,
)

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# fixed values: instant used as "now" by the time-relative queries on the test data
# (2024-01-30 00:00:00 UTC in epoch milliseconds)
TEST_AS_OF_MS = 1706572800000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _str(c: Column) -> Column:
    return c.cast("string")


def flights_from_events(events: DataFrame) -> DataFrame:
    """events(event_id, ts, user_id, event_type, value) -> sequenced flight records."""
    ms = epoch_ms_of_ntz("ts")
    uid, eid = F.col("user_id"), F.col("event_id")
    et = F.col("event_type")
    # fixed values: mapping of the event table onto flight fields
    actual = F.when((et == "error") | (eid % 13 == 0), F.lit(None).cast("long")) \
        .otherwise(ms + F.floor((F.col("value") - 20) * 60000).cast("long"))
    status = (
        F.when(et == "error", F.lit("CANCELLED"))
        .when(et == "click", F.lit("ON_TIME"))
        .when(et == "view", F.lit("DELAYED"))
        .otherwise(F.lit("SCHEDULED"))
    )
    return events.select(
        eid.alias(SEQ),
        F.concat(F.lit("FL"), _str(uid)).alias(FLIGHT_NUMBER),
        F.concat(F.lit("AL"), _str(uid % 7)).alias(AIRLINE),
        F.concat(F.lit("AP"), _str(eid % 11)).alias(ORIGIN),
        F.concat(F.lit("AP"), _str((eid + 1 + uid % 9) % 11)).alias(DESTINATION),
        ms.alias(SCHEDULED),
        actual.alias(ACTUAL),
        status.alias(STATUS),
    )


def normalise(flights: DataFrame, unit: str = "ms", add_ts: bool = False) -> DataFrame:
    """Upper-case the status, drop records without a flight key and, on request,
    add ``scheduled_ts`` (the scheduled time as ``timestamp_ntz``)."""
    out = flights.where(F.col(FLIGHT_NUMBER).isNotNull()).withColumn(STATUS, F.upper(F.col(STATUS)))
    return out.withColumn("scheduled_ts", scheduled_ts(unit)) if add_ts else out


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from_events(read_table(spark, sf_dir, "events"))


def text_lines(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """documents -> one row per line (``value``), like a line producer sends them."""
    parts = documents.select(split_lines(F.col(text_col)).alias("_l"))
    # explode_outer: avoids an inferred size() filter that would split twice
    return parts.select(F.explode_outer("_l").alias("value")).where(F.col("value").isNotNull())


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return text_lines(docs)

