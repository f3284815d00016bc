"""Kafka sink encoders: every function maps a DataFrame onto ``(key, value)``
columns with built-in expressions; ``write_stream`` / ``write_batch`` hand them
to the Kafka connector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerostream.schema import FLIGHT_NUMBER


def long_be_bytes(c: Column) -> Column:
    """64-bit big-endian two's complement bytes of a bigint (a Long serde value).

    ``hex`` of a negative bigint is its 16-digit two's complement, so padding to
    16 digits covers both signs.
    """
    return F.unhex(F.lpad(F.hex(c.cast("long")), 16, "0"))


def json_documents(df: DataFrame, name: str = "json") -> DataFrame:
    """One JSON document per row (all columns, nulls kept as JSON null)."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))


def encode_word_counts(counts: DataFrame) -> DataFrame:
    """(word, count) -> key = word (string), value = count (8-byte long)."""
    return counts.select(F.col("word").alias("key"), long_be_bytes(F.col("count")).alias("value"))


def encode_json_upsert(df: DataFrame, key: str) -> DataFrame:
    """key = ``key`` column as string, value = the whole row as JSON (upsert topic:
    the last value per key wins on read / compaction). Nulls are written, so a
    reader can tell a null from a field that was never there."""
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def encode_alerts(alerts: DataFrame) -> DataFrame:
    """Alert rows -> JSON upsert records keyed by flight number."""
    return encode_json_upsert(alerts, FLIGHT_NUMBER)


def encode_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Text lines -> records with a null key."""
    return lines.select(F.lit(None).cast("string").alias("key"), F.col(value_col).alias("value"))


def write_stream(encoded: DataFrame, options: dict[str, str], topic: str, checkpoint: str,
                 output_mode: str = "update", name: str | None = None) -> StreamingQuery:
    w = encoded.writeStream.format("kafka").outputMode(output_mode).options(**options) \
        .option("topic", topic).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return w.start()


def write_batch(encoded: DataFrame, options: dict[str, str], topic: str) -> None:
    opts = {k: v for k, v in options.items() if k.startswith("kafka.")}
    encoded.write.format("kafka").options(**opts).option("topic", topic).save()
