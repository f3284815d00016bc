"""SQL text over streams: a topic or file stream registered as a view, and
statements over it started as maintained queries.

A statement is plain Spark SQL. ``stream_view`` gives a streaming DataFrame a
name; ``sql_view`` names a statement, so later ones can read it (a view on a
view); ``start_sql`` starts a statement and keeps its result in a table: with a
``key`` as a keyed table that every batch updates (aggregates), without one as an
append-only table (filters and projections).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aerostream.sinks import table as tbl
from aerostream.streaming.log import with_long
from aerostream.streaming.views import start_view

# column of a keyed table that orders what the batches wrote
ORDER = "_batch"


def stream_view(stream: DataFrame, name: str) -> DataFrame:
    """Register a stream under ``name``."""
    if not stream.isStreaming:
        raise ValueError(f"{name} is not a stream")
    stream.createOrReplaceTempView(name)
    return stream


def sql_view(spark: SparkSession, name: str, statement: str) -> DataFrame:
    """Register a statement over other views under ``name``."""
    return stream_view(spark.sql(statement), name)


@dataclass(frozen=True)
class SqlQuery:
    """A running statement and where its result is kept."""

    query: StreamingQuery
    path: str
    schema: T.StructType
    key: str | None

    def result(self) -> DataFrame:
        """What the committed batches have made of the statement so far."""
        spark = SparkSession.active()
        if self.key is None:
            return tbl.read_if_there(spark, self.path, self.schema)
        return tbl.read_keyed(spark, self.path, self.key, ORDER, with_long(self.schema, ORDER)).select(*self.schema.names)


def start_sql(spark: SparkSession, name: str, statement: str, path: str, checkpoint: str, key: str | None = None,
              trigger: dict | None = None) -> SqlQuery:
    """Start ``statement`` as the query ``name``, its result kept under ``path``."""
    df = spark.sql(statement)
    if not df.isStreaming:
        raise ValueError(f"the statement of {name} reads no stream")
    if key is None:
        q = start_view(df, name, "append", "parquet", checkpoint=checkpoint, trigger=trigger, options={"path": path})
    else:
        q = start_view(df, name, "update", tbl.upsert_sink(path, key), checkpoint=checkpoint, trigger=trigger)
    return SqlQuery(q, path, df.schema, key)
