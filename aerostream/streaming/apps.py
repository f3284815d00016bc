"""The two streaming applications, assembled from sources, operators and sinks.

* word count: text topic -> lower-cased Java-style tokens -> running count per
  word -> (word, 8-byte long) changelog topic, update mode.
* flights: Avro flight topic -> keyed latest record per flight (maintained
  table) and the retracting delayed count per origin.

Each ``start_*`` function only wires Kafka to the DataFrame builders
(``*_query``), which take any streaming DataFrame and are tested with the file
source. State can be read back by key from the checkpoint with
``read_state`` (Spark's state data source), the counterpart of querying the
state stores of the original applications.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerostream.operators import words
from aerostream.schema import FLIGHT_NUMBER, SEQ
from aerostream.session import checkpoint_path
from aerostream.sinks import kafka as ksink
from aerostream.sinks import table as tbl
from aerostream.sources import kafka as ksrc
from aerostream.streaming.views import start_delayed_by_origin, start_view


def word_count_query(lines: DataFrame, mode: str = "java") -> DataFrame:
    """Streaming (key, value) records of the running word counts."""
    return ksink.encode_word_counts(words.word_count(lines, mode=mode))


def start_word_count(spark: SparkSession, kafka: dict[str, str], input_topic: str, output_topic: str,
                     checkpoint: str | None = None) -> StreamingQuery:
    src = ksrc.decode_text(ksrc.read_stream(spark, {**kafka, "subscribe": input_topic}))
    out = word_count_query(src)
    ckpt = checkpoint or checkpoint_path(spark, "apps", "word-count")
    return ksink.write_stream(out, kafka, output_topic, ckpt, "update", name="word-count")


def start_flight_tables(flights: DataFrame, table_root: str, checkpoint: str, generation: int = 0,
                        trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """Keep both tables of the flight application under ``table_root``:
    ``flights``, the newest record per flight (``sinks.table``), and ``delayed``,
    the retracting count (``retract.read_delayed`` and ``read_changes``)."""
    return {
        "flights-store": start_view(
            flights, "flights-store", "append", sink=tbl.upsert_sink(f"{table_root}/flights", FLIGHT_NUMBER, SEQ, generation),
            checkpoint=f"{checkpoint}/flights-store", trigger=trigger),
        "delayed-by-origin-store": start_delayed_by_origin(
            flights, f"{table_root}/delayed", "delayed-by-origin-store", generation,
            checkpoint=f"{checkpoint}/delayed-by-origin-store", trigger=trigger),
    }


def start_flights(spark: SparkSession, kafka: dict[str, str], topic: str, table_root: str,
                  registry_framed: bool = True, checkpoint: str | None = None, generation: int = 0) -> dict[str, StreamingQuery]:
    """Start both tables over an Avro topic. A replay with a fresh checkpoint
    passes the next ``generation``."""
    src = ksrc.decode_flights_avro(ksrc.read_stream(spark, {**kafka, "subscribe": topic}), registry_framed)
    return start_flight_tables(src, table_root, checkpoint or checkpoint_path(spark, "apps", "flights"), generation)


def start_flight_log(flights: DataFrame, path: str, name: str = "flight-log", unit: str = "ms",
                     checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Append the record stream to the date-partitioned flight log (exactly-once
    through the file sink's log). Snapshot analytics that Spark refuses on
    streams — ``COUNT(DISTINCT)``, ``SUM(...) OVER ()``, sorting — run as batch
    queries over ``sources.layout.read_flight_log(path)``; time-relative ones
    prune to the dates they need."""
    from aerostream.sources.layout import DATE_COL, with_dep_date

    ckpt = checkpoint or checkpoint_path(flights.sparkSession, "apps", name)
    w = (with_dep_date(flights, unit).writeStream.queryName(name).outputMode("append")
         .format("parquet").option("path", path).option("checkpointLocation", ckpt).partitionBy(DATE_COL))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def publish_lines(spark: SparkSession, path: str, kafka: dict[str, str], topic: str, header: bool = True) -> None:
    """Send every line of a delimited text file (header skipped) to ``topic``
    with a null key; the file is read in parallel byte ranges."""
    from aerostream.sources.files import delimited_lines

    ksink.write_batch(ksink.encode_lines(delimited_lines(spark, path, header)), kafka, topic)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (the topology description)."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def read_state(spark: SparkSession, checkpoint: str, operator_id: int | None = None,
               store_name: str | None = None, state_var: str | None = None) -> DataFrame:
    """State rows (key, value, partition_id) of a stateful query's checkpoint,
    read in parallel by Spark's ``statestore`` source."""
    r = spark.read.format("statestore")
    if operator_id is not None:
        r = r.option("operatorId", operator_id)
    if store_name is not None:
        r = r.option("storeName", store_name)
    if state_var is not None:
        r = r.option("stateVarName", state_var)
    return r.load(checkpoint)


def state_lookup(state_rows: DataFrame, key_field: str, value) -> DataFrame:
    """Point read of one key from ``read_state`` output."""
    return state_rows.where(F.col(f"key.{key_field}") == F.lit(value))
