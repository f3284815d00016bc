"""Keyed tables, tables that keep a growing schema, table creation and replay.

A keyed table is a folder of Parquet files to which every batch adds its newest
row per key under ``gen=<generation>/batch=<batch id>``; readers keep the newest
row of each key (``read_keyed``). A batch costs what it holds, however large the
table is; a batch that is delivered again replaces its own folder; a replay
counts as a new generation, whose rows win over all older ones. Rows with a null
key are the row of the key null. Schemas may grow: old rows read new columns as
null. A batch without rows adds a folder without rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostream.operators.state import latest_by_key, newest_per_partition
from aerostream.session import checkpoint_path

GENERATION, BATCH = "gen", "batch"


def newest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    return latest_by_key(df, key, order, [c for c in df.columns if c != key])


def candidates(df: DataFrame, key: str, order: str) -> DataFrame:
    """The rows of a batch that a keyed table has to keep."""
    return newest_per_partition(df, key, order, [c for c in df.columns if c != key])


def upsert(batch: DataFrame, path: str, key: str, order: str, batch_id: int, generation: int = 0) -> None:
    """Add ``batch``'s newest row per key to the keyed table at ``path``; the batch
    runs once."""
    new = candidates(batch, key, order)
    new.write.mode("overwrite").parquet(f"{path}/{GENERATION}={generation}/{BATCH}={batch_id}")


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet rows under ``path``, none if nothing was written there yet."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if (e.getCondition() or "").split(".")[0] == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a table written batch by batch, with generation and batch. The
    schema is given by the caller, so no footers are read to merge schemas."""
    return read_if_there(spark, path, T.StructType([*schema.fields, T.StructField(GENERATION, T.LongType()), T.StructField(BATCH, T.LongType())]))


def read_keyed(spark: SparkSession, path: str, key: str, order: str, schema: T.StructType) -> DataFrame:
    """Current row per key: the newest by generation, ``order`` and batch."""
    raw = read_batches(spark, path, schema)
    return _current(raw, key, order, schema)


def _current(raw: DataFrame, key: str, order: str, schema: T.StructType) -> DataFrame:
    names = [f.name for f in schema.fields]
    return latest_by_key(raw, key, order, [c for c in names if c != key], first=(GENERATION,), last=(BATCH,)).select(*names)


def lookup(spark: SparkSession, path: str, key: str, value, order: str, schema: T.StructType) -> DataFrame:
    """Current row of one key, no row for an unknown one. The key predicate goes
    below the newest-row step and into the Parquet reader."""
    raw = read_batches(spark, path, schema)
    return _current(raw.where(F.col(key).eqNullSafe(F.lit(value).cast(schema[key].dataType))), key, order, schema)


def upsert_sink(path: str, key: str, order: str | None = None, generation: int = 0,
                transform: Callable[[DataFrame], DataFrame] | None = None):
    """``foreachBatch`` function that upserts each micro-batch into ``path``;
    without ``order`` a later batch wins (column ``_batch``)."""
    def _sink(batch: DataFrame, batch_id: int) -> None:
        src = transform(batch) if transform else batch
        if order is None:
            src = src.withColumn("_batch", F.lit(batch_id).cast("long"))
        upsert(src, path, key, order or "_batch", batch_id, generation)
    return _sink


def create_table_if_absent(spark: SparkSession, name: str, schema_ddl: str, using: str = "parquet") -> None:
    """CREATE TABLE IF NOT EXISTS with the given column DDL."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({schema_ddl}) USING {using}")


# ------------------------------------------------------------------- tables whose schema grows

# fixed values: types that may take the place of the ones before them
WIDER = (("tinyint", "smallint", "int", "bigint"), ("float", "double"))


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The one of two types that holds the values of both, None if none does."""
    if a == b:
        return a
    for row in WIDER:
        if a.simpleString() in row and b.simpleString() in row:
            return max(a, b, key=lambda t: row.index(t.simpleString()))
    return None


def merged_schema(stored: T.StructType, new: T.StructType) -> T.StructType:
    """The table's schema after a batch: columns are added at the end, integers
    and floats may widen, anything else is refused."""
    fields = {f.name: f.dataType for f in stored.fields}
    for f in new.fields:
        wider = _wider(fields.get(f.name, f.dataType), f.dataType)
        if wider is None:
            raise ValueError(f"column {f.name} holds {fields[f.name].simpleString()}, not {f.dataType.simpleString()}")
        fields[f.name] = wider
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


SCHEMAS = T.StructType([T.StructField("schema", T.StringType()), T.StructField(BATCH, T.LongType())])


def stored_schema(spark: SparkSession, path: str, before: int | None = None) -> T.StructType:
    """The schema kept with the table (as it was before a batch, if given)."""
    kept = read_if_there(spark, f"{path}/schemas", SCHEMAS)
    if before is not None:
        kept = kept.where(F.col(BATCH) < before)
    last = kept.orderBy(F.desc(BATCH)).first()
    return T.StructType.fromJson(json.loads(last.schema)) if last else T.StructType([])


def append_evolving(df: DataFrame, path: str, batch_id: int) -> None:
    """Append a batch to a table that keeps its own schema.

    The schema after the batch is written before its rows, once per change, so
    readers never meet a column they do not know. A batch delivered again
    replaces its rows; one whose columns cannot be merged is refused and writes
    nothing.
    """
    spark = df.sparkSession
    stored = stored_schema(spark, path, batch_id)
    merged = merged_schema(stored, df.schema)
    if merged != stored:
        row = spark.createDataFrame([(json.dumps(merged.jsonValue()),)], "schema string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/schemas/{BATCH}={batch_id}")
    df.select(*[F.col(c).cast(merged[c].dataType).alias(c) for c in df.columns]) \
        .write.mode("overwrite").parquet(f"{path}/rows/{BATCH}={batch_id}")


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All rows by the stored schema: older rows read new columns as null, and
    narrower values as the wider type."""
    schema = stored_schema(spark, path)
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return read_if_there(spark, f"{path}/rows", full).select(*schema.names)


def evolving_sink(path: str, transform: Callable[[DataFrame, int], DataFrame] | None = None):
    """``foreachBatch`` function that appends each micro-batch to ``path``."""
    def _sink(batch: DataFrame, batch_id: int) -> None:
        append_evolving(transform(batch, batch_id) if transform else batch, path, batch_id)
    return _sink


def replay_checkpoint(spark: SparkSession, name: str, generation: int) -> str:
    """A fresh checkpoint folder for generation ``generation`` of a query, so
    a replay starts from the earliest offsets without deleting the old one."""
    return checkpoint_path(spark, "replay", name, f"gen-{generation}")


def replay_sink(path: str, generation: int):
    """``foreachBatch`` that writes each batch to its own folder of the
    generation; a batch delivered again replaces it."""
    def _sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{GENERATION}={generation}/{BATCH}={batch_id}")
    return _sink


def read_replayed(spark: SparkSession, path: str, generation: int) -> DataFrame:
    """Rows of one generation of a replayed table."""
    return spark.read.option("basePath", f"{path}/{GENERATION}={generation}").parquet(f"{path}/{GENERATION}={generation}").drop(BATCH)


def replay(build: Callable[[], DataFrame], name: str, generation: int, target: str, trigger: dict | None = None):
    """Reset and replay: start ``build()`` (a stream whose source reads from the
    earliest offset) under a fresh checkpoint generation and build generation
    ``generation`` of ``target`` from scratch. Nothing is deleted: older
    checkpoints and generations stay as they were."""
    df = build()
    ckpt = replay_checkpoint(df.sparkSession, name, generation)
    w = (df.writeStream.queryName(f"{name}-gen{generation}").outputMode("append")
         .option("checkpointLocation", ckpt).foreachBatch(replay_sink(target, generation)))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, mode: str = "append") -> None:
    w = df.write.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def jdbc_upsert_sink(url: str, table: str, key: str, order: str, properties: dict | None = None,
                     transform: Callable[[DataFrame], DataFrame] | None = None):
    """``foreachBatch`` for a relational target keyed by ``key``: the batch is
    reduced to the newest row per key, written to a staging table in parallel
    over JDBC, then merged by one ``INSERT ... ON CONFLICT`` statement that the
    database executes (SQLite / PostgreSQL syntax)."""
    def _sink(batch: DataFrame, batch_id: int) -> None:
        src = transform(batch) if transform else batch
        new = newest_per_key(src, key, order).drop(order)
        stage = f"{table}__stage"
        write_jdbc(new, url, stage, properties, mode="overwrite")
        cols = ", ".join(new.columns)
        updates = ", ".join(f"{c} = excluded.{c}" for c in new.columns if c != key)
        _execute_jdbc(batch.sparkSession, url, properties or {},
                      f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {stage} WHERE true "
                      f"ON CONFLICT ({key}) DO UPDATE SET {updates}")
    return _sink


def _execute_jdbc(spark: SparkSession, url: str, properties: dict, sql: str) -> None:
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        st = conn.createStatement()
        st.executeUpdate(sql)
        st.close()
    finally:
        conn.close()
