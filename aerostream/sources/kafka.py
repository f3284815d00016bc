"""Kafka sources: option mapping and record decoders.

The Kafka connector (``spark-sql-kafka-0-10``) and ``spark-avro`` are separate
packages; ``kafka_available`` / ``avro_available`` report whether they are on
the classpath. Decoders take the connector's ``(key, value, topic, partition,
offset, timestamp)`` rows and are plain column expressions, so they are unit
tested on hand-made binary rows without a broker.

Arrival order (``seq``) is the struct (partition, offset, ms): records of one topic
partition are ordered by offset, which is what "latest record wins" relies on;
see ``arrival`` for topics with several partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostream.schema import FLIGHT_AVRO_SCHEMA, FLIGHT_SCHEMA, MESSAGE_SCHEMA, SEQ, STATUS

# fixed values: names of the client security settings copied onto every connection
SECURITY_KEYS = (
    "security.protocol",
    "sasl.mechanism",
    "sasl.jaas.config",
    "ssl.endpoint.identification.algorithm",
    "client.dns.lookup",
)
# fixed values: accepted names of the schema-registry credential setting, the first that is not blank wins
REGISTRY_AUTH_KEYS = ("schema.registry.basic.auth.user.info", "basic.auth.user.info")

_PLAIN_JAAS = 'org.apache.kafka.common.security.plain.PlainLoginModule required username="{u}" password="{p}";'


def kafka_options(bootstrap: str, topic: str | None = None, client: dict | None = None,
                  starting_offsets: str = "earliest", api_key: str | None = None,
                  api_secret: str | None = None) -> dict[str, str]:
    """Spark Kafka options: bootstrap, subscription, start position and the
    security settings of ``client`` prefixed with ``kafka.``.

    ``api_key`` / ``api_secret`` build a SASL/PLAIN login over SSL when no JAAS
    config is given. Secrets come only from the caller.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "startingOffsets": starting_offsets}
    if topic:
        opts["subscribe"] = topic
    client = dict(client or {})
    if api_key and "sasl.jaas.config" not in client:
        client.setdefault("security.protocol", "SASL_SSL")
        client.setdefault("sasl.mechanism", "PLAIN")
        client["sasl.jaas.config"] = _PLAIN_JAAS.format(u=api_key, p=api_secret or "")
    for k in SECURITY_KEYS:
        if client.get(k) is not None:
            opts[f"kafka.{k}"] = str(client[k])
    return opts


def registry_settings(url: str, client: dict | None = None, api_key: str | None = None,
                      api_secret: str | None = None) -> dict[str, str]:
    """Schema-registry client settings: URL plus USER_INFO basic auth taken from
    either accepted key name, or from an explicit key/secret pair."""
    client = client or {}
    out = {"schema.registry.url": url}
    info = next((client[k] for k in REGISTRY_AUTH_KEYS if str(client.get(k) or "").strip()), None)
    if info is None and api_key:
        info = f"{api_key}:{api_secret or ''}"
    if info:
        out["basic.auth.credentials.source"] = "USER_INFO"
        out["basic.auth.user.info"] = info
    return out


def _has_class(spark: SparkSession, name: str) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(name)
        return True
    except Exception:
        return False


def kafka_available(spark: SparkSession) -> bool:
    return _has_class(spark, "org.apache.spark.sql.kafka010.KafkaSourceProvider")


def avro_available(spark: SparkSession) -> bool:
    return _has_class(spark, "org.apache.spark.sql.avro.AvroFileFormat")


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka topic as an unbounded stream."""
    return spark.readStream.format("kafka").options(**options).load()


def read_snapshot(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka topic as a bounded table: everything from earliest to latest now."""
    opts = {**options, "startingOffsets": "earliest", "endingOffsets": "latest"}
    return spark.read.format("kafka").options(**opts).load()


# ------------------------------------------------------------------- decoders

def arrival() -> Column:
    """Arrival order of a topic's records: (partition, offset, ms).

    Offsets order the records of a partition, whatever their timestamps say;
    timestamps only compare the newest records of different partitions. The
    struct is kept whole: ``operators.state.latest_by_key`` applies that rule.
    """
    return F.struct(F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"),
                    F.unix_millis("timestamp").alias("ms"))


def decode_text(records: DataFrame) -> DataFrame:
    """String key/value records -> ``value`` lines (plus arrival ``seq``)."""
    return records.select(F.col("value").cast("string").alias("value"), arrival().alias(SEQ))


def registry_payload(value: Column) -> Column:
    """Strip the 5-byte schema-registry header (magic byte + schema id)."""
    return F.substring(value, 6, 2147483647)


def decode_flights_avro(records: DataFrame, registry_framed: bool = True) -> DataFrame:
    """Avro flight values -> sequenced, normalised flight records (needs spark-avro)."""
    from pyspark.sql.avro.functions import from_avro

    payload = registry_payload(F.col("value")) if registry_framed else F.col("value")
    rec = records.select(from_avro(payload, FLIGHT_AVRO_SCHEMA).alias("f"), arrival().alias(SEQ))
    return _flatten(rec)


def decode_flights_json(records: DataFrame) -> DataFrame:
    """JSON flight values -> sequenced records; unparsable values become nulls and
    are dropped with the null key."""
    rec = records.select(F.from_json(F.col("value").cast("string"), FLIGHT_SCHEMA).alias("f"),
                         arrival().alias(SEQ))
    return _flatten(rec)


def _flatten(rec: DataFrame) -> DataFrame:
    cols = [F.col(f"f.{f.name}").alias(f.name) for f in FLIGHT_SCHEMA.fields]
    out = rec.select(F.col(SEQ), *cols)
    return out.where(F.col("flightNumber").isNotNull()).withColumn(STATUS, F.upper(F.col(STATUS)))


def decode_messages(records: DataFrame) -> DataFrame:
    """JSON ``{"message": ...}`` records; bad JSON or a missing field -> null."""
    return records.select(
        F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA).getField("message").alias("message"))


# ------------------------------------------------------------------- declared topics

# fixed values: the ways to read a key or a value
KINDS = ("string", "json", "avro", "long", "binary")


@dataclass(frozen=True)
class Topic:
    """How a topic's keys and values are written. JSON needs a struct type as
    schema, Avro the schema's text."""

    name: str
    key: str = "string"
    value: str = "string"
    key_schema: T.StructType | str | None = None
    value_schema: T.StructType | str | None = None

    def __post_init__(self) -> None:
        for kind, schema in ((self.key, self.key_schema), (self.value, self.value_schema)):
            if kind not in KINDS:
                raise ValueError(f"unknown decoder {kind!r}")
            if kind in ("json", "avro") and schema is None:
                raise ValueError(f"{self.name}: {kind} needs a schema")


def long_of(c: Column) -> Column:
    """8 big-endian bytes as a bigint."""
    digits = F.hex(c)
    high, low = F.conv(F.substring(digits, 1, 8), 16, 10).cast("long"), F.conv(F.substring(digits, 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


_CORRUPT = "_corrupt"


def _decoded(c: Column, kind: str, schema) -> tuple[Column, Column, str]:
    """(what is read, whether it can be read, what to say if not)."""
    if kind == "string":
        return c.cast("string"), F.is_valid_utf8(c.cast("string")), "not utf-8"
    if kind == "long":
        return long_of(c), F.length(c) == 8, "not 8 bytes"
    if kind == "json":
        wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
        read = F.from_json(c.cast("string"), wide, {"columnNameOfCorruptRecord": _CORRUPT})
        return F.struct(*[read[n].alias(n) for n in schema.names]), read.isNotNull() & read[_CORRUPT].isNull(), "not json"
    if kind == "avro":
        from pyspark.sql.avro.functions import from_avro

        read = from_avro(registry_payload(c), schema, {"mode": "PERMISSIVE"})
        return read, read.isNotNull(), "not avro"
    return c, F.lit(True), ""


def _read(records: DataFrame, topic: Topic) -> DataFrame:
    """One projection over a topic's records: key, value, seq and, per field, why
    it cannot be read. A null key or value (a tombstone) can."""
    out = {"key": F.col("key"), "value": F.col("value")}
    why = []
    for name, kind, schema in (("key", topic.key, topic.key_schema), ("value", topic.value, topic.value_schema)):
        read, fine, reason = _decoded(F.col(name), kind, schema)
        there = F.col(name).isNotNull()
        out[name] = F.when(there & fine, read)
        why.append(F.when(there & ~F.coalesce(fine, F.lit(False)), F.struct(F.lit(name).alias("field"), F.lit(reason).alias("reason"))))
    return records.where(F.col("topic") == topic.name).select(
        F.col("topic"), F.col("partition"), F.col("offset"), out["key"].alias("key"), out["value"].alias("value"),
        arrival().alias(SEQ), F.array_compact(F.array(*why)).alias("_bad"))


def topic_rows(records: DataFrame, topic: Topic) -> DataFrame:
    """(key, value, seq) of the topic's records that can be read."""
    return _read(records, topic).where(F.size("_bad") == 0).select("key", "value", SEQ)


def bad_records(records: DataFrame, topics: list[Topic]) -> DataFrame:
    """(topic, partition, offset, field, reason): the side output of records that
    cannot be read, one row per field, and of topics that nobody declared."""
    known = [t.name for t in topics]
    other = records.where(~F.coalesce(F.col("topic").isin(known), F.lit(False))).select(
        "topic", "partition", "offset", F.lit("topic").alias("field"), F.lit("no decoder").alias("reason"))
    for t in topics:
        bad = _read(records, t).select("topic", "partition", "offset", F.explode("_bad").alias("b"))
        other = other.unionByName(bad.select("topic", "partition", "offset", "b.field", "b.reason"))
    return other


def flight_rows(records: DataFrame, topic: Topic) -> DataFrame:
    """Sequenced, normalised flight records of a topic whose values are flights."""
    return _flatten(topic_rows(records, topic).select(F.col("value").alias("f"), SEQ))


def register_topics(records: DataFrame, topics: list[Topic], prefix: str = "") -> list[str]:
    """A view per topic over a bounded snapshot or a stream of records: the
    fields of a struct value as columns, else ``key`` and ``value``, and ``seq``."""
    names = []
    for t in topics:
        rows = topic_rows(records, t)
        if isinstance(rows.schema["value"].dataType, T.StructType):
            rows = rows.select("value.*", *[c for c in ("key", SEQ) if c not in rows.schema["value"].dataType.names])
        names.append(prefix + t.name.replace("-", "_").replace(".", "_"))
        rows.createOrReplaceTempView(names[-1])
    return names
