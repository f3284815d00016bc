"""Connector option mapping, record decoders and Kafka encoders (no broker)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from aerostream.sinks import kafka as ksink
from aerostream.sources import kafka as ksrc
from aerostream.sources.files import iceberg_catalog_conf, read_or_placeholder


def test_kafka_options_security_mapping():
    opts = ksrc.kafka_options("b:9092", "flights", api_key="K", api_secret="S")
    assert opts["kafka.bootstrap.servers"] == "b:9092"
    assert opts["subscribe"] == "flights" and opts["startingOffsets"] == "earliest"
    assert opts["kafka.security.protocol"] == "SASL_SSL"
    assert opts["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="K"' in opts["kafka.sasl.jaas.config"]
    opts2 = ksrc.kafka_options("b:9092", client={"security.protocol": "PLAINTEXT", "other": "x"})
    assert opts2["kafka.security.protocol"] == "PLAINTEXT" and "kafka.other" not in opts2


def test_registry_settings_accepts_both_key_names():
    a = ksrc.registry_settings("https://r", {"basic.auth.user.info": "u:p"})
    b = ksrc.registry_settings("https://r", {"schema.registry.basic.auth.user.info": "u:p"})
    c = ksrc.registry_settings("https://r", api_key="u", api_secret="p")
    assert a == b == c and a["basic.auth.credentials.source"] == "USER_INFO"
    assert ksrc.registry_settings("https://r") == {"schema.registry.url": "https://r"}


def test_connectors_are_gated(spark):
    assert isinstance(ksrc.kafka_available(spark), bool)
    assert isinstance(ksrc.avro_available(spark), bool)


def _records(spark, values):
    rows = [(None, v.encode() if isinstance(v, str) else v, "t", 0, i, dt.datetime(2024, 1, 1)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")


def test_decode_text_and_messages(spark):
    recs = _records(spark, ["Hello Flink", '{"message": "Hello Kafka"}', "{}"])
    assert [r["value"] for r in ksrc.decode_text(recs).collect()][0] == "Hello Flink"
    msgs = [r["message"] for r in ksrc.decode_messages(recs).collect()]
    assert msgs == [None, "Hello Kafka", None]


def test_decode_flights_json(spark):
    rec = {"flightNumber": "AA1", "airline": "AA", "origin": "SFO", "destination": "JFK",
           "scheduledDeparture": 1000, "actualDeparture": None, "status": "delayed"}
    recs = _records(spark, [json.dumps(rec), "not json"])
    got = ksrc.decode_flights_json(recs).collect()
    assert len(got) == 1 and got[0]["status"] == "DELAYED" and tuple(got[0]["seq"]) == (0, 0, 1704067200000)


def test_registry_payload_strips_header(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07abc"),)], "value binary")
    assert bytes(df.select(ksrc.registry_payload(F.col("value"))).first()[0]) == b"abc"


def test_long_value_encoding(spark):
    df = spark.createDataFrame([("a", 1), ("b", 258), ("c", -1)], "word string, count long")
    got = {r["key"]: bytes(r["value"]) for r in ksink.encode_word_counts(df).collect()}
    assert got["a"] == (1).to_bytes(8, "big")
    assert got["b"] == (258).to_bytes(8, "big")
    assert got["c"] == (-1).to_bytes(8, "big", signed=True)


def test_json_upsert_encoding(spark):
    df = spark.createDataFrame([("hello", 2)], "word string, count long")
    r = ksink.encode_json_upsert(df, "word").first()
    assert r["key"] == "hello" and json.loads(r["value"]) == {"word": "hello", "count": 2}
    none = spark.createDataFrame([("hello", None)], "word string, count long")
    assert json.loads(ksink.encode_json_upsert(none, "word").first()["value"]) == {"word": "hello", "count": None}
    lines = ksink.encode_lines(spark.createDataFrame([("x",)], "value string")).first()
    assert lines["key"] is None and lines["value"] == "x"


def test_iceberg_conf():
    c = iceberg_catalog_conf("tf", "https://cat", warehouse="w", credential="k:s")
    assert c["spark.sql.catalog.tf.type"] == "rest" and c["spark.sql.catalog.tf.uri"] == "https://cat"


def test_read_or_placeholder(spark, workdir):
    df = read_or_placeholder(spark, lambda: spark.read.parquet(f"{workdir}/missing"))
    assert df.count() == 0 and "flightNumber" in df.columns


def test_json_documents_keep_nulls(spark):
    df = spark.createDataFrame([("AA1", None)], "flightNumber string, actualDeparture long")
    doc = json.loads(ksink.json_documents(df).first()["json"])
    assert doc == {"flightNumber": "AA1", "actualDeparture": None}


def test_publish_lines_records(spark, workdir):
    from aerostream.sources.files import delimited_lines

    p = f"{workdir}/m.csv"
    with open(p, "w") as fh:
        fh.write("h\nx,1\ny,2\n")
    recs = ksink.encode_lines(delimited_lines(spark, p)).collect()
    assert [(r["key"], r["value"]) for r in recs] == [(None, "x,1"), (None, "y,2")]


def _arrived(spark, rows):
    """(key, partition, offset, ms, origin) as flight records with an arrival order."""
    from aerostream.schema import FLIGHT_SCHEMA

    values = [(json.dumps({"flightNumber": k, "origin": origin, "status": "delayed"}).encode(), p, o,
               dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc)) for k, p, o, ms, origin in rows]
    recs = spark.createDataFrame(values, "value binary, partition int, offset long, timestamp timestamp") \
        .withColumns({"topic": F.lit("flights"), "key": F.lit(None).cast("binary")})
    return ksrc.flight_rows(recs, ksrc.Topic("flights", value="json", value_schema=FLIGHT_SCHEMA))


# per key, in order of delivery; the last one is the newest unless its origin says otherwise
ARRIVALS = [
    # offsets 2047 and 2048 in one millisecond
    [("A", 0, 2047, 5, "A-old"), ("A", 0, 2048, 5, "A-new")],
    # a clock that steps back
    [("B", 0, 10, 900, "B-old"), ("B", 0, 11, 100, "B-new")],
    # the key moves to another partition
    [("C", 1, 7, 100, "C-old"), ("C", 0, 3, 200, "C-new")],
    # by offset 80 is partition 0's newest; by time partition 1's newest is the newer of the two
    [("D", 0, 1, 100, "D-old"), ("D", 1, 1, 90, "D-new"), ("D", 0, 2, 80, "D-old")],
]
NEWEST = {"A-new", "B-new", "C-new", "D-new"}


def test_latest_by_arrival(spark, workdir):
    from aerostream.operators.state import latest_flight
    from aerostream.sinks import table as tbl
    from aerostream.streaming.retract import read_delayed, retraction_sink

    rows = [r for case in ARRIVALS for r in case]
    for order in (rows, rows[::-1]):
        assert {r.origin for r in latest_flight(_arrived(spark, order)).collect()} == NEWEST
    target, keyed = f"{workdir}/t", f"{workdir}/k"
    sink = retraction_sink(target, every=2)
    for batch in range(3):  # each key's records in batches of their own, the second delivered twice
        one = _arrived(spark, [case[batch] for case in ARRIVALS if batch < len(case)])
        for _ in range(2 if batch == 1 else 1):
            sink(one, batch)
            tbl.upsert(one, keyed, "flightNumber", "seq", batch)
    counts = {r.origin: r.delayed_count for r in read_delayed(spark, target, schema=one.schema).collect()}
    assert {k for k, v in counts.items() if v} == NEWEST and sum(counts.values()) == 4
    assert {r.origin for r in tbl.read_keyed(spark, keyed, "flightNumber", "seq", one.schema).collect()} == NEWEST
    assert [r.origin for r in tbl.lookup(spark, keyed, "flightNumber", "D", "seq", one.schema).collect()] == ["D-new"]


def test_registry_key_precedence():
    both = {"basic.auth.user.info": "a:b", "schema.registry.basic.auth.user.info": "c:d"}
    assert ksrc.registry_settings("http://r", both)["basic.auth.user.info"] == "c:d"
    both["schema.registry.basic.auth.user.info"] = "  "
    assert ksrc.registry_settings("http://r", both)["basic.auth.user.info"] == "a:b"


def test_lines_are_kept_whole(spark, tmp_path):
    from aerostream.sources.files import delimited_lines

    (tmp_path / "a.csv").write_text('h1,h2\n"x, y",1\n\n  \nleft\x01right\nlast\n')
    got = [r.value for r in delimited_lines(spark, str(tmp_path / "a.csv")).collect()]
    assert sorted(got) == sorted(['"x, y",1', "", "  ", "left\x01right", "last"])
    assert delimited_lines(spark, str(tmp_path / "a.csv"), header=False).count() == 6


def test_placeholder_only_where_there_is_nothing(spark, tmp_path):
    import pytest

    from aerostream.sources.files import parquet_view, read_or_placeholder

    assert read_or_placeholder(spark, lambda: spark.read.parquet(str(tmp_path / "none"))).count() == 0

    def refused():
        raise PermissionError("no access")

    with pytest.raises(PermissionError):
        read_or_placeholder(spark, refused)
    path = str(tmp_path / "flights")
    spark.createDataFrame([("F1", "delayed")], "flightNumber string, status string").write.parquet(path)
    assert parquet_view(spark, path).first().status == "DELAYED"


def test_declared_topics(spark):
    from aerostream.schema import MESSAGE_SCHEMA

    t = dt.datetime(2024, 1, 1)
    rows = [("a", 0, 0, b"k", b'{"message": "hi"}'), ("a", 0, 1, b"k", b'{"message"'), ("a", 0, 2, b"\xff", b""), ("a", 0, 3, None, None),
            ("n", 1, 0, b"x", (5).to_bytes(8, "big")), ("n", 1, 1, b"x", (-5).to_bytes(8, "big", signed=True)), ("n", 1, 2, b"x", b"123"),
            ("raw", 0, 0, b"\xff", b"\xff"), ("who", 0, 0, None, b"x")]
    recs = spark.createDataFrame([(tp, p, o, k, v, t) for tp, p, o, k, v in rows],
                                 "topic string, partition int, offset long, key binary, value binary, timestamp timestamp")
    topics = [ksrc.Topic("a", value="json", value_schema=MESSAGE_SCHEMA), ksrc.Topic("n", value="long"), ksrc.Topic("raw", "binary", "binary")]
    bad = sorted(tuple(r) for r in ksrc.bad_records(recs, topics).collect())
    assert bad == [("a", 0, 1, "value", "not json"), ("a", 0, 2, "key", "not utf-8"), ("a", 0, 2, "value", "not json"),
                   ("n", 1, 2, "value", "not 8 bytes"), ("who", 0, 0, "topic", "no decoder")]
    names = ksrc.register_topics(recs, topics, "decl_")
    assert names == ["decl_a", "decl_n", "decl_raw"]
    assert sorted(spark.table("decl_n").select("value").toPandas()["value"]) == [-5, 5]
    got = spark.sql("SELECT message, key FROM decl_a ORDER BY seq.offset").collect()
    assert [tuple(r) for r in got] == [("hi", "k"), (None, None)]
    assert spark.table("decl_raw").count() == 1
    for wrong in (dict(value="xml"), dict(key="json"), dict(value="avro")):
        with pytest.raises(ValueError):
            ksrc.Topic("t", **wrong)


def _stalling(df):
    def stall(batches):
        import time

        yield from batches
        while True:
            time.sleep(0.05)

    return df.mapInArrow(stall, df.schema)


def test_import_within_a_limit(spark, workdir):
    from aerostream.sources.files import import_table

    tracker = spark.sparkContext.statusTracker()
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    fast = import_table(spark, lambda: df, f"{workdir}/fast", 120)
    assert fast.table.count() == 1000 and not fast.cut and not fast.missing
    # cut while it reads, and in a later stage of a plan with a shuffle
    for name, slow in (("scan", lambda: _stalling(df)), ("stage", lambda: _stalling(df.groupBy("x").count()))):
        got = import_table(spark, slow, f"{workdir}/{name}", 2)
        assert got.cut and got.table.count() == 0 and "flightNumber" in got.table.columns
        assert not tracker.getActiveJobsIds()
    empty = import_table(spark, lambda: spark.read.parquet(f"{workdir}/none"), f"{workdir}/m", 60)
    assert empty.missing and not empty.cut and empty.table.count() == 0
    assert not spark.sparkContext.getJobTags()


def test_import_raises_other_failures(spark, workdir):
    from aerostream.sources.files import import_table

    def refused():
        raise PermissionError("no access")

    with pytest.raises(PermissionError):
        import_table(spark, refused, f"{workdir}/a", 60)
    broken = spark.range(5).select(F.raise_error(F.lit("broken row")).cast("long").alias("x"))
    with pytest.raises(Exception, match="broken row"):
        import_table(spark, lambda: broken, f"{workdir}/b", 60)
    assert not spark.sparkContext.getJobTags()
