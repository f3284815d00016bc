"""Word-count cases of the reference tests plus tokeniser edge rows."""

from pyspark.sql import functions as F

from aerostream.functions.text import java_split, split_lines
from aerostream.operators.words import get_word, word_count, word_count_json


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def _counts(df):
    return {r["word"]: r["count"] for r in df.collect()}


def test_single_line(spark):
    assert _counts(word_count(_lines(spark, ["Hello Kafka Streams"]))) == {"hello": 1, "kafka": 1, "streams": 1}


def test_two_lines(spark):
    got = _counts(word_count(_lines(spark, ["Hello Kafka Streams", "Kafka Streams"])))
    assert got == {"hello": 1, "kafka": 2, "streams": 2}


def test_sql_variant_from_json(spark):
    msgs = ['{"message": "Hello Flink"}', '{"message": "Hello Kafka"}', '{"message": "Flink and Kafka"}',
            "Hello Flink", "{}"]  # bad JSON and a missing field are dropped
    got = _counts(word_count_json(_lines(spark, msgs)))
    assert got == {"hello": 2, "flink": 2, "kafka": 2, "and": 1}


def test_java_split_edges(spark):
    df = _lines(spark, [" a b!", "!!!", "", "abc", "a!", "Hello, World..."])
    got = [r[0] for r in df.select(java_split(F.col("value"))).collect()]
    assert got == [["", "a", "b"], [], [""], ["abc"], ["a"], ["hello", "world"]]


def test_sql_mode_drops_empties(spark):
    got = _counts(word_count(_lines(spark, [" a b!", "!!!", ""]), mode="sql"))
    assert got == {"a": 1, "b": 1}


def test_java_mode_counts_empties(spark):
    got = _counts(word_count(_lines(spark, [" a b!", "!!!", ""])))
    assert got == {"": 2, "a": 1, "b": 1}


def test_null_line_skipped(spark):
    df = spark.createDataFrame([(None,), ("x",)], "value string")
    assert _counts(word_count(df)) == {"x": 1}


def test_split_lines(spark):
    df = _lines(spark, ["a\nb", "a\n", "", "\n", "a\r\nb\rc", "a\n\nb"])
    got = [r[0] for r in df.select(split_lines(F.col("value"))).collect()]
    assert got == [["a", "b"], ["a"], [], [""], ["a", "b", "c"], ["a", "", "b"]]


def test_get_word_known_and_unknown(spark):
    counts = word_count(_lines(spark, ["Hello Kafka"]))
    assert [tuple(r) for r in get_word(counts, "kafka").collect()] == [("kafka", 1)]
    assert get_word(counts, "nope").count() == 0


def test_lookup_word_equals_full_count(spark):
    from aerostream.operators.words import lookup_word
    from aerostream.sources.tables import lines
    from tests.conftest import SF_SMALL

    ls = lines(spark, SF_SMALL)
    full = word_count(ls)
    for w in ["the", "data", "zzzz_unknown", "a1", ""]:
        assert sorted(map(tuple, lookup_word(ls, w).collect())) == sorted(map(tuple, get_word(full, w).collect())), w
