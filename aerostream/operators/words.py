"""Word counts over a text stream (batch form; the stream form reuses ``words``).

Plan: scan -> Generate(explode(split)) -> partial HashAggregate -> Exchange on
``word`` -> final HashAggregate. Map-side partial counts mean a hot word (even
a third of all tokens) leaves each task as one row, so skew never reaches the
shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostream.functions.text import java_split, sql_split
from aerostream.schema import MESSAGE_SCHEMA


def words(lines: DataFrame, value_col: str = "value", mode: str = "java", lower: bool = True) -> DataFrame:
    """One row per token (``word``) of each non-null line.

    The token array is built in a projection (where common subexpressions are
    evaluated once) and exploded afterwards, so each line is split once.
    ``explode_outer`` + a null filter on the output is used instead of
    ``explode`` because the optimizer would otherwise infer a ``size(arr) > 0``
    filter that re-runs the whole split before the projection.
    """
    v = F.col(value_col)
    src = lines.where(v.isNotNull())  # a null line would fail upstream; skip it
    if mode == "java":
        toks = src.select(java_split(v, lower).alias("_t"))
        return toks.select(F.explode_outer("_t").alias("word")).where(F.col("word").isNotNull())
    if mode == "sql":
        w = F.col("word")
        toks = src.select(sql_split(v, lower).alias("_t"))
        return toks.select(F.explode_outer("_t").alias("word")).where(w.isNotNull() & (w != F.lit("")))
    raise ValueError(f"mode must be 'java' or 'sql', got {mode!r}")


def word_count(lines: DataFrame, value_col: str = "value", mode: str = "java", lower: bool = True) -> DataFrame:
    """(word, count) over all lines."""
    return words(lines, value_col, mode, lower).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def word_count_json(messages: DataFrame, value_col: str = "value", lower: bool = True) -> DataFrame:
    """SQL-table variant: JSON records with a ``message`` field; bad JSON or a
    missing field gives a null message, which is dropped."""
    parsed = messages.select(F.from_json(F.col(value_col).cast("string"), MESSAGE_SCHEMA).alias("j"))
    return word_count(parsed.select(F.col("j.message").alias("message")), "message", mode="sql", lower=lower)


def lookup_word(lines: DataFrame, word: str, value_col: str = "value", mode: str = "java",
                lower: bool = True) -> DataFrame:
    """(word, count) of one word straight from the lines, empty when unknown.

    A line can only yield the token ``w`` if it contains ``w`` as a substring
    (after lower-casing), so lines without it are dropped by a cheap ``instr``
    test before the regex split; the result is the same as filtering the full
    word count.
    """
    v = F.col(value_col)
    if word and re.fullmatch(r"[A-Za-z0-9_]+", word):
        text = F.lower(v) if lower else v
        lines = lines.where(F.instr(text, word.lower() if lower else word) > 0)
    return get_word(word_count(lines, value_col, mode, lower), word)


def get_word(counts: DataFrame, word: str) -> DataFrame:
    """Point lookup: the (word, count) row, empty when the word is unknown."""
    return counts.where(F.col("word") == F.lit(word))
