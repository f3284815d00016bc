"""Corpus pipeline: language, near duplicates, personal data, mixture, sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs; all but the last return the
columns of documents. A null in any column, empty texts and empty tables pass
through as each operator's docstring says.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostream.llm import langid, mixing, ngrams, packing, pii
from aerostream.llm.common import saved, table
from aerostream.llm.queries import tokenizer

# a document nearer to no language than this is rejected
LEAST_SCORE = 0.1

# fixed values: the columns of documents that the stages know
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def beside(stage: Stage) -> Stage:
    """The stage with all further columns of docs put aside in one struct, so no
    name can clash with those it works with; they come back as they were."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        extra = [c for c in docs.columns if c not in DOCUMENTS]
        if not extra:
            return stage(spark, docs, sf_dir)
        held = docs.select(*[c for c in docs.columns if c in DOCUMENTS], F.struct(*[F.col(f"`{c}`") for c in extra]).alias("_rest"))
        out = stage(spark, held, sf_dir)
        return out.select(*[F.col(f"_rest.`{c}`").alias(c) if c in extra else F.col(c) for c in docs.columns])
    return run


@beside
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels teach; texts without a letter go."""
    out = langid.identified(docs, langid.learn(docs))
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return out.where(known).select(*docs.columns)


@beside
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at 0.8."""
    return ngrams.one_of_each(docs, n=5, num=80, den=100)


@beside
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by marks; n_chars follows."""
    out = pii.found(docs, pii.trained(docs)).withColumn("text", F.col("_pii.redacted"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@beside
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them; n_chars follows."""
    return mixing.mixed(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return packing.packed(docs, **tokenizer())


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixture", mixture), ("sequences", sequences)]
ORACLE_SQL = None  # trees and tokens cannot be said in SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
