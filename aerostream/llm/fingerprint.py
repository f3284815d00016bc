"""Threshold-scaled document fingerprints.

A text's sketch keeps every hash of its word shingles that lies below a fixed
fraction of the hash range; if none does, the smallest one. Hashes are the
first 60 bits of the MD5 of the shingle; 5 words of the lower-cased
(A-Z) text make a shingle, a text of fewer words is one shingle, a text without
words has an empty sketch. Sketches of parts can be merged by union, and as the
fraction is the same for all, the share of a short document's hashes found in a
long one estimates containment, however unequal they are. Equal texts have
equal sketches.

Everything runs as SQL functions in the JVM. Null text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostream.llm.common import WORD, lower_ascii, saved

K = 5
# first hex digit of the hashes kept: 2 of 16, an eighth of the range
KEEP_BELOW = "2"
# hex digits of a hash: 60 bits, so that it is a positive long
DIGITS = 15


def sketched(df: DataFrame, text_col: str, out: str, k: int = K, below: str = KEEP_BELOW) -> DataFrame:
    """Add ``out``: the sorted distinct kept hashes of the text, as long."""
    h, words = F.col("_hashes"), F.col("_words")
    kept = F.filter(h, lambda x: x < F.lit(below))
    kept = F.when(F.size(kept) > 0, kept).when(F.size(h) > 0, F.array(F.array_min(h))).otherwise(kept)
    low = df.withColumn("_words", F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))),
                                                       F.lit(WORD), F.lit(0)))
    n = F.size(words)
    at = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1)))).otherwise(F.array().cast("array<int>"))
    low = low.withColumn("_hashes", F.transform(
        at, lambda i: F.substring(F.md5(F.array_join(F.slice(words, i, k), " ")), 1, DIGITS)))
    as_long = F.transform(F.array_distinct(kept), lambda x: F.conv(x, 16, 10).cast("long"))
    return low.withColumn(out, F.sort_array(as_long)).drop("_words", "_hashes")


def as_text(sketch: Column) -> Column:
    """The hashes as hex digits, one after the other."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x)), DIGITS, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches; two empty ones are alike."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, F.lit(1.0)).otherwise(common.cast("double") / every)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the text of ``a`` that is in the text of ``b``."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)).cast("double") / F.size(a))


def in_order(rows: DataFrame, id_col: str, tie_col: str, cells: int) -> DataFrame:
    """Add cell: the place of a row's stretch of the order by ``id_col`` (null
    last) and ``tie_col`` (hex digits), all stretches holding about as many rows.

    Stretches end at quantiles of the id, ``cells`` numbers. An id so frequent
    that it fills several stretches is dealt to them by its tie, null likewise.
    """
    some = rows.agg(F.expr(f"approx_percentile({id_col}, {_quantiles(cells)}, 10000)").alias("q"),
                    F.count(F.lit(1)).alias("n"), F.count(id_col).alias("known")).first()
    bounds = sorted(some["q"] or [])
    nulls = -(-(some["n"] - some["known"]) * cells // max(some["n"], 1))
    share = F.conv(F.substring(tie_col, 1, 8), 16, 10).cast("long") / F.lit(float(2 ** 32))
    b = F.array(*[F.lit(x) for x in bounds]).cast("array<bigint>")
    low = F.size(F.filter(b, lambda x: x < F.col(id_col)))
    wide = F.size(F.filter(b, lambda x: x == F.col(id_col)))
    known = low + F.floor(F.greatest(wide - 1, F.lit(0)) * share)
    return rows.withColumn("cell", F.when(F.col(id_col).isNull(), F.lit(len(bounds) + 1) + F.floor(share * nulls))
                           .otherwise(known).cast("long"))


def _quantiles(cells: int) -> str:
    return "array(" + ", ".join(f"{i / cells:.9f}D" for i in range(1, max(cells, 2))) + ")"


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text (the last quarter replaced by
    as many code points from the start of the next document).

    Documents are ordered by id (null last), then text hash; repeated rows
    follow each other; the last is followed by the first, a single one by itself.
    Texts are shuffled once, by stretches of that order; the next row comes from
    a window over a stretch, that of a stretch's last row from the first rows of
    all stretches, a few per partition.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("sha", F.sha2("text", 256))
    cells = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = in_order(base, "doc_id", "sha", cells)

    # the first row of every stretch, as the next one of the stretch before it
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha")
    firsts = base.groupBy("cell").agg(F.min(key).alias("k"))
    along = Window.orderBy("cell")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select(F.col("cell").alias("_cell"), F.coalesce(F.lead("k").over(along), F.first("k").over(whole)).alias("k"))
    firsts = saved(firsts, "first-rows").select("_cell", F.col("k.doc_id").alias("_id"), F.col("k.sha").alias("_sha"))
    ends = base.select("doc_id", "sha", "text").join(
        F.broadcast(firsts),  # a row per stretch, the number of which is fixed above
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha"))) \
        .select("_cell", F.col("text").alias("end_text")).dropDuplicates(["_cell"])
    ends = sketched(saved(ends, "end-rows"), "end_text", "end_sketch")

    step = Window.partitionBy("cell").orderBy(F.col("doc_id").asc_nulls_last(), "sha")
    full = sketched(base, "text", "sketch") \
        .withColumn("next_text", F.lead("text").over(step)).withColumn("next_sketch", F.lead("sketch").over(step))
    j = full.join(ends, F.col("cell") == F.col("_cell"))
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    head = F.substring(F.coalesce("next_text", "end_text"), F.lit(1), quarter)
    j = j.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), head)) \
        .withColumn("n_chars", n.cast("long")).withColumn("next_sketch", F.coalesce("next_sketch", "end_sketch"))
    j = sketched(j.select("doc_id", "n_chars", "sketch", "next_sketch", "edited"), "edited", "edited_sketch")
    return j.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketch", "edited_sketch", "next_sketch")
