"""Mixing sources to target weights by a low-discrepancy schedule.

Sources, ordered by code point (null last), weigh 3, 1, 2, repeating, and share
``share`` times all words; a source gives at most ``most`` times its own size,
what it cannot give is shared again by weight (``targets``).

Every source's documents, shuffled by a hash, form a line of words that is cut
into blocks of equally many words. Slot t of the schedule has the golden-ratio
point t * phi mod 1, which falls into the stretch that a source has on the line
of cumulative weights; the r-th slot of a source takes the r-th block of its
line, starting over at the end. The last slot of a source is cut at its target;
a source that the points leave short by a few slots gets them at the end. So
the words taken equal the rounded target, and any stretch of the schedule holds
the sources nearly in proportion.

Only sizes, hashes and ids are shuffled, never texts. Running sums are taken in
two levels (``common.running``), so a source with a third of all rows is spread
over ``cells`` tasks; one task handles the one row that each source has.

Defined results: null or empty text has size 0 and is never taken; a null
source is a source of its own; rows that agree in id, text and source share
their words in any order (they are interchangeable); an empty table gives an
empty schedule. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostream.llm.common import WORD, running, saved

# fixed values: the weights that repeat over the sources in order
WEIGHTS = (3, 1, 2)
# 2**31 / golden ratio, odd: t * GOLDEN mod 2**31 visits every point once per 2**31 slots
GOLDEN, POINTS = 1327217885, 2 ** 31


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, key): key is the hash that shuffles a source."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       size_of(F.col(text_col)).alias("size"),
                       row_key(F.col(id_col), F.col(source_col), F.col(text_col)).alias("key"))


def row_key(ident: Column, source: Column, text: Column) -> Column:
    return F.md5(F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(F.concat(F.lit("s"), source), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))


def targets(sizes: DataFrame, share: float = 1.5, most: int = 2, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, idx, source_size, target, take) from (source, size) rows.

    With sources ordered by cap / weight, those before the k-th capped, each
    unit of weight gets (share * total - their caps) / (weight left); the right
    k is the one at which the k-th source stays within its cap.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("idx", (F.row_number().over(by_name) - 1).cast("long"))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("idx") % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w.cast("long")).withColumn("cap", F.col("source_size") * most)
    every = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.lit(share) * F.sum("source_size").over(every) - (F.sum("cap").over(by_ratio) - F.col("cap"))
    rest = F.sum("w").over(every) - (F.sum("w").over(by_ratio) - F.col("w"))
    per = per.withColumn("unit", left / rest)
    unit = F.max(F.when(F.col("unit") <= F.col("cap") / F.col("w"), F.col("unit"))).over(every)
    per = per.withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(unit, F.lit(0.0)) * F.col("w")))
    return per.select("source", "idx", "source_size", "target", F.floor(F.col("target") + 0.5).cast("long").alias("take"))


# slots of a small table's schedule; large tables have more, of ``block_words`` words
SLOTS = 16_384


def schedule(docs: DataFrame, block_words: int = 4096, cells: int = 4096, share: float = 1.5, most: int = 2,
             weights: tuple = WEIGHTS, **cols: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(schedule, documents, sources).

    The schedule has one row per piece of a document in a slot: slot (its
    order), idx (source), start (its document's first word on the source's
    line), piece_from (word of the document), words. Documents carry idx and
    start as the key to it. A block has ``block_words`` words, or fewer so that
    the whole schedule has some ``SLOTS`` slots; a source that takes less than a
    block has its one slot cut at its target.
    """
    spark = docs.sparkSession
    rows = saved(sized(docs, **cols), "mix-sizes")
    src = saved(targets(rows, share, most, weights), "mix-sources")
    total = src.agg(F.sum("take")).first()[0] or 0
    block = max(1, -(-total // POINTS), min(block_words, total // SLOTS))

    s = src.withColumnRenamed("source", "_source")
    d = rows.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source") \
        .withColumn("cell", F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * cells / F.lit(2 ** 32)) \
        .withColumn("cell", F.floor("cell"))
    d = running(d, "idx", "cell", ["key", "size"], "size", "start")
    d = saved(d.withColumn("start", F.when(F.col("size") > 0, F.col("start"))).drop("cell"), "mix-lines")

    # blocks: the pieces of documents in every block of every line
    end = F.col("start") + F.col("size")
    pieces = d.where(F.col("size") > 0).select(
        "idx", "start", end.alias("end"),
        F.explode(F.sequence(F.expr(f"start div {block}L"), F.expr(f"(start + size - 1) div {block}L"))).alias("block")) \
        .withColumn("lo", F.greatest("start", F.col("block") * block)) \
        .withColumn("hi", F.least("end", (F.col("block") + 1) * block))

    # slots: points through cumulative weights, ranked per source
    upto = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grid = 1024
    lo, hi = F.col("_lo"), F.col("_hi")
    blocks = F.expr(f"(source_size + {block - 1}L) div {block}L")
    over = F.greatest(F.col("take") - F.col("source_size"), F.lit(0))
    need = F.when(over > 0, F.col("blocks") + F.expr(f"(take - source_size + {block - 1}L) div {block}L")) \
        .otherwise(F.expr(f"(take + {block - 1}L) div {block}L"))
    lines = src.where(F.col("take") > 0).withColumn("_hi", F.sum("take").over(upto) / F.lit(max(total, 1))) \
        .withColumn("_lo", (F.sum("take").over(upto) - F.col("take")) / F.lit(max(total, 1))) \
        .withColumn("blocks", blocks).withColumn("need", need) \
        .select("idx", "source_size", "take", "blocks", "need", "_lo", "_hi")
    stretch = lines.select("idx", "_lo", "_hi", F.explode(F.sequence(
        F.floor(lo * grid), F.least(F.floor(hi * grid), F.lit(grid - 1)))).alias("_cell"))
    n = -(-total // block)
    point = F.pmod(F.pmod(F.col("id"), F.lit(POINTS)) * F.lit(GOLDEN), F.lit(POINTS)) / F.lit(float(POINTS))
    points = spark.range(n).withColumn("u", point).withColumn("_cell", F.floor(F.col("u") * grid))
    slots = points.join(stretch, "_cell").where((F.col("u") >= lo) & (F.col("u") < hi)) \
        .select("idx", "id", F.expr(f"id div {max(1, n // cells)}L").alias("chunk"), F.lit(1).cast("long").alias("one"))
    slots = running(slots, "idx", "chunk", ["id"], "one", "rank")
    slots = saved(slots.select("idx", "id", "rank"), "mix-slots")
    had = slots.groupBy("idx").agg(F.count(F.lit(1)).alias("had"))
    short = lines.join(had.withColumnRenamed("idx", "_i"), F.col("idx") == F.col("_i"), "left") \
        .withColumn("had", F.coalesce("had", F.lit(0))).where(F.col("had") < F.col("need")) \
        .select("idx", F.explode(F.sequence(F.col("had"), F.col("need") - 1)).alias("rank")) \
        .select("idx", (F.lit(n) + F.col("rank")).alias("id"), "rank")
    slots = slots.unionByName(short).join(lines.select("idx", "source_size", "take", "blocks", "need"), "idx") \
        .where(F.col("rank") < F.col("need"))
    turn = F.when(F.col("rank") < F.col("blocks"), F.lit(0)).otherwise(F.lit(1)).cast("long")
    slots = slots.select(F.col("idx").alias("_idx"), F.col("id").alias("slot"),
                         (F.col("rank") - turn * F.col("blocks")).alias("_block"),
                         (F.col("take") - turn * F.col("source_size")).alias("_upto"))
    out = pieces.join(slots, (F.col("idx") == F.col("_idx")) & (F.col("block") == F.col("_block"))) \
        .withColumn("words", F.least("hi", "_upto") - F.col("lo")).where(F.col("words") > 0) \
        .select("slot", "idx", "start", (F.col("lo") - F.col("start")).alias("piece_from"), "words")
    return out, d, src


def mix(docs: DataFrame, **kw) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken."""
    plan, d, _ = schedule(docs, **kw)
    taken = plan.groupBy(F.col("idx").alias("_idx"), F.col("start").alias("_start")).agg(F.sum("words").alias("taken"))
    return d.join(taken, (F.col("idx") == F.col("_idx")) & (F.col("start") == F.col("_start")), "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "key")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """docs as the mix takes them: a row for each time a document is taken
    whole, and one with its first words where a target cuts it."""
    plan = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **kw)
    per = saved(plan.where(F.col("taken") > 0).groupBy(F.col("key").alias("_mix_key")).agg(F.first("size").alias("_size"), F.sum("taken").alias("_taken")),
                "mix-taken")
    j = docs.withColumn("_key", row_key(F.col(id_col), F.col(source_col), F.col(text_col)))
    j = j.join(per, F.col("_key") == F.col("_mix_key")).dropDuplicates(["_key"])
    j = j.withColumn("_words", F.explode(F.concat(
        F.array_repeat(F.col("_size"), F.expr("_taken div _size").cast("int")),
        F.when(F.col("_taken") % F.col("_size") > 0, F.array(F.col("_taken") % F.col("_size"))).otherwise(F.array().cast("array<bigint>")))))
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("_words").cast("int")), "")
    return j.withColumn(text_col, F.when(F.col("_words") == F.col("_size"), F.col(text_col)).otherwise(cut)).select(*docs.columns)
