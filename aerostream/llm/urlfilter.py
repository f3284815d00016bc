"""URL filter: host and path rules, then a character language-model ratio.

Rules decide the urls they fit; the longest wins. The urls decided by rules are
also the labelled data: two variable-order Markov models over characters, one
of accepted and one of rejected urls, give every other url the logarithm of
the ratio of its likelihoods divided by its length, and a threshold calibrated
on held-out labelled urls decides.

Model: for each order k = 0..ORDER the counts of (k characters, next character)
and of the k characters. P_k = (n(context, next) + BETA * P_(k-1)) /
(n(context) + BETA), P_(-1) = 1 / ALPHABET: an unseen context falls back to the
shorter one. Counts are exact, over all labelled urls but the fifth that is held
out for the threshold, in a written table that grows with what the urls hold. A
place of a url is its window: the character and up to ORDER before it. Windows are
made distinct, joined to the table once each, and their values joined back to the
distinct urls; common windows and characters are salted. Nothing of it
reaches the driver but the threshold.

Defined results: a null url or one without ``://`` has empty host and path; no
rule fits it and its score is 0; without labelled urls of both classes every
score is 0; score >= threshold means allow; repeated rows are judged alike. SQL
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostream.llm.common import lower_ascii, saved

ORDER = 4
BETA = 2.0
ALPHABET = 128.0
SALT = 8
UNIT = 2.0 ** 40  # values are summed up as whole numbers, so in any order


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest (verdict, 'host/path') that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _windows(urls: DataFrame, *keep: str) -> DataFrame:
    """keep and w: one row per character of ``url``, with up to ORDER before it.
    Only windows at a url's start are shorter than ORDER + 1."""
    url = F.col("url")
    start = F.transform(F.sequence(F.lit(1), F.least(F.lit(ORDER), F.length(url))), lambda i: F.substring(url, F.lit(1), i))
    # one pass over the url: a match takes one character and looks ahead for the window it begins
    rest = F.regexp_extract_all(url, F.lit(rf"(?s)(?=(.{{{ORDER + 1}}}))."), F.lit(1))
    every = F.concat(start, rest)
    # the outer form: for a plain explode the optimizer infers a filter that computes every window again
    return urls.where(F.length(url) > 0).select(*keep, F.explode_outer(every).alias("w"))


def _grams(windows: DataFrame, *keep: str) -> DataFrame:
    """keep, k and gram of every order k: a window's last k + 1 characters, fewer
    only at a url's start, so that k and gram tell the places before it."""
    return windows.select(*keep, F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("k"), "w") \
        .select(*keep, "k", F.expr("right(w, k + 1)").alias("gram"))


def _salted(k: Column, every: bool) -> Column:
    """All salts of a row of the model, or that of a window: one character ends many."""
    if every:
        return F.explode(F.sequence(F.lit(0), F.when(k < 2, F.lit(SALT - 1)).otherwise(F.lit(0))))
    return F.when(k < 2, F.pmod(F.xxhash64("w"), F.lit(SALT))).otherwise(F.lit(0)).cast("int")


def model(labelled: DataFrame) -> DataFrame:
    """(k, gram, good, bad, all_good, all_bad): how often accepted and rejected
    urls hold each gram, and its context (the gram but its last character) with
    any next one. Counts are summed up within tasks before each shuffle."""
    def total(df: DataFrame, *keys: str | Column) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))

    n = F.col("n") if "n" in labelled.columns else F.lit(1)
    one = labelled.select("url", F.when(F.col("good"), n).otherwise(0).cast("long").alias("good"),
                          F.when(F.col("good"), 0).otherwise(n).cast("long").alias("bad"))
    windows = total(_windows(one, "good", "bad"), "w")
    events = saved(total(_grams(windows, "good", "bad"), "k", "gram"), "url-events")
    context = F.expr("left(gram, length(gram) - 1)")
    contexts = total(events.withColumn("context", context), F.col("k").alias("_k"), "context") \
        .select("_k", F.col("context").alias("_context"), F.col("good").alias("all_good"), F.col("bad").alias("all_bad"))
    return saved(events.join(contexts, (F.col("k") == F.col("_k")) & (context == F.col("_context")))
                 .drop("_k", "_context"), "url-model")


def _values(windows: DataFrame, table: DataFrame) -> DataFrame:
    """(w, value): log P(last | before, accepted) - log P(last | before, rejected) of
    distinct windows, in UNITs."""
    t = table.select(F.col("k").alias("_k"), F.col("gram").alias("_gram"), "good", "bad",
                     _salted(F.col("k"), True).alias("_salt"))
    c = table.select("k", F.expr("left(gram, length(gram) - 1)").alias("context"), "all_good", "all_bad").distinct() \
        .select(F.col("k").alias("_ck"), F.col("context").alias("_context"), "all_good", "all_bad",
                _salted(F.col("k"), True).alias("_csalt"))
    g = _grams(windows, "w").withColumn("salt", _salted(F.col("k"), False)) \
        .withColumn("context", F.expr("left(gram, length(gram) - 1)"))
    g = g.join(t, (F.col("k") == F.col("_k")) & (F.col("gram") == F.col("_gram")) & (F.col("salt") == F.col("_salt")), "left") \
        .join(c, (F.col("k") == F.col("_ck")) & (F.col("context") == F.col("_context")) & (F.col("salt") == F.col("_csalt")), "left")
    seen = [F.coalesce(x, F.lit(0)).alias(x) for x in ("good", "bad", "all_good", "all_bad")]
    orders = g.groupBy("w").agg(F.sort_array(F.collect_list(F.struct("k", *seen))).alias("o"))

    def p(event: str, context: str) -> Column:
        return F.aggregate("o", F.lit(1.0 / ALPHABET), lambda acc, o: (o[event] + F.lit(BETA) * acc) / (o[context] + F.lit(BETA)))

    return orders.select("w", F.round((F.log(p("good", "all_good")) - F.log(p("bad", "all_bad"))) * UNIT).cast("long").alias("value"))


def scored(df: DataFrame, table: DataFrame, url_col: str = "url") -> DataFrame:
    """Add score: log P(url | accepted) - log P(url | rejected), per character; 0
    for null and empty urls."""
    urls = saved(df.select(F.col(url_col).alias("url")).where(F.length("url") > 0).distinct()
                 .withColumn("id", F.monotonically_increasing_id()), "url-distinct")
    values = _values(_windows(urls).distinct(), table)
    values = saved(values, "url-windows").select(F.col("w").alias("_w"), "value",
                                                 F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("_salt"))
    places = _windows(urls, "id").withColumn("salt", F.pmod("id", F.lit(SALT)).cast("int"))
    # merged at every size: the values' table is not sent to every task by way of the driver
    sums = places.join(values.hint("merge"), (F.col("w") == F.col("_w")) & (F.col("salt") == F.col("_salt"))) \
        .groupBy(F.col("id").alias("_id")).agg(F.sum("value").alias("value"))
    scores = urls.join(sums, F.col("id") == F.col("_id")) \
        .select(F.col("url").alias("_url"), (F.col("value") / F.lit(UNIT) / F.length("url")).alias("_score"))
    return df.join(saved(scores, "url-scores"), F.col(url_col) == F.col("_url"), "left") \
        .withColumn("score", F.coalesce("_score", F.lit(0.0))).drop("_url", "_score")


def threshold(held: DataFrame) -> float:
    """The score from which allowing is right most often on held-out urls, both
    classes weighing the same; found over 2000 steps of the score."""
    step = F.greatest(F.lit(-1000), F.least(F.lit(1000), F.floor(F.col("score") * 250))).cast("int")
    by = held.groupBy(step.alias("step")).agg(F.sum(F.col("good").cast("long")).alias("g"),
                                              F.sum((~F.col("good")).cast("long")).alias("b"))
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    right = (F.coalesce(F.sum("b").over(below), F.lit(0)) / F.greatest(F.sum("b").over(every), F.lit(1))
             - F.coalesce(F.sum("g").over(below), F.lit(0)) / F.greatest(F.sum("g").over(every), F.lit(1)))
    best = by.withColumn("right", right).orderBy(F.desc("right"), F.abs("step")).select("step").first()
    return best[0] / 250 if best and best[0] > -1000 else 0.0


def judged(pages: DataFrame, rules: list[tuple[str, str]], url_col: str = "url") -> DataFrame:
    """pages with host, path, rule, verdict and score."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.withColumn("host", host).withColumn("path", path)
    rows = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    known = saved(rows.where(F.col("_rule").isNotNull()).groupBy(F.col(url_col).alias("url")).agg(
        F.first(F.col("_rule.verdict") == "allow").alias("good"), F.count(F.lit(1)).alias("n")), "url-labelled")
    held = F.pmod(F.xxhash64("url", F.lit(7)), F.lit(5)) == 0
    rows = scored(rows, model(known.where(~held)), url_col)
    judged_by_rule = rows.where(F.col("_rule").isNotNull()).select(
        F.col(url_col).alias("url"), (F.col("_rule.verdict") == "allow").alias("good"), "score")
    cut = threshold(judged_by_rule.where(held))
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("score") >= F.lit(cut), "allow").otherwise("block"))
    return rows.withColumn("rule", F.col("_rule.rule")).withColumn("verdict", verdict).drop("_rule")
