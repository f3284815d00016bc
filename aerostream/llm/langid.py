"""Language identification by rank-order profiles.

A language's profile lists its TOP most frequent character n-grams (1 to 3
characters of lower-cased words padded with spaces) by rank. A document's own
most frequent n-grams are ranked alike, and its distance to a profile is the
sum, over them, of how far each is out of place (TOP for one not in the
profile). The nearest language wins; the score compares it with the runner-up
and with the largest distance there can be.

Profiles are learnt from about ``max_docs`` labelled documents of each language
(a bounded sample of labelled rows, chosen by the text's hash, so it does not
depend on how files are split; a repeated text counts once); tasks send all their n-gram
counts, summed up per language before the shuffle. Whole
texts are compared, however long; no source, label or id is an input of a
prediction.

Defined results: null text, or text without a letter, is ``und`` with score 0;
with no profile at all every document is ``und``; ties go to the language first
in code point order; documents with a null label teach nothing; rows are
handled one by one, so repeated ones agree.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP = 300
UNKNOWN = "und"
LETTERS = regex.compile(r"\p{L}+")


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and their counts, as (packed, count).

    Code points are packed 21 bits each, so an n-gram of up to three is one
    64-bit number; shorter ones leave the upper bits empty.
    """
    words = LETTERS.findall(text.lower())
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.int64)
    two = (codes[:-1] << 21) | codes[1:]
    three = (two[:-1] << 21) | codes[2:]
    inner = codes[1:-1] != 32  # n-grams that reach over a space say nothing of a word
    return np.unique(np.concatenate([codes[codes != 32], two, three[inner]]), return_counts=True)


def top_grams(grams: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent n-grams, ties by their number."""
    if len(grams) > top:
        least = np.partition(counts, -top)[-top]
        keep = counts >= least
        grams, counts = grams[keep], counts[keep]
    return grams[np.lexsort((grams, -counts))][:top]


class Profiles:
    """Ranks of every n-gram in any profile, by language."""

    def __init__(self, ranked: dict[str, np.ndarray], top: int = TOP):
        self.top, self.langs = top, sorted(ranked, key=lambda x: x.encode())
        self.grams = np.unique(np.concatenate([*ranked.values(), np.empty(0, np.int64)]).astype(np.int64))
        self.place = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        for i, lang in enumerate(self.langs):
            self.place[i, np.searchsorted(self.grams, ranked[lang])] = np.arange(len(ranked[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        grams, counts = gram_counts(text) if text else (np.empty(0, np.int64),) * 2
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        own = top_grams(grams, counts, self.top)
        at = np.searchsorted(self.grams, own)
        hit = (at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == own)
        place = self.place[:, np.where(hit, at, len(self.grams))]
        off = np.where(place < 0, self.top, np.abs(place - np.arange(len(own))))
        far = np.minimum(off, self.top).sum(axis=1) / (self.top * len(own))
        best = int(far.argmin())
        rest = np.delete(far, best)
        margin = 1.0 if not len(rest) else float(rest.min() - far[best]) / max(float(rest.min()), 1e-12)
        return self.langs[best], round(min(1.0, max(0.0, 0.5 * (1.0 - float(far[best])) + 0.5 * margin)), 6)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", max_docs: int = 4000,
          max_langs: int = 1000, top: int = TOP) -> Profiles:
    """Profiles from the non-null labels of ``labelled``: of the ``max_langs``
    most frequent ones (a bound on the model's size), some ``max_docs`` rows each."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(text_col), F.lit(1_000_000)).alias("draw"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()
    if not sizes:
        return Profiles({}, top)
    rate = F.create_map(*[F.lit(x) for lang, n in sizes for x in (lang, min(1_000_000, max_docs * 1_000_000 // n + 1))])
    rows = rows.where(F.col("draw") < F.coalesce(rate[F.col("lang")], F.lit(0))).select("lang", "text").distinct()
    out = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                g, n = gram_counts(text)
                total.setdefault(lang, Counter()).update(dict(zip(g.tolist(), n.tolist(), strict=True)))
            if sum(map(len, total.values())) > 500_000:  # bounded memory: send what there is
                yield from _rows(total, out)
                total = {}
        yield from _rows(total, out)

    grams = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = grams.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    found: dict[str, list] = {}
    for lang, gram, rank in ranked.select("lang", "gram", "rank").collect():  # top rows for each language
        found.setdefault(lang, []).append((rank, gram))
    return Profiles({k: np.array([g for _, g in sorted(v)], np.int64) for k, v in found.items()}, top)


def _rows(total: dict[str, Counter], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for lang, c in total.items():
        if c:
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c)), pa.array(c.keys(), pa.int64()),
                                              pa.array(c.values(), pa.int64())], schema=schema)


def identified(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score."""
    sent = docs.sparkSession.sparkContext.broadcast(profiles)  # top n-grams of each language

    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        p = sent.value
        return pd.DataFrame([p.predict(t) for t in text], columns=["lang_pred", "score"])

    return docs.withColumn("_p", predict(F.col(text_col).cast("string"))) \
        .select(*docs.columns, F.col("_p.lang_pred").alias("lang_pred"), F.col("_p.score").alias("score"))
