"""Fill-in-middle transformation over Roaring-style boundary sets.

A text is cut into units: runs of A-Z and a-z, and single other characters. The
offsets (code points) at which a unit may start or end, 0 and the text's length
among them, are a set of integers, kept as Roaring bitmaps keep theirs: by the
upper bits in containers of 2**16 offsets, each an array, a bitmap or a list of
runs, whichever is smallest, with cumulative cardinalities over the containers.
``select(k)``, the offset after k units, searches the container by cardinality
and then selects inside it; both cuts of a document are two such calls.

Only the three numbers come back from Python; texts are cut and put together by
Spark's string functions. A set belongs to one text and is gone after it, so
memory is bounded by a batch of texts; nothing is shuffled.

Defined results: a null text is an empty one, and an empty text stays plain; a
null id draws like the empty id; repeated rows and ids each give their own (equal)
row; all input columns are kept together in ``doc``, so no name clashes; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the marks of the three parts
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHUNK = 1 << 16
CUTS = "n long, first long, second long"


class Container:
    """The members of one chunk, in the smallest of three forms."""

    def __init__(self, members: np.ndarray):
        self.size = int(np.count_nonzero(members))
        edge = np.flatnonzero(np.diff(members.astype(np.int8), prepend=0, append=0))
        starts, ends = edge[::2], edge[1::2]
        forms = {"array": 2 * self.size, "bitmap": CHUNK // 8, "run": 4 * len(starts)}
        self.form = min(forms, key=forms.get)
        if self.form == "array":
            self.values = np.flatnonzero(members).astype(np.uint16)
        elif self.form == "run":
            self.values = starts.astype(np.uint16)
            self.upto = np.cumsum(ends - starts)
        else:
            bits = np.zeros(CHUNK // 8, np.uint8)
            packed = np.packbits(members, bitorder="little")
            bits[:len(packed)] = packed
            self.values = bits.view("<u8")
            self.upto = np.cumsum(np.bitwise_count(self.values), dtype=np.int64)

    def select(self, k: int) -> int:
        """The member with k members before it."""
        if self.form == "array":
            return int(self.values[k])
        at = int(np.searchsorted(self.upto, k, side="right"))
        k -= int(self.upto[at - 1]) if at else 0
        if self.form == "run":
            return int(self.values[at]) + k
        word = int(self.values[at])
        for _ in range(k):
            word &= word - 1  # take the lowest member away
        return 64 * at + (word & -word).bit_length() - 1


class BoundarySet:
    """Set of offsets: containers by upper bits, and how many members each of
    them and all before it have."""

    def __init__(self, members: np.ndarray):
        """``members``: booleans, the offset is the index."""
        made = [(at >> 16, Container(members[at:at + CHUNK])) for at in range(0, len(members), CHUNK)]
        self.upper, self.containers = zip(*[m for m in made if m[1].size], strict=True)
        self.upto = np.cumsum([c.size for c in self.containers])

    def __len__(self) -> int:
        return int(self.upto[-1])

    def select(self, k: int) -> int:
        """The member with k members before it, k less than the set's size."""
        at = int(np.searchsorted(self.upto, k, side="right"))
        return (self.upper[at] << 16) + self.containers[at].select(k - (int(self.upto[at - 1]) if at else 0))


def boundaries(text: str) -> BoundarySet:
    """Offsets between the units of a text, 0 and its length included."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = (points | 32) - np.uint32(97) < 26
    members = np.ones(len(points) + 1, bool)
    members[1:-1] = ~(letter[:-1] & letter[1:])
    return BoundarySet(members)


def _cuts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, h1, h2 in batches:
        out = []
        for text, a, b in zip(texts, h1, h2, strict=True):
            s = boundaries(text)
            cuts = sorted((int(a) % len(s), int(b) % len(s)))
            out.append((len(s) - 1, s.select(cuts[0]), s.select(cuts[1])))
        yield pd.DataFrame(out, columns=["n", "first", "second"])


def draw(id_col: Column, salt: str, i: int) -> Column:
    """The i-th number (from 0, 32 bits) of a document's draws, the same in every run."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt: str = "1",
                plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """(doc, n, form, prefix_chars, middle_chars, output) per row of ``docs``.

    ``plain_percent`` of the documents, empty texts and those that hold a mark
    stay as they are; of the others ``spm_percent`` go suffix first.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(id_col).alias("_id"), text.alias("_text"),
                       *[draw(F.col(id_col), salt, i).alias(f"_h{i + 1}") for i in range(4)])
    marked = F.contains("_text", F.lit(PREFIX)) | F.contains("_text", F.lit(SUFFIX)) | F.contains("_text", F.lit(MIDDLE))
    plain = (F.col("_text") == "") | marked | (F.col("_h3") % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("_h4") % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.select("doc", "_text", form.alias("form"), F.pandas_udf(_cuts, CUTS)("_text", "_h1", "_h2").alias("_cut"))
    first, second = F.col("_cut.first").cast("int"), F.col("_cut.second").cast("int")
    prefix = F.substring("_text", F.lit(1), first)
    middle = F.substring("_text", first + 1, second - first)
    suffix = F.substring("_text", second + 1, F.length("_text"))
    output = F.when(F.col("form") == "plain", F.col("_text")) \
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)) \
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    cut = F.col("form") != "plain"
    return rows.select("doc", F.col("_cut.n").alias("n"), "form", F.when(cut, F.col("_cut.first")).alias("prefix_chars"),
                       F.when(cut, F.col("_cut.second") - F.col("_cut.first")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text, rebuilt from output and form alone: a text that holds a mark is
    plain, so each mark stands once in the others."""
    left, right = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    psm = F.concat(F.substring_index(F.substring_index(left, SUFFIX, 1), PREFIX, -1), right, F.substring_index(left, SUFFIX, -1))
    spm = F.concat(F.substring_index(left, PREFIX, -1), right, F.substring_index(F.substring_index(left, PREFIX, 1), SUFFIX, -1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
