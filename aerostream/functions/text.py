"""Text tokenising expressions (JVM-side regex, no Python per row).

Two tokenisers reproduce the two word counts:

* ``java`` — lower-case, then split on runs of non-word characters with the
  rules of ``String.split(regex)``: trailing empty tokens are dropped, a leading
  empty token is kept, ``""`` gives ``[""]`` and a string of separators only
  gives ``[]``.
* ``sql`` — the same split with null / empty tokens dropped.

Both extract the runs of word characters in one regex pass
(``regexp_extract_all``), which is cheaper than splitting and trimming empties.

``\\W`` is the ASCII class ``[^A-Za-z0-9_]`` in Java regex, which Spark uses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: a word is a run of \w characters (tokens are separated by \W+),
# and the line terminators
WORD = r"\w+"
LINE_BREAK = r"\r\n|\r|\n"


def _tokens(v: Column) -> Column:
    """The non-empty runs of word characters, in order."""
    return F.regexp_extract_all(v, F.lit(WORD), 0)


def java_split(text: Column, lower: bool = True) -> Column:
    """Array of tokens with Java ``String.split("\\W+")`` semantics.

    The word runs are extracted directly (one regex pass, no empty tokens);
    Java's only empties are then added back: a leading ``""`` when the text
    starts with a separator and has a word, and ``[""]`` for an empty text.
    """
    v = F.lower(text) if lower else text
    toks = _tokens(v)
    leading_sep = v.rlike(r"^\W")
    return (
        F.when(v == F.lit(""), F.array(F.lit("")))
        .when(leading_sep & (F.size(toks) > 0), F.concat(F.array(F.lit("")), toks))
        .otherwise(toks)
    )


def sql_split(text: Column, lower: bool = True) -> Column:
    """Array of the non-empty tokens separated by ``\\W+``."""
    return _tokens(F.lower(text) if lower else text)


def split_lines(text: Column) -> Column:
    """Lines of a text the way a line reader returns them.

    Terminators are ``\\n``, ``\\r`` or ``\\r\\n``; a final terminator does not start
    another line and an empty text has no lines.
    """
    parts = F.split(text, LINE_BREAK, -1)
    n = F.size(parts)
    return F.when(F.element_at(parts, -1) == F.lit(""), F.slice(parts, 1, n - 1)).otherwise(parts)
