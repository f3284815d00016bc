"""Personal data: candidate spans judged by boosted trees.

Base spans follow fixed rules per kind (email, ip, card, phone) and always
stay. Beside them, high-recall generators propose further, overlapping spans:
obfuscated addresses, numbers with any separators, with or without a plus.
Features of format (digits, runs, separators, checksum, ranges) and context
(cue words before the span, neighbours) go to gradient-boosted trees, trained
by Spark ML; per kind, a threshold calibrated on held-out candidates selects
those to redact.

The trees learn from the corpus itself, from the labelled candidates of every
text: base spans, and copies of them rewritten into the loose formats people
use, are positive; other candidates, and copies whose digits no longer pass the
checks, are negative. A corpus without base spans, or without negatives, gives
no model, and base spans only.

Texts are read whole, by linear scans (no pattern backtracks over a long run of
characters), row by row inside tasks; of training only feature rows are
shuffled, of detection nothing.

Defined results: null text counts as empty (and stays null when redacted);
spans are code points, end exclusive; of overlapping added spans the likelier
one is kept, ties to the earlier and longer; added spans never overlap base
ones; repeated rows agree.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostream.llm.common import running, saved

KINDS = ("email", "ip", "card", "phone")

# fixed values: the base patterns' character classes
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local@domain.tld: each @ takes the run of local
    characters before it (back to the last match) and the longest domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield "email", start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def ips(text: str) -> Iterator[Span]:
    """Each four dot-joined numbers of a chain are one match."""
    for m in _CHAIN.finditer(text):
        if "." not in m[0]:
            continue
        at, parts = m.start(), m[0].split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(map(_byte, four)):
                yield "ip", at, at + size
            at += size + 1


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = _digits(m[0])
            if 16 <= len(d) <= 19 and luhn(d):
                yield "card", m.start(), m.end()


def phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()


def base_spans(text: str) -> list[Span]:
    return [*emails(text), *ips(text), *cards(text), *phones(text)]


# ------------------------------------------------------------------ candidates

_NUMBER = re.compile(r"(?:\+ ?|\(\+?|00 ?)?[0-9][0-9 ().\-/\xa0]{5,}+")
_GROUP = re.compile(r"[0-9]+")
_AT, _DOT = r"[\[({<] ?(?:at|AT|arroba|chez) ?[\])}>]", r"[\[({<] ?(?:dot|DOT|punto|point|punkt) ?[\])}>]"
_LOCAL_PART = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+"
_MARKED = re.compile(f"@|{_AT}")
_LOOSE_MAIL = re.compile(_LOCAL_PART + rf" ?(?:@|{_AT}) ?[A-Za-z0-9-]{{1,63}}+"
                         rf"(?:(?:\.| ?{_DOT} ?| (?:dot|DOT) )[A-Za-z0-9-]{{2,63}}+){{1,4}}")
_SPOKEN_MAIL = re.compile(_LOCAL_PART + r" (?:at|AT) [A-Za-z0-9-]{1,63}+(?: (?:dot|DOT) [A-Za-z0-9-]{2,63}+){1,4}")
_CUES = (
    ("email", re.compile(r"(?i)\b(e-?mail|mail|correo|courriel|contact|write|kontakt)\b")),
    ("phone", re.compile(r"(?i)\b(phone|tel|telefon|t[eé]l[eé]phone|tel[eé]fono|call|fax|mobile|handy|cell|whatsapp)\b")),
    ("card", re.compile(r"(?i)\b(card|visa|mastercard|amex|credit|karte|tarjeta|carte|kreditkarte)\b")),
    ("ip", re.compile(r"(?i)\b(ip|host|server|address|login|serveur|servidor)\b")),
)
NEAR = 32
MOST_DIGITS = 19
SCORED = 4096


def _stretches(text: str, start: int, end: int) -> Iterator[Span]:
    """Every stretch of neighbouring digit groups of a number run: at most 19
    for each group it begins with, so as many as the text is long."""
    groups = [g.span() for g in _GROUP.finditer(text, start, end)]
    for i, (first, _) in enumerate(groups):
        begin = start if i == 0 else first - (text[first - 1] == "(")
        n = dots = 0
        for j in range(i, min(i + MOST_DIGITS, len(groups))):
            a, stop = groups[j]
            n += stop - a
            if n > MOST_DIGITS:
                break
            dots += text.count(".", groups[j - 1][1], a) if j > i else 0
            if 7 <= n <= 15:
                yield "phone", begin, stop
            if 13 <= n:
                yield "card", begin, stop
            if dots == 3 and n <= 12 and stop - begin >= 7:
                yield "ip", begin, stop


def candidates(text: str) -> list[Span]:
    """Every span some loose pattern proposes, for every kind it could be."""
    out: list[Span] = []
    for m in _NUMBER.finditer(text):
        out += _stretches(text, m.start(), m.end())
    if _MARKED.search(text):
        out += [("email", m.start(), m.end()) for m in _LOOSE_MAIL.finditer(text)]
    if " dot " in text or " DOT " in text:
        out += [("email", m.start(), m.end()) for m in _SPOKEN_MAIL.finditer(text)]
    return out


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    s = text[start:end]
    digits = _digits(s)
    runs = [len(r) for r in re.findall(r"[0-9]+", s)]
    seps = re.findall(r"[^0-9A-Za-z]", s)
    left, right = text[max(0, start - NEAR):start], text[end:end + 8]
    parts = [p for p in re.split(r"[^0-9]+", s) if p]
    return [
        float(KINDS.index(kind)), float(end - start), float(len(digits)), float(len(runs)),
        float(max(runs, default=0)), float(min(runs, default=0)), float(runs[0] if runs else 0), float(runs[-1] if runs else 0),
        float(len(seps)), float(len(set(seps))), float(s.count(".")), float(s.count("-")), float(s.count(" ")),
        float(s.startswith("+")), float(s.startswith("00")), float("(" in s and ")" in s), float("/" in s), float("@" in s),
        float(bool(re.search(r"(?i)[\[({< ](at|arroba|chez)[\])}> ]", s))),
        float(bool(re.search(r"(?i)[\[({< ](dot|punto|point|punkt)[\])}> ]", s))),
        float(len(digits) > 1 and luhn(digits)), float(len(parts) == 4 and all(map(_byte, parts))),
        float(left[-1:].isalnum()), float(right[:1].isalnum()), float(left[-1:] in "$€£#=_%\"'"), float(right[:1] in "%=_\"'"),
        *[float(bool(cue.search(left))) for _, cue in _CUES],
        float(sum(c.isdigit() for c in left)), float(sum(c.isdigit() for c in right)),
    ]


class Taken:
    """Stretches of a text that are spoken for; disjoint and in order."""

    def __init__(self, spans: list[Span]):
        self.stretches: list[tuple[int, int]] = []
        for _, s, e in sorted(spans, key=lambda x: x[1]):
            if self.stretches and s < self.stretches[-1][1]:
                self.stretches[-1] = self.stretches[-1][0], max(e, self.stretches[-1][1])
            else:
                self.stretches.append((s, e))

    def meets(self, span: Span) -> bool:
        i = bisect.bisect_left(self.stretches, (span[2],))  # the first that begins at or after its end
        return i > 0 and self.stretches[i - 1][1] > span[1]

    def take(self, span: Span) -> None:
        bisect.insort(self.stretches, span[1:])


# ------------------------------------------------------------------ training rows

def _loosened(kind: str, s: str, rng: random.Random) -> str:
    """A base span the way people write it otherwise."""
    if kind == "email":
        at = rng.choice((" (at) ", "[at]", " [at] ", " at "))
        dot = " dot " if at == " at " else rng.choice((".", " (dot) ", "[dot]"))
        user, _, host = s.partition("@")
        return user + at + host.replace(".", dot)
    d = _digits(s)
    if kind == "phone":
        body = d[1:] if rng.random() < 0.3 and len(d) > 9 else d
        cut = sorted(rng.sample(range(2, len(body) - 1), min(2, len(body) - 3)))
        sep = rng.choice((" ", "-", ".", "/"))
        head = rng.choice(("", "00", "+ ", "(0)")) if body is d else ""
        return head + sep.join(body[a:b] for a, b in zip([0, *cut], [*cut, len(body)], strict=True))
    if kind == "card":
        sep = rng.choice((".", "/", "  "))
        return sep.join(d[i:i + 4] for i in range(0, len(d), 4))
    return s


def _spoiled(kind: str, s: str, rng: random.Random) -> str:
    """A look-alike that is no personal data: checks fail, or a bare number."""
    d = _digits(s)
    if kind == "card":
        i = rng.randrange(len(d))
        d = d[:i] + str((int(d[i]) + rng.randint(1, 9)) % 10) + d[i + 1:]
        return d if rng.random() < 0.5 else " ".join(d[i:i + 4] for i in range(0, len(d), 4))
    if kind == "ip":
        return ".".join(str(rng.randint(256, 999)) for _ in range(4))
    if kind == "phone":
        n = lambda a, b: f"{rng.randint(a, b):02d}"
        day = (str(rng.randint(1900, 2090)), n(1, 12), n(1, 28))
        return rng.choice((
            "".join(rng.choice("0123456789") for _ in range(rng.randint(7, 18))),
            "-".join(day), ".".join(reversed(day)), "/".join(day), f"{'-'.join(day)} {n(0, 23)}:{n(0, 59)}",
            f"{rng.randint(1900, 2090)}-{rng.randint(1900, 2090)} {rng.randint(1, 99)}",
            f"{rng.randint(1, 99)}.{rng.randint(100, 999)}.{rng.randint(100, 999)}", f"{rng.randint(1000, 99999)}.{n(0, 99)} {n(1, 31)}"))
    return s.replace("@", " ")


def _beside(kind: str, s: str, left: str, right: str, rng: random.Random) -> list[tuple[list[float], float]]:
    """Rows of a number with a date or another one of its kind right beside it."""
    parts = [(_loosened(kind, s, rng), True)]
    other = "".join(c if i < 3 or not c.isdigit() else rng.choice("0123456789") for i, c in enumerate(_digits(s)))
    day = f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    parts.insert(rng.randrange(2), (_loosened(kind, other, rng), True) if kind == "phone" and rng.random() < 0.5 else (day, False))
    near, good = left, set()
    for part, label in parts:
        if label:
            good.add((len(near), len(near) + len(part)))
        near += part + " "
    near = near[:-1] + right
    lo, hi = len(left), len(near) - len(right)
    return [(features(near, c), float(c[1:] in good)) for c in candidates(near) if c[0] == kind and c[1] < hi and lo < c[2]]


def training_rows(text: str) -> Iterator[tuple[list[float], float]]:
    """Labelled feature rows a text gives rise to, one by one."""
    base = base_spans(text)
    known, taken = set(base), Taken(base)
    for c in candidates(text):
        if c in known or not taken.meets(c):
            yield features(text, c), 1.0 if c in known else 0.0
    rng = random.Random(hashlib.sha256(text.encode("utf-8", "replace")).digest())
    cue = {"email": "mail", "phone": "phone", "card": "card", "ip": "server"}
    for kind, start, end in base:
        left, right = text[max(0, start - NEAR):start], text[end:end + 8]
        for made, label in ((_loosened(kind, text[start:end], rng), 1.0), (_spoiled(kind, text[start:end], rng), 0.0)):
            hint = f" {cue[kind]}: " if label and rng.random() < 0.7 else ""
            near = left + hint + made + right
            lo = len(left) + len(hint)
            hits = [c for c in candidates(near) if c[0] == kind and c[1] < lo + len(made) and lo < c[2]]
            yield from ((features(near, c), label if c[1:] == (lo, lo + len(made)) else 0.0) for c in hits)
        if kind in ("phone", "card"):
            yield from _beside(kind, text[start:end], left + (f" {cue[kind]}: " if rng.random() < 0.7 else ""), right, rng)


class Trees:
    """Boosted regression trees as arrays, and the threshold of each kind."""

    def __init__(self, trees: list[tuple], thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability per row."""
        margin = np.zeros(len(rows))
        for weight, feature, cut, left, right, value in self.trees:
            node = np.zeros(len(rows), np.int64)
            while (inner := feature[node] >= 0).any():
                down = np.where(rows[np.arange(len(rows)), np.maximum(feature[node], 0)] <= cut[node], left[node], right[node])
                node = np.where(inner, down, node)
            margin += weight * value[node]
        return 1.0 / (1.0 + np.exp(-2.0 * margin))


def _flattened(weight: float, root) -> tuple:
    """A Spark ML tree as (weight, feature, cut, left, right, value) arrays."""
    rows: list[list] = []

    def walk(node) -> int:
        at = len(rows)
        rows.append([-1, 0.0, at, at, float(node.prediction())])
        if node.subtreeDepth() > 0:
            split = node.split()
            rows[at][:2] = split.featureIndex(), float(split.threshold())
            rows[at][2], rows[at][3] = walk(node.leftChild()), walk(node.rightChild())
        return at

    walk(root)
    cols = list(zip(*rows, strict=True))
    return weight, np.array(cols[0]), *(np.array(c) for c in cols[1:])


MADE = 4096
CELLS = 12  # bits of a hash that make a cell
A_TASK = 20_000  # rows that one task fits
MOST_BINS = 46_340  # its square is the largest an int holds


def labelled(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(r): every labelled feature row that comes up in any text, the label last;
    equal rows count once."""
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = ((*x, y) for t in b.column(0) for x, y in training_rows(t.as_py()))
            for part in batched(made, MADE):
                yield pa.RecordBatch.from_arrays([pa.array(list(dict.fromkeys(part)), pa.list_(pa.float64()))], ["r"])

    texts = docs.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    return texts.mapInArrow(rows_of, "r array<double>").distinct()


def trained(docs: DataFrame, text_col: str = "text", max_rows: int | None = None, trees: int = 20, depth: int = 4,
            precision: float = 0.95, seed: int = 7) -> Trees | None:
    """Trees from every labelled candidate of the documents. In the order of their
    hashes, each third row is held out and sets the thresholds, the others are fit.
    Rows stay in the cluster; the driver has the trees and thresholds only. The
    order does not depend on how files are split, nor do the tasks that rows are
    dealt to. ``max_rows``, if given, bounds the rows, by the same order.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    made = labelled(docs, text_col).select("r", F.xxhash64("r").alias("h"), F.lit(1).alias("one"), F.lit(0).alias("all"))
    made = running(saved(made.withColumn("cell", F.shiftright("h", 64 - CELLS)), "pii-made"), "all", "cell", ["h", "r"], "one", "at")
    if max_rows is not None:
        made = made.where(F.col("at") < max_rows)
    made = saved(made.select(F.slice("r", 1, F.size("r") - 1).alias("x"), F.element_at("r", -1).alias("label"), "h", "at"), "pii-rows")
    fit, held = made.where("at % 3 < 2"), made.where("at % 3 = 2")
    n, labels = fit.agg(F.count(F.lit(1)), F.count_distinct("label")).first()
    if labels < 2:
        return None
    frame = fit.repartition(n // A_TASK + 1, "h").sortWithinPartitions("h", "at").select(array_to_vector("x").alias("features"), "label")
    # beyond 10,000 rows and the square of maxBins Spark ML would place the cuts by a draw of rows
    bins = 32 if n <= 10_000 else min(math.isqrt(n - 1) + 1, MOST_BINS)
    m = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, maxBins=bins).fit(frame)
    jt, weights = m._java_obj.trees(), list(m.treeWeights)
    model = Trees([_flattened(float(w), jt[i].rootNode()) for i, w in enumerate(weights)], {})
    model.thresholds = _thresholds(held, model, precision)
    return model


def _thresholds(held: DataFrame, model: Trees, precision: float) -> dict[str, float]:
    """Per kind the lowest score from which held-out precision (one error added)
    stays at ``precision``, 0.5 at least; above 1 if there is none."""
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(x.tolist(), float).reshape(len(x), -1)))

    scored = held.select(F.element_at("x", 1).cast("int").alias("kind"), score("x").alias("p"), F.col("label").cast("long").alias("good"))
    # equal scores stand or fall together
    scored = saved(scored.groupBy("kind", "p").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"))
                   .withColumn("cell", F.floor((1 - F.col("p")) * (1 << CELLS))), "pii-scores")
    down = [F.col("p").desc()]
    sums = running(running(scored, "kind", "cell", down, "n", "_n"), "kind", "cell", down, "good", "_good")
    ok = (F.col("_good") + F.col("good")) / (F.col("_n") + F.col("n") + 1) >= precision
    least = dict(sums.where(ok).groupBy("kind").agg(F.min("p")).collect())
    return {kind: max(0.5, least.get(k, 2.0)) for k, kind in enumerate(KINDS)}


# ------------------------------------------------------------------ detection

def _view(text: str, span: Span) -> tuple[str, int, int, str]:
    """All that ``features`` looks at."""
    kind, start, end = span
    low = max(0, start - NEAR)
    return kind, start - low, end - low, text[low:end + 8]


def spans_of(text: str, model: Trees | None) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) of a text."""
    base = base_spans(text)
    if model is None:
        return base, []
    taken = Taken(base)
    cand = [c for c in candidates(text) if not taken.meets(c)]
    if not cand:
        return base, []
    good: list[tuple[float, Span]] = []
    for at in range(0, len(cand), SCORED):
        some, rows, at_row = cand[at:at + SCORED], [], {}
        # a row depends on the span and what is near: repeated text is scored once
        for c in some:
            key = _view(text, c)
            if key not in at_row:
                at_row[key] = len(rows)
                rows.append(features(text, c))
        p = model.score(np.array(rows)).tolist()
        good += [(-p[i], c) for c in some if p[i := at_row[_view(text, c)]] >= model.thresholds[c[0]]]
    added: list[Span] = []
    for _, c in sorted(good, key=lambda x: (x[0], x[1][1], -x[1][2], x[1][0])):
        if not taken.meets(c):
            taken.take(c)
            added.append(c)
    return base, added


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def redacted(text: str, spans: list[Span]) -> str:
    """Spans replaced by [KIND]; overlapping ones by one mark of the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if start >= at:
            out += text[at:start], f"[{kind.upper()}]"
        at = max(at, end)
    return "".join([*out, text[at:]])


FOUND = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, "
         "redacted string")


def found(docs: DataFrame, model: Trees | None, text_col: str = "text", into: str = "_pii") -> DataFrame:
    """docs with a struct column ``into`` (fields of ``FOUND``)."""
    names = [x.split(" ")[0] for x in FOUND.split(", ")]

    @F.pandas_udf(FOUND)
    def judge(text: pd.Series) -> pd.DataFrame:
        rows = []
        for t in text:
            base, added = spans_of(t or "", model)
            counts = [sum(s[0] == k for s in base) for k in KINDS]
            rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added), len(added),
                         None if t is None else redacted(t, base + added)))
        return pd.DataFrame(rows, columns=names)

    return docs.withColumn(into, judge(F.col(text_col).cast("string")))
