"""Exact Jaccard join of documents on word n-grams.

Two documents link when their sets of distinct n-word shingles have a Jaccard
similarity of ``num / den`` or more; documents are grouped by reachability.

* Sets. Words are runs other than white space, A-Z lower-cased; a shingle is its
  words' 64-bit hash. Equal sets are one class from the start.
* Size bands. A pair's sizes a <= b meet a / b >= num / den, so it lies in the
  band of its larger set; a set enters its own band and, near its end, the next.
* Tiles. In a band of sizes up to s, a linked pair differs in at most
  d = 2 s (den - num) / (den + num) shingles. The hash range is dealt into
  d + 1 + m parts, so a linked pair agrees in m + 1 whole parts at least: the
  hash of a part (with band and place) is a tile key, and pairs that share no key
  cannot link. m is chosen so that hardly a set has more than m empty parts;
  empty parts are keys only of sets that have.
* Keys are shared out in two steps. A task reduces its own chunks of documents
  first: of classes that share a key in a chunk only the smallest goes on, so a
  key that a third of all documents hold costs a row per chunk, not per document.
* Every class is held against the smallest class of its keys, which joins most
  groups of near copies: by bitmap first, exactly if that passes. The classes of keys that are not all connected yet
  make bundles, dealt into tiles of some ``TILE`` classes, compared two by two:
  the bit count of the exclusive or of two hashed bitmap signatures is a lower
  bound of the difference, so an upper bound of the overlap. The classes that
  are in a passing pair are dealt into tiles again, with their sorted arrays,
  which are intersected exactly. Pairs already connected are skipped; no
  other pair is dropped unless its bound or its intersection rules it out.

Shingles are made again, as bitmaps for the classes that share keys, as sorted
arrays for the classes of passing pairs only, so that hashes of the others are
never written. The documents wanted are found by one plan at every size: a Bloom
filter of bounded size (``common.KeyFilter``) is sent to every task, and what
passes is held against the table of row keys. Texts are not shuffled for it.

Defined results: null text, or text without words, is an empty set, linked with
nothing; a text of fewer than n words is one shingle; a null id is kept, the
component id is the smallest id that is not null; repeated rows are one class;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostream.llm.common import Forest, KeyFilter, components, runs, saved, tiled, together

RATIO = 1.5
TILE = 1024
CHUNK = 250_000  # keys

# fixed values: multipliers of 64-bit hashing
_M1, _M2, _BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODE = np.random.default_rng(20240130).integers(1, 2 ** 63, 256, dtype=np.uint64)  # a number for each byte


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BACK = pow(_BASE, -1, 2 ** 64)
_POWERS = {_BASE: _powers(_BASE, 1 << 16), _BACK: _powers(_BACK, 1 << 16)}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    if len(_POWERS[base]) < n:
        _POWERS[base] = _powers(base, 2 * n)
    return _POWERS[base][:n]


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's n-word shingles."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    gap = np.concatenate(([True], _SPACE[raw], [True]))
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    # word hash: difference of a running polynomial, moved to the word's start
    run = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_CODE[_LOWER[raw]] * powers(_BASE, len(raw)), out=run[1:])
    words = mixed((run[end] - run[start]) * powers(_BACK, len(raw) + 1)[start] + (end - start).astype(np.uint64))
    k = min(n, len(words))
    at = len(words) - k + 1
    total = np.zeros(at, np.uint64)
    for i in range(k):
        total = mixed(total * np.uint64(_BASE) + words[i:i + at] + np.uint64(i + 1))
    if k < n:  # a short text's one shingle is its own kind
        total = mixed(total + np.uint64(k))
    return np.unique(total)


def band_of(size: int) -> int:
    return int(np.floor(np.log(size) / np.log(RATIO) + 1e-9))


@functools.cache
def parts_in(band: int, num: int, den: int) -> tuple[int, int]:
    """(parts of a band, m): parts exceed by m + 1 what a linked pair can differ in."""
    top = int(np.floor(RATIO ** (band + 1) + 1e-6))
    differ = 2 * top * (den - num) // (den + num)
    if differ == 0:
        return 1, 0
    least = RATIO ** band * num / den  # the smallest set of the band
    m, most = 1, max(2, differ // 4)
    while m < most:
        p = differ + 1 + m
        empty = p * math.exp(-least / p)  # expected
        if m >= empty + 3 * math.sqrt(empty):
            break
        m += 1
    return differ + 1 + m, m


def tile_keys(hashes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of a set's parts in its own band and, if it can be the smaller set
    of a pair there, the next."""
    n = len(hashes)
    band = band_of(n)
    bands = [band]
    if n * den >= num * (int(np.floor(RATIO ** (band + 1) - 1e-6)) + 1):
        bands.append(band + 1)
    out = []
    high = hashes >> np.uint64(32)
    for b in bands:
        p, m = parts_in(b, num, den)
        part = (high * np.uint64(p)) >> np.uint64(32)  # hashes are sorted, so parts are stretches
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        sums = np.add.reduceat(mixed(hashes + np.uint64(b)), first)
        count = np.diff(np.append(first, n)).astype(np.uint64)
        place = part[first]
        if p - len(first) > m and p > 1:
            none = np.setdiff1d(np.arange(p, dtype=np.uint64), place)
            place, sums = np.concatenate([place, none]), np.concatenate([sums, np.zeros(len(none), np.uint64)])
            count = np.concatenate([count, np.zeros(len(none), np.uint64)])
        out.append(mixed(mixed(sums + count) + place * np.uint64(1 << 20) + np.uint64(b)))
    return np.concatenate(out)


def class_of(hashes: np.ndarray) -> int:
    """64-bit hash of a set."""
    total = np.add.reduce(mixed(hashes ^ np.uint64(_BASE)), keepdims=True)
    return int(mixed(total + np.uint64(len(hashes))).view(np.int64)[0])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for whole in batches:
        for at in range(0, whole.num_rows, 500):  # few texts as Python objects at a time
            b = whole.slice(at, 500)
            yield from zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True)


def _chunks(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int, buckets: int) -> Iterator[tuple]:
    """(documents, keys, classes): the documents' (doc_id, row_key, n_shingles,
    cls), and the keys of the classes among them, sorted, with their classes."""
    docs, keys, classes, seen, size = [], [], [], set(), 0

    def chunk() -> tuple:
        k = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        c = np.repeat(np.array([c for c, _ in classes], np.int64), np.array([x for _, x in classes], np.int64))
        # a key is its bucket and 32 bits
        k = ((k % np.uint64(buckets)) << np.uint64(32) | k >> np.uint64(32)).view(np.int64)
        order = np.lexsort((c, k))
        return docs, k[order], c[order]

    for ident, text, key in _texts(batches):
        h = shingles(text, n)
        cls = class_of(h) if len(h) else None
        docs.append((ident, key, len(h), cls))
        if cls is not None and cls not in seen:
            seen.add(cls)
            keys.append(tile_keys(h, num, den))
            classes.append((cls, len(keys[-1])))
            size += len(keys[-1])
        if size >= CHUNK or len(docs) >= CHUNK // 5:
            yield chunk()
            docs, keys, classes, seen, size = [], [], [], set(), 0
    if docs:
        yield chunk()


def sets(docs: DataFrame, n: int, num: int, den: int, buckets: int) -> DataFrame:
    """Of (doc_id, text, row_key): one row per document (doc_id, row_key,
    n_shingles, cls; cls is null for an empty set, key is null), and one for each
    class and key shared within a chunk (cls, key)."""
    out = pa.schema([("doc_id", pa.int64()), ("row_key", pa.string()), ("n_shingles", pa.int64()), ("cls", pa.int64()),
                     ("key", pa.int64())])

    def run(batches):
        for rows, key, cls in _chunks(batches, n, num, den, buckets):
            ident, name, size, own = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(ident, pa.int64()), pa.array(name), pa.array(size, pa.int64()),
                                              pa.array(own, pa.int64()), pa.nulls(len(rows), pa.int64())], schema=out)
            same = key[1:] == key[:-1]
            shared = np.concatenate((same, [False])) | np.concatenate(([False], same)) if len(key) else np.empty(0, bool)
            if shared.any():
                none = [pa.nulls(int(shared.sum()), t) for t in (pa.int64(), pa.string(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*none, pa.array(cls[shared]), pa.array(key[shared])], schema=out)

    return docs.mapInArrow(run, "doc_id long, row_key string, n_shingles long, cls long, key long")


def leaders(docs: DataFrame, n: int, num: int, den: int, buckets: int) -> DataFrame:
    """(bucket, cls, low): for the smallest class of each key in a chunk, its
    keys by bucket, as their lower 32 bits."""
    out = pa.schema([("bucket", pa.int64()), ("cls", pa.int64()), ("low", pa.list_(pa.int32()))])

    def run(batches):
        for _, key, cls in _chunks(batches, n, num, den, buckets):
            first = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.empty(0, bool)
            key, cls = key[first], cls[first]
            bucket = key >> 32
            order = np.lexsort((cls, bucket))
            bucket, cls, low = bucket[order], cls[order], (key[order] & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
            cut = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (cls[1:] != cls[:-1])))) if len(key) else []
            for at in range(0, len(cut), 200_000):
                some = cut[at:at + 200_000]
                end = cut[at + 200_000] if at + 200_000 < len(cut) else len(low)
                ends = np.append(some, end)
                lists = pa.ListArray.from_arrays(pa.array(ends - some[0], pa.int32()), pa.array(low[some[0]:end]))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[some]), pa.array(cls[some]), lists], schema=out)

    return docs.mapInArrow(run, "bucket long, cls long, low array<int>")


def contents(docs: DataFrame, ids: DataFrame, n: int, arrays: bool) -> DataFrame:
    """(cls, size, hashes, bits) of the documents (doc_id, text, row_key) with the
    row keys of ``ids``, a written table with one row per class: sorted hashes
    (null without ``arrays``) and bitmap signature, as bytes."""
    out = pa.schema([("cls", pa.int64()), ("row_key", pa.string()), ("size", pa.int64()), ("hashes", pa.binary()),
                     ("bits", pa.binary())])
    passes = KeyFilter(ids, "row_key").test()

    def run(batches):
        held, size = [], 0
        for b in batches:
            for i in np.flatnonzero(passes(b.column(2).to_numpy())):
                h = shingles(b.column(1)[i].as_py(), n)
                if not len(h):
                    continue
                held.append((class_of(h), b.column(0)[i].as_py(), len(h), h.tobytes() if arrays else None, bitmap(h)))
                size += (9 if arrays else 1) * len(h)
                if size > 8 << 20:
                    yield _rows(held, out)
                    held, size = [], 0
        if held:
            yield _rows(held, out)

    found = docs.select("row_key", "text", KeyFilter.hashed("row_key").alias("hash")) \
        .mapInArrow(run, "cls long, row_key string, size long, hashes binary, bits binary")
    # a row may be there more than once
    return found.join(ids.select("row_key"), "row_key", "left_semi").dropDuplicates(["row_key"]).drop("row_key")


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def bitmap(hashes: np.ndarray) -> bytes:
    """Bitmap signature: bit (hash mod m) for every hash, m a power of two of 4
    to 8 times the size; folded down to a shorter one's length for comparing."""
    m = 64 << max(0, int(4 * len(hashes) - 1).bit_length() - 6)
    bits = np.zeros(m, np.uint8)
    bits[hashes & np.uint64(m - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: bytes, words: int) -> np.ndarray:
    x = np.frombuffer(bits, np.uint64)
    return np.bitwise_or.reduce(x.reshape(-1, words), axis=0)


def alike(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Exact test on sorted arrays."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return den * common >= num * (len(a) + len(b) - common)


def within_bound(size_a: int, bits_a: bytes, size_b: int, bits_b: bytes, num: int, den: int) -> bool:
    """Whether two sets can link, by their sizes and bitmaps."""
    if min(size_a, size_b) * den < max(size_a, size_b) * num:
        return False
    words = min(len(bits_a), len(bits_b)) // 8
    lower = int(np.bitwise_count(folded(bits_a, words) ^ folded(bits_b, words)).sum(dtype=np.int64))
    return (den + num) * lower <= (den - num) * (size_a + size_b)


def _bounded(pairs: DataFrame, signs: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that their bitmaps let pass."""
    x = signs.select("cls", "size", "bits")
    j = pairs.join(x.select(F.col("cls").alias("a"), F.col("size").alias("sa"), F.col("bits").alias("ba")), "a") \
        .join(x.select(F.col("cls").alias("b"), F.col("size").alias("sb"), F.col("bits").alias("bb")), "b") \
        .select("a", "b", "sa", "ba", "sb", "bb")

    def run(batches):
        for t in batches:
            sa, ba, sb, bb = (t.column(i) for i in range(2, 6))
            ok = [within_bound(sa[i].as_py(), ba[i].as_py(), sb[i].as_py(), bb[i].as_py(), num, den) for i in range(t.num_rows)]
            yield t.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return j.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, content: DataFrame, num: int, den: int) -> DataFrame:
    """Add ok to (a, b): whether they link."""
    x = content.select("cls", "hashes")
    j = pairs.join(x.select(F.col("cls").alias("a"), F.col("hashes").alias("ha")), "a") \
        .join(x.select(F.col("cls").alias("b"), F.col("hashes").alias("hb")), "b").select("a", "b", "ha", "hb")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ok", pa.bool_())])

    def run(batches):
        for t in batches:
            ha, hb = t.column(2), t.column(3)
            ok = [alike(np.frombuffer(ha[i].as_py(), np.uint64), np.frombuffer(hb[i].as_py(), np.uint64), num, den)
                  for i in range(t.num_rows)]
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(ok, pa.bool_())], schema=out)

    return j.mapInArrow(run, "a long, b long, ok boolean")


def _within(tiles: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) that join classes of different components inside tiles of
    (bundle, tile_a, tile_b, side, cls, root, size, hashes, bits)."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for t in runs(batches, ("tile", "bundle", "tile_a", "tile_b")):
            found = _tile_links(t, num, den)
            if found:
                yield _rows(found, out)

    return together(tiles, ["bundle", "tile_a", "tile_b"]).mapInArrow(run, "a long, b long")


def _passing(t: pa.Table, num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows), best first, of the pairs of a tile table that are not yet
    connected and pass the bound."""
    root, size, side = t["root"].to_numpy(), t["size"].to_numpy(), t["side"].to_numpy()
    one = t["tile_a"][0].as_py() == t["tile_b"][0].as_py()
    bits = t["bits"].to_pylist()
    words = min(len(b) for b in bits) // 8
    sig = np.stack([folded(b, words) for b in bits])
    left = np.flatnonzero(side == 0)
    right = left if one else np.flatnonzero(side == 1)
    for i in left:
        near = (root[right] != root[i]) & (np.minimum(size[right], size[i]) * den >= np.maximum(size[right], size[i]) * num)
        if one:
            near &= right > i
        some = right[near]
        # overlap <= (a + b - differing bits) / 2
        lower = np.bitwise_count(sig[some] ^ sig[i]).sum(axis=1, dtype=np.int64)
        near = (den + num) * lower <= (den - num) * (size[some] + size[i])
        if near.any():
            yield int(i), some[near][np.argsort(lower[near], kind="stable")]


def _live(tiles: DataFrame, num: int, den: int) -> DataFrame:
    """(bundle, cls) of the classes that are in a passing pair."""
    out = pa.schema([("bundle", pa.int64()), ("cls", pa.int64())])

    def run(batches):
        for t in runs(batches, ("tile", "bundle", "tile_a", "tile_b")):
            found = np.zeros(t.num_rows, bool)
            for i, some in _passing(t, num, den):
                found[i] = found[some] = True
            if found.any():
                yield pa.RecordBatch.from_arrays([pa.array(t["bundle"].to_numpy()[found]), pa.array(t["cls"].to_numpy()[found])],
                                                 schema=out)

    return together(tiles, ["bundle", "tile_a", "tile_b"]).mapInArrow(run, "bundle long, cls long").distinct()


def _tile_links(t: pa.Table, num: int, den: int) -> list[tuple]:
    cls, root, raw = t["cls"].to_numpy(), t["root"].to_numpy(), t["hashes"]
    forest, links = Forest(), []
    for i, some in _passing(t, num, den):
        mine = np.frombuffer(raw[i].as_py(), np.uint64)
        for j in some:
            a, b = int(root[i]), int(root[j])
            if forest.root(a) != forest.root(b) and alike(mine, np.frombuffer(raw[j].as_py(), np.uint64), num, den):
                forest.join(a, b)
                links.append((int(cls[i]), int(cls[j])))
    return links


def row_key(ident: Column, text: Column) -> Column:
    """A document's id and text in one hash: a key without nulls."""
    return F.md5(F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.when(text.isNull(), ":").otherwise(":t"),
                          F.coalesce(text, F.lit(""))))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, num: int = 90,
                   den: int = 100) -> DataFrame:
    """One row per document: doc_id, row_key, n_shingles, root (a number of its
    group, null for an empty set), component_id (smallest doc_id that links reach)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = src.withColumn("row_key", row_key(F.col("doc_id"), F.col("text")))
    spark = docs.sparkSession
    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    both = saved(sets(src, n, num, den, buckets), "jac-sets")
    rows, local = both.where(F.col("key").isNull()).drop("key"), both.where(F.col("key").isNotNull()).select("key", "cls")

    # classes that share keys: within a chunk, and the leaders of several chunks
    lead = leaders(src, n, num, den, buckets).repartition("bucket") \
        .select("bucket", "cls", F.explode_outer("low").alias("low")).where(F.col("low").isNotNull())
    held = Window.partitionBy("bucket", "low")
    lead = lead.withColumn("least", F.min("cls").over(held)).withColumn("most", F.max("cls").over(held)) \
        .where(F.col("least") != F.col("most")) \
        .select((F.col("bucket") * F.lit(2 ** 32) + F.pmod(F.col("low").cast("long"), F.lit(2 ** 32))).alias("key"), "cls")
    members = saved(lead.unionByName(local).distinct(), "jac-members")
    hubs = members.groupBy("key").agg(F.min("cls").alias("hub")).withColumnRenamed("key", "_key")
    edges = members.join(hubs, F.col("key") == F.col("_key")).where(F.col("cls") != F.col("hub")) \
        .groupBy(F.col("cls").alias("a")).agg(F.min("hub").alias("b"))

    # bitmaps of the classes that share keys, from one document of each
    wanted = members.select("cls").distinct()
    ids = saved(rows.select("cls", "row_key").join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("row_key").alias("row_key")),
                "jac-ids")
    signs = saved(contents(src, ids, n, arrays=False).drop("hashes"), "jac-signs")

    def arrays(classes: DataFrame, name: str) -> DataFrame:
        few = saved(ids.join(classes.select("cls").distinct(), "cls", "left_semi"), f"{name}-ids")
        return saved(contents(src, few, n, arrays=True), name)

    near = saved(_bounded(edges, signs, num, den), "jac-near")
    ends = near.select(F.col("a").alias("cls")).unionByName(near.select(F.col("b").alias("cls")))
    stars = saved(_verified(near, arrays(ends, "jac-ends"), num, den).where("ok").select("a", "b"), "jac-stars")
    roots = components(stars, "jac-star")
    rooted = members.join(roots, F.col("cls") == F.col("node"), "left") \
        .select("key", "cls", F.coalesce("root", "cls").alias("root"))
    rooted = saved(rooted, "jac-rooted")
    # keys whose classes are not all connected; those with the same least
    # component make one bundle, as near copies share many keys
    pending = rooted.groupBy(F.col("key").alias("_key")).agg(F.min("root").alias("bundle"), F.max("root").alias("_hi")) \
        .where(F.col("bundle") != F.col("_hi")).select("_key", "bundle")
    bundles = saved(rooted.join(pending, F.col("key") == F.col("_key")).select("bundle", "cls", "root").distinct(), "jac-bundles")
    root_of = bundles.select("cls", "root").distinct()
    signed = root_of.join(signs, "cls")
    live = saved(_live(tiled(bundles.select("bundle", "cls"), ["bundle"], "cls", TILE).join(signed, "cls"), num, den), "jac-live")
    whole = root_of.join(arrays(live, "jac-content"), "cls")
    links = saved(_within(tiled(live, ["bundle"], "cls", TILE).join(whole, "cls"), num, den), "jac-links")
    roots = components(stars.unionByName(links), "jac")

    classes = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("doc_id").alias("_least"))
    classes = classes.join(roots, F.col("cls") == F.col("node"), "left") \
        .select(F.col("cls").alias("_c"), "_least", F.coalesce("root", "cls").alias("root"))
    least = classes.groupBy(F.col("root").alias("_r")).agg(F.min("_least").alias("component_id"))
    classes = classes.join(least, F.col("root") == F.col("_r")).select("_c", "root", "component_id")
    return rows.join(classes, F.col("cls") == F.col("_c"), "left").select(
        "doc_id", "row_key", "n_shingles", "root", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """docs without all but one document of each group: the one with the smallest
    id (null last). Rows with the same id and text count as one document; texts
    without words are kept."""
    groups = saved(jaccard_groups(docs, id_col, text_col, **kw), "jac-groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    first = groups.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(order).alias("k")).select("k.row_key")
    rows = groups.groupBy("row_key", F.col("root").isNull().alias("empty")).agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(first.withColumn("kept", F.lit(True)), "row_key", "left") \
        .withColumn("kept", F.col("empty") | F.coalesce("kept", F.lit(False)))
    rows = saved(rows.select("row_key", "kept", (F.col("kept") & (F.col("n") == 1)).alias("plain")), "jac-rows")
    # Rows that go, or stay but are there more than once, pass the first filter. Of those, rows that
    # the second turns away go, as it holds every row that passed and stays; the few others are held
    # against the table.
    apart = KeyFilter(saved(rows.where(~F.col("plain")).select("row_key"), "jac-apart"), "row_key")
    unsure = KeyFilter(saved(rows.where(F.col("kept")).withColumn("hit", apart("row_key")).where("hit").select("row_key"),
                             "jac-unsure"), "row_key")
    key = row_key(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("row_key"))
    hit = named.withColumn("apart", apart("row_key")).withColumn("unsure", unsure("row_key"))
    once = hit.where(F.col("apart") & F.col("unsure")).dropDuplicates(["row_key"]) \
        .join(rows.where(~F.col("kept")).select("row_key"), "row_key", "left_anti")
    return hit.where(~F.col("apart")).select("row.*").unionByName(once.select("row.*"))
