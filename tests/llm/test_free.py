"""Personal data, packing, n-gram join, embeddings and language on small tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerostream.llm import langid, ngrams, packing, pii, vectors
from aerostream.llm.common import KeyFilter
from aerostream.llm.queries import tokenizer

DOCS = "doc_id long, text string, lang string, source string, n_chars long, cls long, row_key string"


def docs_of(spark, rows):
    """(id, text) or (id, text, lang) as documents with clashing extra columns."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 0, 1, "k") for r in rows], DOCS)


# ------------------------------------------------------------------ personal data

def brute_base(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 16 <= len(d) <= 19:
            s = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
            out += [("card", m.start(), m.end())] if s % 10 == 0 else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab1.2@-_ +(3)9é\n", max_size=40))
def test_base_spans(text):
    assert pii.base_spans(text) == brute_base(text)


@pytest.mark.parametrize("text", ["4111 1111 1111 1111", "x4012888888881881.", "1.2.3.4.5.6.7.8.9", "256.1.1.1", "0001.2.3.4", "a@b.c_d@e.f",
                                  "+1 (555) 123-4567 ", "a" * 200_000 + "@b.c", "1" * 100_000, "1." * 50_000, "@" * 1000, "+1" * 5000])
def test_base_spans_of_long_runs(text):
    got = pii.base_spans(text)
    if len(text) < 5000:
        assert got == brute_base(text)


def corpus(n=1600):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        d = "".join(rng.choice("0123456789") for _ in range(15))
        card = next(d + c for c in "0123456789" if pii.luhn(d + c))
        what = (f"mail bob{i}@mail{i % 9}.example.com", f"server {rng.randrange(256)}.{rng.randrange(256)}.0.{i % 256}",
                f"card {card}", f"call +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}")[i % 4]
        rows.append((i, f"words before {what} and words after {rng.randrange(10 ** 16, 10 ** 17)} end"))
    return rows


def test_trees_add_spans_and_leave_clean_texts(spark):
    model = pii.trained(docs_of(spark, corpus()))
    assert model is not None
    rows = [(1, "phone: 555 867 5309 now"), (2, "please mail: jane.doe42 (at) mail3 (dot) example (dot) com today"), (3, "on 2024-01-02 version 1.2.3, 12 apples"),
            (4, None), (5, ""), (6, "reach me at the house. Then go"), (7, "call +1 (555) 555-1234 or +1 (555) 555-1234"),
            (7, "call +1 (555) 555-1234 or +1 (555) 555-1234"), (None, "a@b.cd"), (8, "9 " * 60_000)]
    got = pii.found(docs_of(spark, rows), model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for r in got:
        base = pii.joined(brute_base(r.text or ""))
        p = r["_pii"]
        assert p.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(p.spans.split(","))
        assert p.n_phone == base.count("phone:") and p.n_email == base.count("email:")
    assert by[1]["_pii"].spans.startswith("phone:7:") and by[2]["_pii"].n_added == 1
    assert by[3]["_pii"].spans == by[6]["_pii"].spans == ""
    assert by[4]["_pii"].redacted is None and by[7]["_pii"].redacted == "call [PHONE] or [PHONE]"
    assert by[None]["_pii"].redacted == "[EMAIL]"


@pytest.mark.parametrize("text,spans", [
    ("tel 555 867 5309 555 867 5310", ["555 867 5309", "555 867 5310"]), ("on 2024-03-05 555-867-5309", ["555-867-5309"]),
    ("2024-03-05 14 555.867.5309", ["555.867.5309"]), ("7 (555) 867-5309 1", ["(555) 867-5309"]),
    ("555-867-5309 " * 9, ["555-867-5309"] * 9)])
def test_numbers_beside_others_are_proposed(text, spans):
    got, at = {c for c in pii.candidates(text) if c[0] == "phone"}, 0
    for s in spans:
        at = text.index(s, at)
        assert ("phone", at, at + len(s)) in got
        at += len(s)


def test_model_does_not_depend_on_file_splits(spark):
    docs = docs_of(spark, [*corpus(), (900, "call 555 867 5309 or " * 3000), *corpus()[:50]])
    a, b = (pii.trained(d, max_rows=900) for d in (docs.repartition(5), docs.coalesce(1)))
    assert a.thresholds == b.thresholds
    assert all(np.array_equal(x, y) for s, t in zip(a.trees, b.trees, strict=True) for x, y in zip(s, t, strict=True))


def test_every_text_and_row_is_learned_from(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassifier

    texts = [t for _, t in corpus(3000)] + ["".join(f"call 555 {i} 5309 or " for i in range(200, 999)), "write to jane (at) mail (dot) com", "", None]
    expected = {(*x, y) for t in texts if t for x, y in pii.training_rows(t)}
    assert len(expected) > 6000
    seen, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, frame: seen.extend(frame.collect()) or fit(self, frame))
    model = pii.trained(docs_of(spark, [*enumerate(texts), *enumerate(texts[:50])]), trees=3, depth=3)
    rows = [(*r.features, r.label) for r in seen]
    assert len(rows) == len(set(rows)) == len(expected) - len(expected) // 3 and set(rows) < expected
    rest = np.array(sorted(expected - set(rows)))
    for k, kind in enumerate(pii.KINDS):
        of = rest[rest[:, 0] == k]
        p = model.score(of[:, :-1])
        ok = [x for x in p if of[p >= x, -1].sum() / ((p >= x).sum() + 1) >= 0.95]
        assert model.thresholds[kind] == max(0.5, min(ok, default=2.0))


def test_every_base_span_is_learned_from():
    text = " and ".join(f"bob{i}@mail.example.com" for i in range(40))
    assert sum(y for _, y in pii.training_rows(text)) == 80  # each as it stands and loosened


def test_cards_beside_each_other_are_proposed():
    text = "4111/1111/1111/1111 4012.8888.8888.1881"
    assert {("card", 0, 19), ("card", 20, 39)} <= set(pii.candidates(text))
    assert len(pii.candidates("9 " * 60_000)) < 20 * 60_000


def test_numbers_beside_others_are_redacted(spark):
    model = pii.trained(docs_of(spark, corpus()))
    for text in ("tel 555 867 5309 555 867 5310 now", "phone: 2024-03-05 555-867-5309 now"):
        assert any(k == "phone" and text[a:b].endswith(("5309", "5310")) for k, a, b in pii.spans_of(text, model)[1]), text


def test_no_model_without_base_spans(spark):
    assert pii.trained(docs_of(spark, [(1, "nothing 12 here"), (2, None)])) is None
    assert pii.trained(docs_of(spark, [])) is None
    assert pii.found(docs_of(spark, []), None).count() == 0


def test_stretches():
    taken = pii.Taken([("a", 5, 9), ("b", 7, 12), ("a", 20, 30)])
    for s, e, meets in ((0, 5, False), (0, 6, True), (12, 20, False), (29, 40, True), (30, 40, False), (8, 8, True), (0, 99, True)):
        assert taken.meets(("x", s, e)) is meets


# ------------------------------------------------------------------ packing

@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer()["tokenizer_json"])
    return lambda s: [*t.encode(s or "", add_special_tokens=False).ids, 0]


def check_packed(rows, texts, encode, limit=1024, segments=256):
    """Every id in one piece, sequences gapless and within the limits."""
    want = sorted((i, tuple(encode(t))) for i, t in texts)
    docs, seqs = {}, {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append(r)
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        at = 0
        for r in s:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= limit and len(s) <= segments
    by_id = {}
    for i, ids in want:
        by_id.setdefault((i, len(ids)), []).append(ids)
    for r in rows:
        docs.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert set(docs) == set(by_id)
    for k, pieces in docs.items():
        copies = by_id[k]
        assert sum(p.length for p in pieces) == sum(map(len, copies))
        for p in pieces:
            assert any(zlib.crc32(np.array(c[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for c in copies)
    return [sum(r.length for r in s) for s in seqs.values()]


def test_packed(spark, encode):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeéñ <|>'\t\n0") for _ in range(rng.randint(1, 9)))
    texts = [(i, " ".join(word() for _ in range(rng.choice((1, 5, 200, 900))))) for i in range(120)]
    texts += [(500, None), (501, ""), (502, "x " * 20_000), (502, "x " * 20_000), (503, "<|endoftext|> 漢字 \x1c\x85"), (504, "a" * 5000)]
    rows = packing.packed(docs_of(spark, texts).coalesce(1), **tokenizer()).collect()
    full = check_packed(rows, texts, encode)
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in full)
    assert padding == 0
    plain = packing.packed(docs_of(spark, texts).coalesce(1), tokenizer()["tokenizer_json"]).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, plain))  # the faster library gives the same ids


def test_limits_on_segments_and_loss(spark, encode):
    texts = [(i, "some words " * (1 + i % 40)) for i in range(200)]
    df = docs_of(spark, texts).coalesce(1).withColumnRenamed("source", "prompt")
    rows = packing.packed(df, tokenizer()["tokenizer_json"], prompt_col="prompt", max_tokens=128, max_segments=5, max_loss=90).collect()
    loss, parts, tokens = {}, {}, {}
    for r in rows:
        loss[r.sequence_id] = loss.get(r.sequence_id, 0) + r.loss_tokens
        parts[r.sequence_id] = parts.get(r.sequence_id, 0) + 1
        tokens[r.sequence_id] = tokens.get(r.sequence_id, 0) + r.length
    assert max(loss.values()) <= 90 and max(parts.values()) <= 5 and max(tokens.values()) <= 128
    assert sum(tokens.values()) == sum(len(encode(t)) + 1 for _, t in texts)


def test_packed_nothing(spark):
    assert packing.packed(docs_of(spark, []), **tokenizer()).count() == 0


# ------------------------------------------------------------------ n-gram join

def brute_sets(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_groups(rows, n, num, den):
    sets = [brute_sets(t, n) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(root(i))) for i, r in enumerate(rows)), key=repr)


def family_rows(seed, n=6):
    """Families of texts with few to many edits, of all sizes, and odd cases."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 5)))
    rows = []
    for size in (1, 2, 3, 5, 9, 11, 20, 40, 90, 200, 450):
        for _ in range(n):
            base = [word() for _ in range(size)]
            for _ in range(rng.randint(1, 6)):
                t = list(base)
                for _ in range(rng.randint(0, max(1, size // 25))):
                    at = rng.randrange(len(t))
                    t[at:at + rng.randint(0, 1)] = [word()] * rng.randint(0, 2)
                rows.append((len(rows), rng.choice((" ", "\n", " \t")).join(t)))
    rows += [(9000, None), (9001, ""), (9002, " \n"), (9003, "Same TEXT here"), (9004, "same text  here"), (9003, "Same TEXT here"),
             (None, "same text here"), (None, "alone with a null id"), (9005, "long " * 3000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "num", "den"), [(3, 90, 100), (5, 80, 100)])
def test_jaccard_groups(spark, n, num, den):
    rows = family_rows(n)
    got = ngrams.jaccard_groups(docs_of(spark, rows).repartition(3), n=n, num=num, den=den).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_groups(rows, n, num, den)


def test_many_near_copies_in_small_tiles(spark, monkeypatch):
    """A large group is dealt into many tiles and still exactly linked."""
    monkeypatch.setattr(ngrams, "TILE", 8)
    monkeypatch.setattr(ngrams, "CHUNK", 400)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        t = list(base)
        for _ in range(rng.randint(0, 12)):
            t[rng.randrange(120)] = f"e{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(t)))
    got = ngrams.jaccard_groups(docs_of(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_groups(rows, 3, 90, 100)


def test_every_linked_pair_shares_a_key():
    rng = np.random.default_rng(1)
    for size in [*range(1, 60), 100, 333, 1000]:
        for num, den in ((90, 100), (80, 100)):
            for _ in range(6):
                a = rng.integers(0, 2 ** 64, size, dtype=np.uint64)
                out = rng.integers(0, size + 1)
                b = np.concatenate([a[out // 8:], rng.integers(0, 2 ** 64, rng.integers(0, size // 8 + 2), dtype=np.uint64)])
                a, b = np.unique(a), np.unique(b)
                if len(b) and ngrams.alike(a, b, num, den):
                    assert np.intersect1d(ngrams.tile_keys(a, num, den), ngrams.tile_keys(b, num, den)).size


def test_bitmap_bounds_difference():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2 ** 64, rng.integers(1, 300), dtype=np.uint64))
        b = np.unique(np.concatenate([a[::2], rng.integers(0, 2 ** 64, rng.integers(1, 300), dtype=np.uint64)]))
        x, y = ngrams.bitmap(a), ngrams.bitmap(b)
        words = min(len(x), len(y)) // 8
        differ = int(np.bitwise_count(ngrams.folded(x, words) ^ ngrams.folded(y, words)).sum())
        assert differ <= len(np.setxor1d(a, b))


def test_bound_lets_links_pass():
    rng = np.random.default_rng(3)
    links = 0
    for _ in range(300):
        a = np.unique(rng.integers(0, 2 ** 64, rng.integers(1, 400), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.integers(0, len(a) // 6 + 1):],
                                      rng.integers(0, 2 ** 64, rng.integers(0, len(a) // 6 + 1), dtype=np.uint64)]))
        if len(b) and ngrams.alike(a, b, 80, 100):
            links += 1
            assert ngrams.within_bound(len(a), ngrams.bitmap(a), len(b), ngrams.bitmap(b), 80, 100)
    assert links > 50
    a, b = (np.unique(rng.integers(0, 2 ** 64, 400, dtype=np.uint64)) for _ in range(2))
    assert not ngrams.within_bound(len(a), ngrams.bitmap(a), len(b), ngrams.bitmap(b), 80, 100)


def test_key_filter(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(5000)], "k string")
    f = KeyFilter(keys, "k")
    assert keys.where(f("k")).count() == 5000  # no key is turned away
    others = spark.range(50000).selectExpr("'x' || id AS k")
    assert others.where(f("k")).count() < 50000 * 0.03
    assert keys.where(KeyFilter(keys.where("false"), "k")("k")).count() == 0


@pytest.mark.parametrize("bits", [64, 4096, KeyFilter.MOST_BITS])
def test_groups_do_not_depend_on_the_filter(spark, monkeypatch, bits):
    """A full filter lets all rows through: the result is the same."""
    monkeypatch.setattr(KeyFilter, "MOST_BITS", bits)
    rows = family_rows(5)
    got = ngrams.jaccard_groups(docs_of(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_groups(rows, 3, 90, 100)


@pytest.mark.parametrize("bits", [64, 512, KeyFilter.MOST_BITS])
def test_one_of_each(spark, monkeypatch, bits):
    monkeypatch.setattr(KeyFilter, "MOST_BITS", bits)
    rows = family_rows(7, 3)
    rows += [rows[i] for i in range(0, len(rows), 5)]  # rows of one id and text count once
    docs = docs_of(spark, rows).withColumn("apart", F.lit("a")).withColumn("row", F.lit("b")).withColumn("kept", F.lit("c"))
    out = ngrams.one_of_each(docs, n=5, num=80)
    assert out.schema == docs.schema
    all_of = out.collect()
    assert {(r.apart, r.row, r.kept, r.row_key) for r in all_of} == {("a", "b", "c", "k")}
    got = [(r.doc_id, r.text) for r in all_of]
    groups = {(i, c) for i, _, c in brute_groups(rows, 5, 80, 100) if i is not None}
    kept_ids = {i for i, _ in got if i is not None}
    assert {i for i, c in groups if i == c and i < 9000} == {i for i in kept_ids if i < 9000}
    assert len(got) == len(set(got)) and (9003, "Same TEXT here") in got
    assert (None, "alone with a null id") in got and (None, "same text here") not in got


def test_ngram_join_of_nothing(spark):
    assert ngrams.jaccard_groups(docs_of(spark, [])).count() == 0
    assert ngrams.one_of_each(docs_of(spark, [(1, None)])).count() == 1


# ------------------------------------------------------------------ embeddings

EMB = "vec_id long, embedding array<float>, label int, cls long, copies long"


def test_embeddings(spark):
    rng = np.random.default_rng(4)
    rows = []
    for label in range(3):
        for _ in range(40):
            base = rng.normal(size=48)
            for _ in range(rng.integers(1, 5)):
                v = base + rng.normal(size=48) * 0.12
                rows.append((len(rows), (v * rng.uniform(0.1, 9)).astype(np.float32).tolist(), label))
    rows += [(len(rows) + i, rows[0][1], 0) for i in range(30)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 48, 0), (n + 2, [float("nan")] * 48, 0), (n + 3, [None] + [1.0] * 47, 0),
             (n + 4, rows[0][1], None), (n + 5, [1.0] * 5, 0), (n + 6, [1.0] * 5, 0), (n + 7, [], 0), (None, rows[0][1], 0)]
    got = vectors.near_duplicates(spark.createDataFrame([(*r, 1, 1) for r in rows], EMB)).collect()
    assert len(got) == len(rows)
    usable = [r for r in rows if r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links, up = {id(r): set() for r in rows}, {id(r): id(r) for r in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in usable:
        for b in usable:
            if a is not b and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    links[id(a)].add(id(b))
                    up[root(id(a))] = root(id(b))
    least = {}
    for r in rows:
        if r[0] is not None:
            least[root(id(r))] = min(least.get(root(id(r)), r[0]), r[0])
    want = sorted(((r[0], len(links[id(r)]), least.get(root(id(r))), r[0] == least.get(root(id(r)))) for r in rows), key=repr)
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=repr) == want


@pytest.mark.parametrize(("dim", "n"), [(64, 2000), (128, 2000), (256, 1000), (768, 400)])
def test_pairs_just_above_the_threshold_share_a_key(dim, n):
    rng = np.random.default_rng(1)
    a, z = rng.normal(size=(2, n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z -= (z * a).sum(1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    c = rng.uniform(0.93, 0.94, (n, 1))
    x, y = (vectors.keys_of(v, tables=vectors.tables_for(dim)) for v in (a, c * a + np.sqrt(1 - c * c) * z))
    found = (vectors.first_shared(x, y) < 2 ** 62).mean()
    print(f"recall {dim} {found}")
    assert found >= 0.99


def test_hot_key_is_dealt_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE", 16)
    rng = np.random.default_rng(9)
    base = rng.normal(size=32)
    rows = [(i, (base + rng.normal(size=32) * 0.1).astype(np.float32).tolist(), 1, 1, 1) for i in range(150)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, EMB)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(149, 0)}


def test_embeddings_of_nothing(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], EMB)).count() == 0


def test_hadamard():
    x = np.random.default_rng(0).normal(size=(3, 16)).astype(np.float32)
    h = np.array([[(-1) ** bin(i & j).count("1") for j in range(16)] for i in range(16)], np.float32)
    assert np.allclose(vectors.hadamard(x), x @ h, atol=1e-4)


# ------------------------------------------------------------------ language

def test_language(spark):
    rng = random.Random(1)
    parts = {"aa": ["the", "ing", "wh", "ou"], "bb": ["schn", "ung", "ei", "ö"], "cc": ["eau", "ré", "qui", "ç"]}
    text = lambda lang, n: " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    taught = [(i, text(lang, 40), lang) for i in range(40) for lang in parts] + [(999, "no label", None), (998, None, "aa")]
    profiles = langid.learn(docs_of(spark, taught))
    assert profiles.langs == ["aa", "bb", "cc"]
    rows = [(i, text(lang, 30), lang) for i in range(20) for lang in parts]
    odd = [(100, None, "aa"), (101, "", "aa"), (102, "123 !? ___ \U0001f600", "aa"), (103, "x" * 300_000, "aa"), (None, "a", None)]
    got = langid.identified(docs_of(spark, rows + odd), profiles).collect()
    assert [r.lang_pred == r.lang for r in got[:60]].count(True) >= 59
    assert [(r.lang_pred, r.score) for r in got[60:63]] == [("und", 0.0)] * 3
    assert all(r.lang_pred in parts and 0 <= r.score <= 1 for r in got[63:])


def test_out_of_place_distance():
    p = langid.Profiles({"a": np.array([10, 20, 30]), "b": np.array([30, 99])}, top=3)
    own = langid.top_grams(np.array([10, 20, 30, 40]), np.array([5, 9, 9, 1]), 3)
    assert own.tolist() == [20, 30, 10]
    off = {"a": abs(1 - 0) + abs(2 - 1) + abs(0 - 2), "b": 3 + abs(0 - 1) + 3}
    at = np.searchsorted(p.grams, own)
    place = p.place[:, at]
    assert np.where(place < 0, 3, np.abs(place - np.arange(3))).sum(axis=1).tolist() == [off["a"], off["b"]]


def test_profiles_do_not_depend_on_file_splits(spark):
    rows = [(i, " ".join(f"{w}{i * 7 % 13}{w}" for w in ("abc", "xyz") for _ in range(i % 5 + 1)) + f" q{i}", ("en", "fr")[i % 2]) for i in range(400)]
    docs = docs_of(spark, [*rows, *[(1000 + i, "copied text of many rows", "en") for i in range(300)]])
    a, b = (langid.learn(d, max_docs=60) for d in (docs.repartition(5), docs.coalesce(1)))
    assert a.langs == b.langs and np.array_equal(a.grams, b.grams) and np.array_equal(a.place, b.place)


def test_language_of_nothing(spark):
    profiles = langid.learn(docs_of(spark, []))
    assert langid.identified(docs_of(spark, [(1, "abc")]), profiles).collect()[0].lang_pred == "und"
    assert langid.identified(docs_of(spark, []), profiles).count() == 0


@pytest.mark.parametrize("text", ["½ ②", "Ⅷ 12", "__", "²³", "5", ""])
def test_no_letter_is_no_language(text):
    grams, _ = langid.gram_counts("the and of")
    profiles = langid.Profiles({"en": grams})
    assert profiles.predict(text) == (langid.UNKNOWN, 0.0) and profiles.predict("the ½ and")[0] == "en"


def test_predictions_by_hand(spark):
    """Against a plain out-of-place distance over dictionaries."""
    from collections import Counter

    def ranked(texts):
        total = Counter()
        for t in texts:
            words = re.findall(r"[^\W\d_]+", t.lower())
            for w in words:
                padded = f" {w} "
                total.update(w)
                total.update(padded[i:i + 2] for i in range(len(padded) - 1))
                total.update(padded[i:i + 3] for i in range(len(padded) - 2))
        pack = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))
        return [g for g, _ in sorted(total.items(), key=lambda x: (-x[1], pack(x[0])))][:langid.TOP]

    rng = random.Random(4)
    words = {"aa": ["stra", "dom", "vlk", "pes"], "bb": ["casa", "perro", "sol", "mar"], "cc": ["haus", "hund", "und", "der"]}
    text_of = lambda lang, n: " ".join(rng.choice(words[lang] + words["aa"][:2]) for _ in range(n))
    train = [(i, text_of(lang, 30), lang) for i, lang in enumerate(list(words) * 20)]
    profiles = langid.learn(docs_of(spark, train))
    plain = {lang: ranked([t for _, t, x in train if x == lang]) for lang in words}
    tests = [(i, text_of(rng.choice(list(words)), rng.randrange(1, 12))) for i in range(80)]
    got = {r.doc_id: r.lang_pred for r in langid.identified(docs_of(spark, tests), profiles).collect()}
    for i, t in tests:
        own = ranked([t])
        far = {lang: sum(min(langid.TOP, abs(p.index(g) - k)) if g in p else langid.TOP for k, g in enumerate(own)) for lang, p in plain.items()}
        assert got[i] == min(sorted(far), key=far.get), (t, far)
