"""Fill-in-middle, vantage-point trees and Merkle proofs on small tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerostream.llm import fim, merkle, queries, vptree

# ------------------------------------------------------------------ fill in middle

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def ends(text):
    return [0] + [m.end() for m in UNIT.finditer(text)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abZ é\n𝄞<P>@[`{", max_size=60))
def test_every_cut_is_a_unit_end(text):
    s = fim.boundaries(text)
    assert [s.select(k) for k in range(len(s))] == ends(text)


@pytest.mark.parametrize("density,form", [(0.001, "array"), (0.5, "bitmap"), (0.0, "run"), (1.0, "run")])
def test_containers(density, form):
    members = np.random.default_rng(3).random(fim.CHUNK * 3 + 777) < density
    members[[0, fim.CHUNK, fim.CHUNK * 3 + 700]] = True
    s = fim.BoundarySet(members)
    want = np.flatnonzero(members)
    assert s.containers[0].form == (form if density else "array")
    assert len(s) == len(want) and 2 in s.upper or not density
    for k in {0, len(want) - 1, *np.random.default_rng(4).integers(0, len(want), 300).tolist()}:
        assert s.select(k) == want[k]


def test_runs_of_one_chunk():
    members = np.zeros(1000, bool)
    members[100:400] = members[900:] = True
    c = fim.Container(members)
    assert c.form == "run" and [c.select(k) for k in (0, 299, 300, 399)] == [100, 399, 900, 999]


def by_hand(ident, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if ident is None else ident}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    e = ends(text)
    n = len(e) - 1
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((e[h1 % (n + 1)], e[h2 % (n + 1)]))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_documents_and_back(spark):
    rng = random.Random(2)
    texts = ["", None, "<P", "x<S>y", "<", "S>", "é𝄞 a<", "word " * 60_000, "a" * 200_000, "1" * 70_000]
    texts += ["".join(rng.choice("ab <PSM>é\n") for _ in range(rng.randrange(30))) for _ in range(300)]
    rows = [(None if i == 7 else i // 2, t, "clash", i) for i, t in enumerate(texts)] + [(3, "same", "clash", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n long")
    out = fim.transformed(docs)
    got = out.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_hand(r.doc.doc_id, r.doc.text)
        assert r.back == (r.doc.text or "") and r.doc.form == "clash"
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.transformed(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ vantage-point trees

VECS = "vec_id long, embedding array<float>, label int, leaf long, bound double"


def vecs_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, 5, 1.0) for i, v in rows], VECS)


def brute_nearest(rows, k, asks):
    def ok(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)

    good = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if i is not None and ok(v)]
    out = set()
    for q, v in {(i, tuple(v)) for i, v in good if asks(i)}:
        near = []
        for i, w in good:
            if i != q and len(w) == len(v):
                s = 0.0
                for x, y in zip(w, v, strict=True):
                    s += (x - y) * (x - y)
                near.append((math.sqrt(s), i))
        out |= {(q, r, i, s) for r, (s, i) in enumerate(sorted(near)[:k], 1)}
    return out


def found(df):
    return {(r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()}


def clustered(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    v = (centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * 0.3).astype(np.float32)
    return [(i, [float(x) for x in row]) for i, row in enumerate(v)]


def test_nearest_is_exact(spark):
    rows = clustered(700, 8)
    same = rows[0][1]
    rows += [(1000 + i, same) for i in range(300)]  # copies, more than a shard
    rows += [(None, same), (2000, None), (2001, []), (2002, [0.0] * 8), (2003, [1.0, None] * 4), (2004, [float("nan")] * 8),
             (2100, [1.0, 2.0]), (2101, [1.0, 2.5]), (2102, [-1.0, 2.0]), (2200, [3.0] * 3), (100, rows[100][1]), (37, rows[36][1]),
             (2300, [1e30] * 8), (2301, [-3e38] * 8)]
    want = brute_nearest(rows, 5, lambda i: i % 100 == 0)
    df = vptree.nearest(vecs_of(spark, rows).repartition(5), F.col("vec_id") % 100 == 0, k=5, shard=64, queries=4)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    assert df.count() == len(want) and found(df) == want
    assert {q for q, *_ in want} >= {0, 100, 2100} and 2200 not in {q for q, *_ in want}


def test_nearest_of_little(spark):
    for rows in ([], [(100, [1.0])], [(100, None)], [(100, [1.0]), (1, [2.0]), (200, [2.0])], [(1, [1.0])]):
        got = found(vptree.nearest(vecs_of(spark, rows), F.col("vec_id") % 100 == 0))
        assert got == brute_nearest(rows, 10, lambda i: i % 100 == 0)


def test_factor(spark):
    with pytest.raises(ValueError):
        vptree.nearest(vecs_of(spark, []), F.lit(True), factor=0.5)
    rows = clustered(6000, 32)
    v = np.array([x for _, x in rows])
    ids, root = np.arange(len(v)), vptree.grow(v, vptree.BUCKET)
    asked = np.arange(0, len(v), 50)
    exact, seen = None, []
    for factor in (1.0, 1.5, 3.0):
        best = vptree.Best(10, asked, np.full(len(asked), np.inf))
        vptree.search(root, v, ids, v[asked], best, factor)
        exact = best.found if exact is None else exact
        seen.append((np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact, best.found, strict=True)]), best.measured))
    for i, q in enumerate(asked[:20]):
        d = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        assert set(np.argsort(d, kind="stable")[:10]) == set(exact[i])
    assert seen[0][0] == 1 and seen[1][0] >= 0.9
    assert seen[0][1] > seen[1][1] > seen[2][1]


# ------------------------------------------------------------------ Merkle proofs

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree long, idx string, digest binary, claimed string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_proofs(rows):
    """[(doc_id, leaf, subroot, root, proof, folded, verified)] by hand."""
    def leaf(r, text):
        return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r[0], r[3], r[2], r[4], text)])

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
        return out

    def low(t):
        return t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)

    groups = {}
    for r in rows:
        changed = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 3 == 0
        groups.setdefault(r[2], []).append((r[0], leaf(r, r[1]), leaf(r, low(r[1]) if changed else r[1])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(levels([x[1] for x in groups[g]]))
    over = levels([t[-1][0] for t in trees]) if trees else []
    out = []
    for at, (g, t) in enumerate(zip(order, trees, strict=True)):
        for i, (ident, own, claim) in enumerate(groups[g]):
            folded, beside = claim, []
            for place, tree in ((i, t), (at, over)):
                for level in tree[:-1]:
                    run = level[place // 8 * 8:place // 8 * 8 + 8]
                    beside += run[:place % 8] + run[place % 8 + 1:]
                    folded = h(*run[:place % 8], folded, *run[place % 8 + 1:])
                    place //= 8
            out.append((ident, own, t[-1][0], over[-1][0], h(*beside), folded, folded == over[-1][0]))
    return out


def proofs_of(spark, rows):
    docs = spark.createDataFrame([(*r, 7, "x", b"y", "z") for r in rows], DOCS).repartition(3)
    docs.createOrReplaceTempView("merkle_docs")
    changed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    text = F.when(changed, queries.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    m = merkle.build(docs, ["doc_id", "source", "lang", "n_chars", "text"], "doc_id", "lang", {"text": text})
    got = merkle.proofs(spark, m).collect()
    return sorted(((r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got), key=repr), m


def test_proofs(spark):
    rows = [(i, f"Text {i} É" if i % 5 else None, "en" if i % 3 else "fr", "S", i) for i in range(700)]
    rows += [(i, "ABC", f"l{i}", None, None) for i in range(800, 880)]  # more groups than one run
    rows += [(None, "A", None, "s", 1), (None, None, None, None, None), (5, "again", "en", "é", 2), (6, "Text 6 É", "en", "S", 6),
             (900, "X" * 100_000, "zz", "", 0), (901, "", "", "s", 0)]
    got, m = proofs_of(spark, rows)
    assert got == sorted(plain_proofs(rows), key=repr)
    assert 0 < sum(not r[-1] for r in got) < len(got)
    top = m.nodes.where("up_tree is null").collect()
    assert len(top) == 1 and top[0].digest.hex() == m.root
    # every other node's link names a node whose children hold its digest at that place
    up = {(r.tree, r.node): r for r in m.nodes.collect()}
    linked = [(r.digest, r.up_tree, r.up_node, r.pos) for r in [*up.values(), *m.leaves.collect()] if r.up_tree is not None]
    assert len(linked) == len(up) - 1 + len(rows)
    assert all(up[t, n].children[32 * p:32 * p + 32] == d for d, t, n, p in linked)


@pytest.mark.parametrize("n,langs", [(0, 1), (1, 1), (9, 1), (8, 8), (65, 1)])
def test_small_manifests(spark, n, langs):
    rows = [(i, f"T{i}", f"l{i % langs}", "s", 1) for i in range(n)]
    got, m = proofs_of(spark, rows)
    assert got == sorted(plain_proofs(rows), key=repr) and (m.root is None) == (n == 0)


def test_many_equal_rows(spark):
    rows = [(4, "Same", "en", "s", 4)] * 200 + [(9, "B", "en", "s", 4)]
    got, _ = proofs_of(spark, rows)
    assert got == sorted(plain_proofs(rows), key=repr)


def test_blocks_are_dealt_in_stretches(spark):
    df = spark.createDataFrame([(0, 1, 5, 9000), (1, 2, 3, 3)], "leaf_tree long, node long, first long, last long")
    got = sorted((r.node, r.block) for r in merkle._per_block(df).collect())
    assert got == [(1, b) for b in range(5, 9001)] + [(2, 3)]


def test_row_limit_is_put_back(spark):
    before = spark.conf.get(merkle.ROW_LIMIT)
    proofs_of(spark, [(1, "a", "en", "s", 1)])
    assert spark.conf.get(merkle.ROW_LIMIT) == before


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op12_nearest", "op13_merkle"])
def test_queries_have_sql(name):
    assert name in queries.QUERIES and name in queries.SQL
