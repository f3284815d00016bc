"""Archives, mixing, fingerprints, url filter and chat formatting on small tables."""

import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostream.llm import chat, fingerprint, mixing, urlfilter, warc
from aerostream.llm.common import components, running, scratch

PAGES = "page_id long, url string, html string, extra string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, key string"


def docs_of(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, 0, -1, "x") for i, t, s in rows], DOCS)


# ------------------------------------------------------------------ archives

TRICKY = "a\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\nfiledesc://x 1 2 3 4\n\nhttp://u 0.0.0.0 20240101000000 text/html 5\n" * 3


def archived(spark, rows, version):
    arcs, warcs = scratch(spark, "arc"), scratch(spark, "warc")
    warc.write_arc(spark.createDataFrame(rows, PAGES).coalesce(1), arcs, version=version)
    warc.write_warc(warc.to_warc(warc.read_arc(spark, arcs)), warcs)
    return arcs, warc.read_warc(spark, warcs).collect()


@pytest.mark.parametrize("version", [1, 2])
def test_archives_round_trip(spark, version):
    same = "x" * 200
    rows = [(5, "http://a/ b", same, None), (3, None, same, None), (9, "http://c", same, None), (4, "http://d", "short", None),
            (6, "http://e", "short", None), (7, "http://f", None, None), (8, "http://g", TRICKY, None),
            (10, "http://h", "é\r\n" * 60 + "\r\n", None), (None, "-", same, None), (3, "http://again", same, None),
            (11, "http://long", "y\n" * 300_000, None)]
    arcs, got = archived(spark, rows, version)
    read = {(r.ref, r.target_uri): r for r in got if r.record_type in ("response", "revisit")}
    assert len(read) == len(rows)
    by_id = {}
    for r in read.values():
        by_id.setdefault(r.ref, []).append(r)
    for ident, _, html, _ in rows:
        for r in by_id[ident]:
            body = (html or "").encode()
            assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
            copies = [i for i, _, h, _ in rows if h == html and len(body) >= 100]
            first = min((i for i in copies if i is not None), default=None)
            again = first is not None and (ident is None or ident > first)
            assert (r.record_type, r.refers_to) == (("revisit", first) if again else ("response", None))
    assert sum(r.record_type == "warcinfo" for r in got) == 1
    assert len({r.record_id for r in got}) == len(got)
    heads = {r.kind: r.version for r in warc.read_arc(spark, arcs).collect()}
    assert heads == {"filedesc": version, "http": version}


@pytest.mark.parametrize("version", [1, 2])
def test_pages_named_like_a_file_description(spark, version):
    rows = [(1, "filedesc://page", "x" * 200, None), (2, "http://a", "x" * 200, None), (3, "filedesc://part-00000.arc", "1 0 y", None)]
    _, got = archived(spark, rows, version)
    read = {r.ref: (r.record_type, r.target_uri, r.refers_to) for r in got if r.record_type != "warcinfo"}
    assert read == {1: ("response", "filedesc://page", None), 2: ("revisit", "http://a", 1),
                    3: ("response", "filedesc://part-00000.arc", None)}
    assert len(got) == len(rows) + 1


def test_arc_header_lines_by_version():
    one = [b"filedesc://a 0.0.0.0 20240101000000 text/plain 5", b"1 0 x", b"",
           b"dns:host 1.2.3.4 20240101000000 text/dns 2", b"ab", b"", b"broken line", b"ftp://x y 1.2.3.4 20240101000000 text/plain 0", b""]
    got = list(warc.arc_records(iter(one)))
    assert [r[0] for r in got] == ["filedesc", "other", "damaged", "other"]
    assert (got[3][2], got[3][8]) == ("ftp://x y", b"")
    two = [b"filedesc://a 0.0.0.0 20240101000000 text/plain 200 - - 0 a 5", b"2 0 x", b"",
           b"http://h 1.2.3.4 20240101000000 text/html 200 - - 99 a 3", b"abc"]
    assert [(r[0], r[1], r[8]) for r in warc.arc_records(iter(two))] == [("filedesc", 2, b"2 0 x"), ("other", 2, b"abc")]


def test_archives_of_nothing(spark):
    arcs, got = archived(spark, [], 1)
    assert [r.record_type for r in got] in ([], ["warcinfo"])


# ------------------------------------------------------------------ mixing

def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, left, out = 1.5 * sum(sizes.values()), set(names), {}
    while left:
        unit = total / sum(weight[s] for s in left)
        over = {s for s in left if unit * weight[s] > 2 * sizes[s]}
        for s in over or left:
            out[s] = 2.0 * sizes[s] if over else unit * weight[s]
            total -= out[s] if over else 0
        left = left - over if over else set()
    return out


def test_mix(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 50)), (None, "a", "b", "é")[min(i % 7, 3)]) for i in range(300)]
    rows += [(1000, None, "a"), (1001, "  \t", None), (None, "one two", "a"), (None, "one two", "a"), (1002, "w " * 900, "tiny")]
    got = mixing.mix(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    taken = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in want:
        assert taken[s] == math.floor(want[s] + 0.5)
    again = mixing.mix(docs_of(spark, rows[::-1])).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_schedule_is_balanced_and_texts_follow(spark):
    rows = [(i, " ".join(f"{i}_{k}" for k in range(40)), "abc"[i % 3]) for i in range(90)]
    plan, _, sources = mixing.schedule(docs_of(spark, rows))
    share = {r.idx: r.take for r in sources.collect()}
    by_slot = sorted((r.slot, r.idx, r.words) for r in plan.select("slot", "idx", "words").collect())
    half = by_slot[:len(by_slot) // 2]
    for idx, take in share.items():
        part = sum(w for _, i, w in half if i == idx) / sum(w for _, _, w in half)
        assert abs(part - take / sum(share.values())) < 0.05
    out = mixing.mixed(docs_of(spark, rows)).collect()
    assert out and set(out[0].asDict()) == {c.split()[0] for c in DOCS.split(", ")}
    full = {i: t for i, t, _ in rows}
    assert all(full[r.doc_id].startswith(r.text) for r in out)
    assert sum(len(r.text.split()) for r in out) == sum(share.values())


def test_mix_of_nothing(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0
    assert mixing.mix(docs_of(spark, [(1, None, "a")])).collect()[0].taken == 0
    assert mixing.mixed(docs_of(spark, [])).count() == 0


def test_running_sums(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.expr("id div 50").alias("c"), "id", F.lit(2).alias("v"))
    got = {r.id: r.s for r in running(df, "g", "c", ["id"], "v", "s").collect()}
    assert got == {i: 2 * (i // 3) for i in range(500)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200}


def test_components_of_a_long_chain(spark):
    """Chains of thousands of links settle, whatever the order of their ids."""
    ids = list(range(5000))
    random.Random(9).shuffle(ids)
    got = components(spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "a long, b long"), "chain").collect()
    assert sorted((r.node, r.root) for r in got) == [(i, 0) for i in range(5000)]


# ------------------------------------------------------------------ fingerprints

def brute_sketch(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
    h = [hashlib.md5(" ".join(words[i:i + 5]).encode()).hexdigest()[:15] for i in range(max(1, len(words) - 4))] if words else []
    kept = [x for x in h if x < "2"] or ([min(h)] if h else [])
    return sorted(int(x, 16) for x in set(kept))


def test_fingerprints(spark):
    texts = ["", None, "One", "one two three four five six " * 30, "ÀB c d e f g h " * 40, "x y z " * 2000, "ONE", "one"]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "null id one", "s"), (None, "null id two", "s"), (3, texts[3], "s")]
    got = fingerprint.edited_fingerprints(docs_of(spark, rows)).collect()
    order = sorted(((i is None, i, hashlib.sha256((t or "").encode()).hexdigest(), t or "") for i, t, _ in rows),
                   key=lambda x: (x[0], x[1] or 0, x[2]))
    want = []
    for at, (_, i, _, t) in enumerate(order):
        nxt = order[(at + 1) % len(order)][3]
        edited = t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), brute_sketch(t), brute_sketch(edited), brute_sketch(nxt)))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)


def test_fingerprints_of_few(spark):
    assert fingerprint.edited_fingerprints(docs_of(spark, [])).count() == 0
    (r,) = fingerprint.edited_fingerprints(docs_of(spark, [(1, "a b c d e f g h", "s")])).collect()
    assert r.sketch == r.next_sketch


def test_frequent_ids_are_dealt_to_many_stretches(spark):
    rows = spark.range(4000).select(F.when(F.col("id") < 1500, 7).when(F.col("id") < 3000, None).otherwise(F.col("id")).alias("doc_id"),
                                    F.sha2(F.col("id").cast("string"), 256).alias("sha"))
    cells = fingerprint.in_order(rows, "doc_id", "sha", 20).groupBy("cell").count().collect()
    assert max(r["count"] for r in cells) < 500
    spans = fingerprint.in_order(rows, "doc_id", "sha", 20).orderBy(F.col("doc_id").asc_nulls_last(), "sha").collect()
    assert [r.cell for r in spans] == sorted(r.cell for r in spans)


# ------------------------------------------------------------------ url filter

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fit = [(r, v) for v, r in RULES for h, _, p in [r.partition("/")]
           if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return (host, path, *max(fit, key=lambda x: len(x[0]), default=(None, None)))


def test_rules_and_parts(spark):
    urls = [None, "", "no scheme", "http://A.Example.COM/en/x?y#z", "https://www.example.com/en/", "http://m.www.example.com/en/q",
            "http://x.net/es/1", "http://net/fr/", "http://xnet/fr/", "ftp://com", "http://com/", "http://a.com?x=/en/", "http://É.com/É",
            "x://y://z/en/", "http://x.org/en#a", "http://x.net/\n/es/", "http://example.com/EN/"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, "http://a.com/"), (3, urls[3])]
    got = urlfilter.judged(spark.createDataFrame(rows, "page_id long, url string"), RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = brute_rule(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert verdict is None or r.verdict == verdict
        assert r.verdict in ("allow", "block")


def test_language_model_ratio(spark):
    """Scores equal a plain model with the same counts, and tell the classes apart."""
    good = [(f"http://a{i}.com/garden/rose-{i}", True) for i in range(60)]
    bad = [(f"http://b{i}.com/casino/win{i}$$", False) for i in range(60)]
    table = urlfilter.model(spark.createDataFrame(good + bad, "url string, good boolean"))
    urls = ["http://z.com/garden/tulip", "http://z.com/casino/lot", "", None, "é" * 50]
    got = [r.score for r in urlfilter.scored(spark.createDataFrame([(u,) for u in urls], "url string"), table).collect()]
    n = {True: {}, False: {}}
    for u, y in good + bad:
        for i in range(len(u)):
            for k in range(urlfilter.ORDER + 1):
                ctx = tuple(u[j] if j >= 0 else None for j in range(i - k, i))
                for key in ((k, ctx, u[i]), (k, ctx)):
                    n[y][key] = n[y].get(key, 0) + 1

    def score(u):
        if not u:
            return 0.0
        total = 0.0
        for i in range(len(u)):
            p = {True: 1 / urlfilter.ALPHABET, False: 1 / urlfilter.ALPHABET}
            for k in range(urlfilter.ORDER + 1):
                ctx = tuple(u[j] if j >= 0 else None for j in range(i - k, i))
                for y in p:
                    p[y] = (n[y].get((k, ctx, u[i]), 0) + urlfilter.BETA * p[y]) / (n[y].get((k, ctx), 0) + urlfilter.BETA)
            total += math.log(p[True]) - math.log(p[False])
        return total / len(u)

    for u, s in zip(urls, got, strict=True):
        assert abs(s - score(u)) < 0.15, u  # counts share 2**BITS cells
    assert got[0] > 0.2 and got[1] < -0.2 and got[2] == got[3] == 0.0


def test_counts_are_exact_for_many_urls(spark):
    """Hundreds of thousands of distinct contexts do not mix: unseen ones fall back."""
    rng = random.Random(21)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789-_") for _ in range(n))
    labelled = [(f"http://{word(60)}", i % 2 == 0) for i in range(4000)]
    urls = [f"http://{word(40)}" for _ in range(20)]
    table = urlfilter.model(spark.createDataFrame(labelled, "url string, good boolean"))
    got = {r.url: r.score for r in urlfilter.scored(spark.createDataFrame([(u,) for u in urls], "url string"), table).collect()}
    n = {True: {}, False: {}}
    for u, y in labelled:
        for i in range(len(u)):
            for k in range(urlfilter.ORDER + 1):
                ctx = tuple(u[j] if j >= 0 else None for j in range(i - k, i))
                for key in ((k, ctx, u[i]), (k, ctx)):
                    n[y][key] = n[y].get(key, 0) + 1
    for u in urls:
        total = 0.0
        for i in range(len(u)):
            p = {True: 1 / urlfilter.ALPHABET, False: 1 / urlfilter.ALPHABET}
            for k in range(urlfilter.ORDER + 1):
                ctx = tuple(u[j] if j >= 0 else None for j in range(i - k, i))
                for y in p:
                    p[y] = (n[y].get((k, ctx, u[i]), 0) + urlfilter.BETA * p[y]) / (n[y].get((k, ctx), 0) + urlfilter.BETA)
            total += math.log(p[True]) - math.log(p[False])
        assert got[u] == pytest.approx(total / len(u), abs=1e-9)


def test_url_filter_of_nothing(spark):
    assert urlfilter.judged(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0


# ------------------------------------------------------------------ chat

def test_layouts(spark):
    turns = [("system", "s"), ("user", "u"), ("assistant", "a")]
    records = [json.dumps(x) for x in (
        {"prompt": "u", "completion": "a"}, {"output": "a", "instruction": "s", "input": "u"},
        {"messages": [{"role": r, "content": t} for r, t in turns]},
        {"conversations": [{"value": t, "from": {"user": "human", "assistant": "gpt"}.get(r, r)} for r, t in turns]},
        {"something": 1}, {"messages": "text"})] + ["{damaged", None]
    got = chat.canonical(spark.createDataFrame([(r,) for r in records], "record string")).collect()
    assert [r.layout for r in got] == ["completion", "instruction", "messages", "share"] + ["unknown"] * 4
    assert [[tuple(t) for t in r.turns] if r.turns else None for r in got] == [turns[1:], turns, turns, turns] + [None] * 4


@pytest.mark.parametrize("text", ["", None, "<|im_end|>", "<\\|im_end|>", "<\\\\|", "<", "a<", "|x", "\\", "$1 \\1", "é\n\r\t\u2028", "<|" * 500,
                                  "\U0001f600<|im_start|>assistant<|im_sep|>ok"])
def test_template_round_trip(spark, text):
    rows = [(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "to<|ol\n", text), (1, 3, "assistant", "end"),
            (1, None, None, text), (None, 0, "assistant", "null conversation")]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.read_back(chat.formatted(chat.canonical(chat.as_records(chat.grouped(t)))))
    got = {r.conv_id: r for r in out.collect()}
    want = [("", text or ""), ("user", text or ""), ("assistant", text or ""), ("to<|ol\n", text or ""), ("assistant", "end")]
    assert [tuple(x) for x in got[1].turns_read] == want
    assert got[1].loss_text == (text or "") + "end"
    assert got[1].formatted.count("<|im_start|>") == 5
    assert got[None].loss_text == "null conversation"


def test_conversations_of_any_length(spark):
    """Offsets and masks go over stretches of turns; 30,000 turns are read in about linear time."""
    sizes = [1, 2, 3, 4, 5, 8, 9, 10, 17, 100, 30_000]
    t = spark.createDataFrame([(n, i, ("user", "assistant")[i * 7 % 5 % 2], f"<|{i}\U0001f600" + "x" * (i % 11)) for n in sizes for i in range(n)],
                              "conv_id long, turn long, role string, text string").repartition(4)
    out = chat.read_back(chat.formatted(chat.canonical(chat.as_records(chat.grouped(t)))))
    got = {r.conv_id: r for r in out.collect()}
    for n in sizes:
        turns = [(("user", "assistant")[i * 7 % 5 % 2], f"<|{i}\U0001f600" + "x" * (i % 11)) for i in range(n)]
        assert [tuple(x) for x in got[n].turns_read] == turns
        assert got[n].loss_text == "".join(x for r, x in turns if r == "assistant")
        assert [got[n].formatted[a:a + m] for a, m in got[n].loss_spans] == [x.replace("<|", "<\\|") for r, x in turns if r == "assistant"]


def test_a_record_of_no_known_layout_is_not_formatted(spark):
    out = chat.read_back(chat.formatted(chat.canonical(spark.createDataFrame([('{"a": 1}',), ('{"messages": []}',)], "record string"))))
    assert [(r.formatted, r.loss_spans) for r in out.collect()] == [(None, None)] * 2


def test_schema_is_stable(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = chat.formatted(chat.canonical(chat.as_records(chat.grouped(empty))))
    assert out.count() == 0 and isinstance(out.schema["loss_spans"].dataType, T.ArrayType)


def test_a_tiny_source_leaves_the_schedule_as_it_is(spark):
    rows = [(i, "word " * 900, f"s{i % 3}") for i in range(60)]
    plain = mixing.schedule(docs_of(spark, rows))[0]
    more = mixing.schedule(docs_of(spark, [*rows, (99, "one", "tiny")]))[0]
    a, b = plain.select("slot").distinct().count(), more.select("slot").distinct().count()
    assert abs(a - b) <= 0.01 * a
    taken = {r.doc_id: (r.taken, r.target) for r in mixing.mix(docs_of(spark, [*rows, (99, "one", "tiny")])).collect()}
    assert taken[99][0] == round(taken[99][1]) and sum(t for t, _ in taken.values()) == pytest.approx(1.5 * 54001, abs=4)


def test_windows_of_urls_by_hand(spark):
    from collections import Counter

    urls = ["a", "ab", "abcd", "abcde", "http://x/é\n𝄞𝄞y\r\nz", "𝄞" * 9, "", "x" * 300_000 + "end"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "id long, url string")
    got = {r.id: Counter() for r in df.collect()}
    for r in urlfilter._windows(df, "id").groupBy("id", "w").count().collect():
        got[r.id][r.w] = r["count"]
    for i, u in enumerate(urls):
        assert got[i] == Counter(u[max(0, k - 4):k + 1] for k in range(len(u))), u[:20]
