"""The corpus pipeline, stage by stage, against brute force."""

import re

import corpus_pipeline
from aerostream.llm import pii
from aerostream.llm.common import saved
from tests.conftest import SF_SMALL
from tests.llm.test_free import brute_groups, encode  # noqa: F401


def test_stages(spark, encode):  # noqa: F811
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(900001, None, None, None, None), (900002, "", "en", "src0", 0), (900003, "12 34 !!", "en", None, 8),
                                 (None, "the and that with from this words here", "en", "src1", 38)], docs.schema)
    docs, at = docs.unionByName(odd), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, saved(stage(spark, docs, SF_SMALL), name)
        at[name] = (before.collect(), docs.collect())
        assert name == "sequences" or docs.columns == before.columns
    was, now = at["language"]
    gone = {r.doc_id for r in was} - {r.doc_id for r in now}
    assert {900001, 900002, 900003} <= gone and len(gone) <= 5
    was, now = at["near_duplicates"]
    groups = brute_groups([(r.doc_id, r.text) for r in was], 5, 80, 100)
    assert sorted(r.doc_id for r in now if r.doc_id is not None) == sorted({c for i, _, c in groups if c is not None})
    was, now = at["personal_data"]
    assert len(was) == len(now) and not any(pii.base_spans(r.text) for r in now)
    clean = {r.doc_id: r.text for r in was if not re.search(r"[0-9@]", r.text)}
    assert all(clean[r.doc_id] == r.text for r in now if r.doc_id in clean)
    was, now = at["mixture"]
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)
    assert abs(words(now) - 1.5 * words(was)) <= 40
    was, now = at["sequences"]
    assert sum(r.length for r in now) == sum(len(encode(r.text)) for r in was)


def test_run_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_of_any_name_pass_through(spark):
    import corpus_pipeline as cp

    extra = ["score", "lang_pred", "_apart", "_size", "_row_key", "_pii", "_key", "_rest", "key", "row_key", "taken", "a.b"]
    rows = [(i, f"the quick brown fox number {i} jumps over the lazy dog " * 3 + f"call +1 (555) 555-{1000 + i}", "en", f"s{i % 2}", 0, *[f"{c}{i}" for c in extra])
            for i in range(12)]
    rows += [(90, rows[3][1], "en", "s1", 0, *[None] * len(extra)), (91, None, None, None, None, *["x"] * len(extra))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra)
    docs = spark.createDataFrame(rows, schema)
    for name, stage in cp.STAGES[:-1]:
        out = cp.saved(stage(spark, docs, ""), f"extra-{name}")
        assert out.columns == docs.columns, name
        for r in out.collect():
            if r.doc_id < 90:
                assert [r[c] for c in extra] == [f"{c}{r.doc_id}" for c in extra], name
        docs = out
    assert docs.count() > 0
