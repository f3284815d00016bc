"""Streams: the same operators over a file-source stream equal the batch result."""

import json
import glob
import os

import pytest
from pyspark.sql import functions as F

from aerostream.operators import state, views, words
from aerostream.sinks import table as tbl
from aerostream.sources.files import flight_file_stream, text_file_stream
from aerostream.sources.tables import flights
from aerostream.streaming.retract import read_changes, read_delayed, retraction_sink
from aerostream.streaming.views import last_per_key, start_view
from tests.conftest import SF_SMALL
from tests.fixtures import RETRACTION_CASE, RETRACTION_STEPS

FIELDS = ["seq", "flightNumber", "airline", "origin", "destination", "scheduledDeparture", "actualDeparture", "status"]


def _write_json_batches(dirpath, batches):
    """One JSON-lines file per micro-batch, modification times in order."""
    os.makedirs(dirpath, exist_ok=True)
    for i, rows in enumerate(batches):
        p = os.path.join(dirpath, f"part-{i:05d}.json")
        with open(p, "w") as fh:
            for r in rows:
                fh.write(json.dumps(dict(zip(FIELDS, r))) + "\n")
        os.utime(p, (1_000_000 + i, 1_000_000 + i))


def _run(df, mode, workdir, name):
    seen = []

    def collect(batch, batch_id):
        seen.extend((batch_id, tuple(r)) for r in batch.collect())

    q = start_view(df, name, mode, sink=collect, checkpoint=os.path.join(workdir, "ck-" + name),
                   trigger={"availableNow": True})
    q.awaitTermination(300)
    return seen


def _kept_counts(spark, stream, workdir, name, every=16):
    """Counts after each batch, and now, of a retracting count over ``stream``."""
    target = os.path.join(workdir, name)
    q = start_view(stream, f"{name}-{os.path.basename(workdir)}", "append", sink=retraction_sink(target, every=every),
                   checkpoint=os.path.join(workdir, "ck-" + name), trigger={"availableNow": True})
    q.awaitTermination(300)
    now, steps = {}, {}
    changes = read_changes(spark, target).collect()
    for batch in sorted({r.batch for r in changes}):
        now |= {r.origin: r.delayed_count for r in changes if r.batch == batch}
        steps[batch] = dict(now)
    assert {r.origin: r.delayed_count for r in read_delayed(spark, target).collect()} == now
    return steps, target


@pytest.mark.parametrize("every", [2, 16])
def test_retraction_sequence(spark, workdir, every):
    src = os.path.join(workdir, "in")
    # two more records that change nothing: an old one, and one without a flight
    rows = [*RETRACTION_CASE, (2, "QX1", "QX", "RIX", "LIS", 1, 2, "DELAYED"), (9, None, "QX", "RIX", "LIS", 1, 2, "DELAYED")]
    _write_json_batches(src, [[r] for r in rows])
    stream = flight_file_stream(spark, src, max_files_per_trigger=1)
    steps, target = _kept_counts(spark, stream, workdir, "retract", every)
    assert len(glob.glob(os.path.join(workdir, "ck-retract", "commits", "[0-9]*"))) == len(rows)
    assert [steps[k] for k in sorted(steps)] == RETRACTION_STEPS
    want = {r.origin: r.delayed_count for r in read_delayed(spark, target).collect()}
    again = spark.createDataFrame([RETRACTION_CASE[3]], stream.schema)
    retraction_sink(target, every=every)(again, 3)  # delivered again
    assert {r.origin: r.delayed_count for r in read_delayed(spark, target).collect()} == want
    assert read_delayed(spark, os.path.join(workdir, "nothing")).count() == 0


def test_retraction_ignores_older_records(spark, workdir):
    src = os.path.join(workdir, "in")
    newer = (5, "QX1", "QX", "LAX", "JFK", 1, 2, "DELAYED")
    older = (3, "QX1", "QX", "SFO", "JFK", 1, 2, "DELAYED")
    _write_json_batches(src, [[newer], [older]])
    steps, _ = _kept_counts(spark, flight_file_stream(spark, src, max_files_per_trigger=1), workdir, "late")
    assert steps == {0: {"LAX": 1}}


def _derived_batches(spark, parts=4):
    rows = [tuple(r) for r in flights(spark, SF_SMALL).orderBy("seq").collect()]
    size = (len(rows) + parts - 1) // parts
    return rows, [rows[i:i + size] for i in range(0, len(rows), size)]


def _batch_of(spark, rows):
    from tests.fixtures import flights_df
    return flights_df(spark, rows)


def _final(seen, keys_idx):
    out = {}
    for _, row in sorted(seen, key=lambda x: x[0]):
        out[tuple(row[i] for i in keys_idx)] = row
    return sorted(out.values(), key=repr)


def test_views_stream_equals_batch(spark, workdir):
    rows, batches = _derived_batches(spark)
    src = os.path.join(workdir, "in")
    _write_json_batches(src, batches)
    batch_df = _batch_of(spark, rows)
    cases = {
        "airline_performance": (views.airline_performance, "update", [0]),
        "hourly_flight_summary": (views.hourly_flight_summary, "update", [0]),
        "airport_congestion": (views.airport_congestion, "update", [0]),
        "latest_flight": (state.latest_flight, "update", [0]),
    }
    for name, (fn, mode, key_idx) in cases.items():
        stream = flight_file_stream(spark, src, max_files_per_trigger=1)
        got = _final(_run(fn(stream), mode, workdir, name), key_idx)
        want = sorted((tuple(r) for r in fn(batch_df).collect()), key=repr)
        assert got == want, name
    for name, fn in {"delayed_flights": views.delayed_flights, "flight_alerts": views.flight_alerts}.items():
        stream = flight_file_stream(spark, src, max_files_per_trigger=1)
        got = sorted((r for _, r in _run(fn(stream), "append", workdir, name)), key=repr)
        want = sorted((tuple(r) for r in fn(batch_df).collect()), key=repr)
        assert got == want, name


def test_delayed_by_origin_stream_equals_batch(spark, workdir):
    rows, batches = _derived_batches(spark)
    src = os.path.join(workdir, "in")
    _write_json_batches(src, batches)
    steps, _ = _kept_counts(spark, flight_file_stream(spark, src, max_files_per_trigger=1), workdir, "dbo", every=2)
    want = {r["origin"]: r["delayed_count"] for r in state.delayed_by_origin(_batch_of(spark, rows)).collect()}
    final = steps[max(steps)]
    # the stream keeps origins that dropped to 0; the batch form has no row for them
    assert {k: v for k, v in final.items() if k in want} == want
    assert all(v == 0 for k, v in final.items() if k not in want)


def test_word_count_stream(spark, workdir):
    src = os.path.join(workdir, "txt")
    os.makedirs(src)
    for i, text in enumerate(["Hello Kafka Streams", "Kafka Streams"]):
        p = os.path.join(src, f"{i}.txt")
        with open(p, "w") as fh:
            fh.write(text + "\n")
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    seen = _run(words.word_count(text_file_stream(spark, src, 1)), "update", workdir, "wc")
    final = {}
    for _, (w, n) in sorted(seen, key=lambda x: x[0]):
        final[w] = n
    assert final == {"hello": 1, "kafka": 2, "streams": 2}


def test_upsert_sink_stream(spark, workdir):
    src = os.path.join(workdir, "in")
    _write_json_batches(src, [[r] for r in RETRACTION_CASE])
    target = os.path.join(workdir, "table")
    stream = flight_file_stream(spark, src, max_files_per_trigger=2)
    q = start_view(stream, "upsert", "append", sink=tbl.upsert_sink(target, "flightNumber", "seq"),
                   checkpoint=os.path.join(workdir, "ck-up"), trigger={"availableNow": True})
    q.awaitTermination(300)
    got = {r["flightNumber"]: (r["origin"], r["status"]) for r in tbl.read_keyed(spark, target, "flightNumber", "seq", stream.schema).collect()}
    assert got == {"QX1": ("VIE", "ON_TIME"), "QX2": ("OSL", "DELAYED")}
    hit = tbl.lookup(spark, target, "flightNumber", "QX2", "seq", stream.schema)
    assert [r["status"] for r in hit.collect()] == ["DELAYED"]
    assert tbl.lookup(spark, target, "flightNumber", "ZZ1", "seq", stream.schema).count() == 0
    assert "flightNumber" in hit._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]


def test_upsert_evolves_schema(spark, workdir):
    target = os.path.join(workdir, "t")
    a = spark.createDataFrame([("k1", 1, "x")], "k string, o long, v string")
    b = spark.createDataFrame([("k2", 2, "y", 7)], "k string, o long, v string, extra int")
    tbl.upsert(a, target, "k", "o", 0)
    tbl.upsert(b, target, "k", "o", 1)
    got = sorted(tuple(r) for r in tbl.read_keyed(spark, target, "k", "o", b.schema).select("k", "v", "extra").collect())
    assert got == [("k1", "x", None), ("k2", "y", 7)]


def test_keyed_table_before_its_first_row(spark, workdir):
    target = os.path.join(workdir, "t")
    none = spark.createDataFrame([], "k long, o long")
    assert tbl.read_keyed(spark, target, "k", "o", none.schema).count() == 0
    tbl.upsert(none, target, "k", "o", 0)
    assert tbl.lookup(spark, target, "k", 1, "o", none.schema).count() == 0
    tbl.upsert(spark.range(20).selectExpr("id AS k", "id AS o"), target, "k", "o", 1)
    tbl.upsert(none, target, "k", "o", 2)
    assert tbl.read_keyed(spark, target, "k", "o", none.schema).count() == 20
    assert all(tbl.lookup(spark, target, "k", k, "o", none.schema).count() == 1 for k in range(3))  # an int literal finds a bigint key


def test_replay_wins_over_older_generations(spark, workdir):
    target = os.path.join(workdir, "t")
    old = spark.createDataFrame([("SFO", 9), ("LAX", 4), (None, 1)], "origin string, n long")
    tbl.upsert_sink(target, "origin")(old, 5)
    tbl.upsert_sink(target, "origin", generation=1)(spark.createDataFrame([("SFO", 1)], old.schema), 0)
    schema = old.withColumn("_batch", F.lit(0).cast("long")).schema
    got = {r.origin: r.n for r in tbl.read_keyed(spark, target, "origin", "_batch", schema).collect()}
    assert got == {"SFO": 1, "LAX": 4, None: 1}  # the null key is a row like any other


def test_batch_touches_only_its_own_folder(spark, workdir):
    target = os.path.join(workdir, "t")
    tbl.upsert(spark.range(1000).selectExpr("id AS k", "id AS o"), target, "k", "o", 0)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{target}/**/*.parquet", recursive=True)}
    tbl.upsert(spark.range(3).selectExpr("id AS k", "id + 5000 AS o"), target, "k", "o", 1)
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{target}/**/*.parquet", recursive=True)}
    assert before.items() <= after.items()
    assert spark.read.parquet(f"{target}/gen=0/batch=1").count() == 3


def test_update_stream_survives_a_batch_without_groups(spark, workdir):
    """airport_congestion emits nothing while no airport has more than five flights."""
    from aerostream.operators import views
    from aerostream.plans.streams import run_update

    src = os.path.join(workdir, "in")
    rows = [(i, f"F{i}", "AL1", "AP1", "AP2", i, None, "DELAYED") for i in range(9)]
    _write_json_batches(src, [rows[:3], rows[3:]])
    out = run_update(views.airport_congestion(flight_file_stream(spark, src, max_files_per_trigger=1)), "congestion", "airport")
    assert [tuple(r)[:3] for r in out.collect()] == [("AP1", 9, 9)]


def test_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 5, 0)], "k string, v long, batch long")
    got = sorted(tuple(r) for r in last_per_key(df, ["k"], "batch").collect())
    assert got == [("a", 2), ("b", 5)]


def test_word_count_app_and_state_reader(spark, workdir):
    from aerostream.streaming.apps import read_state, state_lookup, word_count_query

    src = os.path.join(workdir, "txt")
    os.makedirs(src)
    for i, text in enumerate(["Hello Kafka Streams", "Kafka Streams"]):
        p = os.path.join(src, f"{i}.txt")
        with open(p, "w") as fh:
            fh.write(text + "\n")
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    ckpt = os.path.join(workdir, "ck-app")
    out = []
    q = start_view(word_count_query(text_file_stream(spark, src, 1)), "wc-app", "update",
                   sink=lambda b, i: out.extend((i, r["key"], bytes(r["value"])) for r in b.collect()),
                   checkpoint=ckpt, trigger={"availableNow": True})
    q.awaitTermination(300)
    last = {}
    for _, k, v in sorted(out):
        last[k] = int.from_bytes(v, "big", signed=True)
    assert last == {"hello": 1, "kafka": 2, "streams": 2}
    st = read_state(spark, ckpt)
    assert st.count() == 3
    row = state_lookup(st, "word", "kafka").first()
    assert row is not None and row["value"][0] == 2


def test_replay_rebuilds_target(spark, workdir):
    from aerostream.sinks.table import read_replayed, replay, replay_sink

    src = os.path.join(workdir, "in")
    _write_json_batches(src, [[r] for r in RETRACTION_CASE])
    target = os.path.join(workdir, "replayed")
    name = f"flights-{os.path.basename(workdir)}"  # generations live in the shared checkpoint folder
    for gen in (1, 2):  # a second generation replays from the start
        q = replay(lambda: flight_file_stream(spark, src, max_files_per_trigger=2), name, gen, target,
                   trigger={"availableNow": True})
        q.awaitTermination(300)
        assert read_replayed(spark, target, gen).count() == len(RETRACTION_CASE)
    batch = spark.createDataFrame(read_replayed(spark, target, 2).limit(2).collect())
    for _ in range(2):  # a batch delivered twice
        replay_sink(target, 3)(batch, 1)
    assert read_replayed(spark, target, 3).count() == 2


def test_flight_app_tables(spark, workdir):
    from aerostream.streaming.apps import start_flight_tables

    src, root = os.path.join(workdir, "in"), os.path.join(workdir, "tables")
    _write_json_batches(src, [[r] for r in RETRACTION_CASE])
    stream = flight_file_stream(spark, src, max_files_per_trigger=3)
    for q in start_flight_tables(stream, root, os.path.join(workdir, "ck"), trigger={"availableNow": True}).values():
        q.awaitTermination(300)
    now = tbl.read_keyed(spark, f"{root}/flights", "flightNumber", "seq", stream.schema).collect()
    assert {r.flightNumber: r.status for r in now} == {"QX1": "ON_TIME", "QX2": "DELAYED"}
    assert {r.origin: r.delayed_count for r in read_delayed(spark, f"{root}/delayed").collect()} == RETRACTION_STEPS[-1]


def test_hourly_summary_with_watermark_append(spark, workdir):
    rows, batches = _derived_batches(spark)
    src = os.path.join(workdir, "in")
    _write_json_batches(src, batches)
    stream = flight_file_stream(spark, src, max_files_per_trigger=1)
    seen = _run(views.hourly_flight_summary(stream, watermark="1 hour"), "append", workdir, "hourly-wm")
    emitted = [r for _, r in seen]
    want = {r[0]: tuple(r) for r in views.hourly_flight_summary(_batch_of(spark, rows)).collect()}
    assert emitted, "closed windows are emitted"
    assert len({r[0] for r in emitted}) == len(emitted)  # each window once
    for r in emitted:  # a window is emitted once the watermark passed it, with its final values
        assert want[r[0]] == r


def test_json_word_count_stream(spark, workdir):
    from aerostream.operators.words import word_count_json

    src = os.path.join(workdir, "json")
    os.makedirs(src)
    batches = [['{"message": "Hello Flink"}', "Hello Flink"], ['{"message": "Hello Kafka"}', "{}"],
               ['{"message": "Flink and Kafka"}']]
    for i, lines in enumerate(batches):
        p = os.path.join(src, f"{i}.txt")
        with open(p, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    seen = _run(word_count_json(text_file_stream(spark, src, 1)), "update", workdir, "wcj")
    final = {}
    for _, (w, n) in sorted(seen, key=lambda x: x[0]):
        final[w] = n
    assert final == {"hello": 2, "flink": 2, "kafka": 2, "and": 1}


def test_flight_log_stream_feeds_snapshot_analytics(spark, workdir):
    from aerostream.operators import analytics
    from aerostream.sources.layout import read_flight_log
    from aerostream.streaming.apps import start_flight_log

    rows, batches = _derived_batches(spark)
    src = os.path.join(workdir, "in")
    _write_json_batches(src, batches)
    path = os.path.join(workdir, "log")
    q = start_flight_log(flight_file_stream(spark, src, max_files_per_trigger=1), path,
                         name=f"log-{os.path.basename(workdir)}", checkpoint=os.path.join(workdir, "ck-log"),
                         trigger={"availableNow": True})
    q.awaitTermination(300)
    log = read_flight_log(spark, path)
    batch = _batch_of(spark, rows)
    for fn in (analytics.busiest_routes, analytics.status_share, analytics.delay_buckets):
        assert sorted(map(tuple, fn(log).collect())) == sorted(map(tuple, fn(batch).collect())), fn.__name__


def test_keyed_tables_idempotent_on_batch_retry(spark, workdir):
    rows = [("k1", 1, "a"), ("k2", 2, "b"), ("k1", 3, "c")]
    batch = spark.createDataFrame(rows, "k string, o long, v string")
    target = os.path.join(workdir, "t")
    for _ in range(2):  # the same micro-batch delivered twice
        tbl.upsert(batch, target, "k", "o", 7)
    assert spark.read.parquet(target).count() == 2
    assert sorted(tuple(r) for r in tbl.read_keyed(spark, target, "k", "o", batch.schema).collect()) == [("k1", 3, "c"), ("k2", 2, "b")]
