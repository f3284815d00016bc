"""Maintained views: folded logs, distinct counts, top-k, totals, SQL streams, metrics."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from aerostream.operators import analytics, state, views
from aerostream.operators.state import newest_per_partition
from aerostream.schema import FLIGHT_NUMBER, SEQ
from aerostream.session import checkpoint_root
from aerostream.streaming import flightviews
from aerostream.streaming.log import FoldedLog
from aerostream.streaming.maintained import SumView, changed, current_sink, log_sink, read_current, read_view
from tests.fixtures import flights_df


def some_flights(n, seed=3):
    """Records of few flights that change airline, airports and status; some late, some null."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = rng.choice(["DELAYED", "ON_TIME", "CANCELLED", "SCHEDULED"])
        at = 1_700_000_000_000 + rng.randrange(10 ** 7)
        left = None if rng.random() < 0.2 else at + rng.choice([-60_000, 0, 60_000, 20 * 60_000, 90 * 60_000, 4 * 3600_000])
        rows.append((i, f"F{rng.randrange(25)}", rng.choice(["A", "B", "C", None]), rng.choice(["X", "Y", "Z", None]),
                     rng.choice(["X", "Y"]), at, left, s))
    return rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def batches_of(rows, k):
    size = -(-len(rows) // k)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def batch_reports(f):
    return {
        "routes": analytics.busiest_routes(f, min_flights=1, limit=None), "buckets": analytics.delay_buckets(f),
        "shares": analytics.status_share(f),
        "worst": views.delayed_flights(f, keep_seq=True).orderBy(F.desc("delay_minutes"), F.desc(SEQ)).limit(20).drop(SEQ),
        "recent": f.orderBy(F.desc("scheduledDeparture"), F.desc(SEQ)).limit(10).drop(SEQ)}


def kept_reports(spark, path):
    return {
        "routes": flightviews.busiest_routes(spark, path, min_flights=1, limit=None), "buckets": flightviews.delay_buckets(spark, path),
        "shares": flightviews.status_share(spark, path), "worst": flightviews.worst_delays(spark, path),
        "recent": flightviews.recent_flights(spark, path)}


def test_reports_equal_the_batch_operators_after_each_batch(spark, workdir):
    rows, done = some_flights(160), []
    sink = log_sink(workdir, flightviews.report_views(), every=2)
    for b, part in enumerate(batches_of(rows, 4)):
        done += part
        for _ in range(2 if b == 2 else 1):  # one batch is delivered twice, after a fold
            sink(flights_df(spark, part), b)
        if b in (1, 3):
            want, got = batch_reports(flights_df(spark, done)), kept_reports(spark, workdir)
            for name in want:
                assert rows_of(got[name]) == rows_of(want[name]), (b, name)
    sink(flights_df(spark, rows[:5]), 0)  # folded long ago
    assert rows_of(flightviews.status_share(spark, workdir)) == rows_of(analytics.status_share(flights_df(spark, rows)))


def test_reports_over_newest_records_take_old_ones_back(spark, workdir):
    rows, done = some_flights(200, seed=8), []
    random.Random(1).shuffle(rows)  # records come out of order
    kept = {n: v for n, v in flightviews.report_views().items() if n in ("routes", "buckets")}
    sink = current_sink(workdir, kept, FLIGHT_NUMBER, SEQ, every=2)
    lowered, before = False, {}
    for b, part in enumerate(batches_of(rows, 4)):
        done += part
        for _ in range(2 if b == 2 else 1):
            sink(flights_df(spark, part), b)
        newest = state.latest_flight(flights_df(spark, done), keep_order=True)
        got = rows_of(flightviews.busiest_routes(spark, workdir, min_flights=1, limit=None))
        assert got == rows_of(analytics.busiest_routes(newest, min_flights=1, limit=None)), b
        now = {r[0]: r[2] for r in got}
        lowered |= any(now.get(k, 0) < n for k, n in before.items())
        before = now
    assert lowered, "no distinct count ever fell"
    assert rows_of(flightviews.delay_buckets(spark, workdir)) == rows_of(analytics.delay_buckets(newest))
    got = read_current(spark, workdir, FLIGHT_NUMBER, SEQ)
    assert rows_of(got) == rows_of(newest.select(*got.columns))


def test_a_value_counts_until_its_last_row_is_gone(spark, workdir):
    kept = {"n": SumView({"origin": F.col("origin")}, {}, ("airlines", F.col("airline")))}
    sink = current_sink(workdir, kept, FLIGHT_NUMBER, SEQ)

    def now():
        return {r.origin: r.airlines for r in read_view(spark, workdir, kept, "n").collect()}

    steps = [([(1, "F1", "A", "X", "Y", 1, 2, "S"), (2, "F2", "A", "X", "Y", 1, 2, "S"), (3, "F3", "B", "X", "Y", 1, 2, "S")], {"X": 2}),
             ([(4, "F1", "B", "X", "Y", 1, 2, "S")], {"X": 2}), ([(5, "F2", "B", "X", "Y", 1, 2, "S")], {"X": 1}),
             ([(6, "F3", None, "X", "Y", 1, 2, "S"), (7, "F1", "B", "Z", "Y", 1, 2, "S")], {"X": 1, "Z": 1}),
             ([(8, "F2", "C", "Z", "Y", 1, 2, "S")], {"X": 0, "Z": 2}), ([(1, "F2", "A", "X", "Y", 1, 2, "S")], {"X": 0, "Z": 2})]
    for b, (rows, want) in enumerate(steps):
        sink(flights_df(spark, rows), b)
        assert now() == want, b


# ------------------------------------------------------------------- folds

def summed(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def a_log(path, every=3, **kw):
    from pyspark.sql import types as T

    return FoldedLog(path, T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())]), summed, every, **kw)


def test_fold_reads_base_and_later_batches(spark, workdir):
    log = a_log(workdir)
    for b in range(8):
        assert log.begin(spark, b)
        log.write(spark.createDataFrame([("a", 1), (f"k{b}", b)], "k string, n long"), b)
    assert log.epoch(spark) == 6
    files = log.rows(spark).inputFiles()
    assert files and all("/bases/gen=0/epoch=6/" in f or "/epoch=6/batch=" in f for f in files)
    assert {r.k: r.n for r in log.current(spark).collect()} == {"a": 8, **{f"k{b}": b for b in range(8)}}
    assert log.rows(spark, before=6).count() == 7  # the base alone
    assert log.history(spark).count() == 16
    plan = log.rows(spark, before=7)._jdf.queryExecution().executedPlan().toString()
    assert "bases/gen=0/epoch=6" in plan and "PartitionFilters" in plan and "epoch=3" not in plan
    assert not log.begin(spark, 5)  # folded long ago


def test_a_fold_cut_short_is_harmless(spark, workdir):
    log = a_log(workdir, every=100)
    for b in range(3):
        log.write(spark.createDataFrame([("a", 1)], "k string, n long"), b)
    # the base is written, the head is not: as if the driver died in between
    spark.createDataFrame([("a", 77)], "k string, n long").write.parquet(f"{workdir}/bases/gen=0/epoch=3")
    assert log.epoch(spark) == 0 and [r.n for r in log.current(spark).collect()] == [3]
    log.fold_before(spark, 3)  # the next attempt
    assert log.epoch(spark) == 3 and [r.n for r in log.current(spark).collect()] == [3]
    log.fold_before(spark, 3)  # and once more
    log.write(spark.createDataFrame([("a", 1)], "k string, n long"), 3)
    assert [r.n for r in log.current(spark).collect()] == [4]


def test_generations_are_apart(spark, workdir):
    one, two = a_log(workdir), a_log(workdir, generation=1)
    one.write(spark.createDataFrame([("a", 1)], "k string, n long"), 0)
    assert two.rows(spark).count() == 0 and two.epoch(spark) == 0 and one.rows(spark).count() == 1


def test_changes_stay_in_the_jvm_and_reduce_before_the_shuffle(spark):
    batch = flights_df(spark, some_flights(50))
    moves = changed(batch, batch.where("seq < 20"), FLIGHT_NUMBER, SEQ)
    plan = moves._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert "partial_max" in newest_per_partition(batch, FLIGHT_NUMBER, SEQ, ["status"])._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------- entries

def commits(spark, name):
    """Committed batches of the newest run of an entry."""
    root = checkpoint_root(spark).removeprefix("file://")
    runs = sorted(glob.glob(f"{root}/catalogue/{name}/*/ckpt"), key=os.path.getmtime)
    return len(glob.glob(f"{runs[-1]}/commits/[0-9]*"))


@pytest.mark.parametrize("entry,name", [
    ("airline_performance_stream", "airline_performance"), ("word_count_stream", "word_count"), ("flight_status_sink_stream", "flight_status_sink"),
    ("delayed_flights_stream", "delayed_flights"), ("delayed_by_origin_stream", "delayed_by_origin"), ("sql_flight_alerts_stream", "sql_flight_alerts")])
def test_entries_run_several_batches(spark, entry, name):
    from aerostream.plans.streams import STEPS, STREAM_QUERIES
    from tests.conftest import SF_SMALL

    STREAM_QUERIES[entry](spark, SF_SMALL).count()
    assert commits(spark, name) >= STEPS


def test_sql_needs_a_stream(spark, workdir):
    from aerostream.streaming import sql as streamsql

    with pytest.raises(ValueError):
        streamsql.stream_view(spark.range(3), "not_a_stream")
    with pytest.raises(ValueError):
        streamsql.start_sql(spark, "x", "SELECT 1 AS one", workdir, workdir)
    assert not spark.catalog.tableExists("not_a_stream")


def test_view_metrics_count_a_batch_once(spark):
    from aerostream.plans.streams import view_metrics
    from tests.conftest import SF_SMALL

    rows = view_metrics(spark, SF_SMALL).orderBy("batch").collect()
    # were the batch run twice, rows in and state rows would be counted twice
    assert [(r.batch, r.rows_in, r.rows_changed, r.state_rows) for r in rows] == [(b, 250, 7, 7) for b in range(4)]


# ------------------------------------------------------------------- windows that close, tables that grow

def test_windows_close_and_late_rows_are_kept(spark, workdir):
    from aerostream.schema import SEQUENCED_FLIGHT_SCHEMA
    from aerostream.streaming.windows import ClosingWindows

    w = ClosingWindows(workdir, SEQUENCED_FLIGHT_SCHEMA, "scheduledDeparture", 10, 5, (("seqs", "seq"),), every=2)
    row = lambda i, t: (i, f"F{i}", "A", "X", "Y", t, None, "S")
    batches = [[row(1, 3), row(2, 12), row(3, None)], [row(4, 9), row(5, 26)], [row(6, 19), row(7, 20), row(8, 8)], [row(9, 21), row(10, -4)], []]
    for b, rows in enumerate(batches):
        for _ in range(2 if b == 3 else 1):  # delivered twice, after a fold
            w.sink()(flights_df(spark, rows), b)
        if b == 1:
            assert {(r.window_start_ms, r.closed, r["_rows"], int(r.seqs)) for r in w.read(spark).collect()} \
                == {(0, True, 2, 5), (10, True, 1, 2), (20, False, 1, 5)}
    got = {(r.window_start_ms, r.closed, r["_rows"], int(r.seqs)) for r in w.read(spark).collect()}
    # the watermark of the third batch is 21: windows up to 20 had ended
    assert got == {(0, True, 2, 5), (10, True, 1, 2), (20, False, 3, 21)}
    late = {(r.seq, r.batch) for r in w.read_late(spark).collect()}
    assert late == {(6, 2), (8, 2), (10, 3)}
    assert sum(n for *_, n, _ in got) + len(late) == 9  # all rows with a time
    w.sink()(flights_df(spark, [row(99, 3)]), 0)  # folded long ago
    assert w.read_late(spark).count() == 3


def test_a_table_keeps_its_growing_schema(spark, workdir):
    from aerostream.sinks.table import append_evolving, merged_schema, read_evolving, stored_schema

    assert stored_schema(spark, workdir).names == []
    for b, (rows, ddl) in enumerate([([(1, "a")], "k int, v string"), ([(2, "b", 1.5)], "k int, v string, x float"),
                                     ([(2 ** 40, 2.5)], "k bigint, x double"), ([(4,)], "k int")]):
        for _ in range(2):  # each batch is delivered twice
            append_evolving(spark.createDataFrame(rows, ddl), workdir, b)
    out = read_evolving(spark, workdir)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [("k", "bigint"), ("v", "string"), ("x", "double")]
    assert rows_of(out) == sorted([(1, "a", None), (2, "b", 1.5), (2 ** 40, None, 2.5), (4, None, None)], key=repr)
    assert len(glob.glob(f"{workdir}/schemas/batch=*")) == 3  # only changes are stored
    with pytest.raises(ValueError, match="holds bigint, not string"):
        append_evolving(spark.createDataFrame([("x",)], "k string"), workdir, 4)
    assert read_evolving(spark, workdir).count() == 4
    with pytest.raises(ValueError):
        merged_schema(out.schema, spark.createDataFrame([], "x bigint").schema)
