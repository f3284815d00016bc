"""Property and skew tests against brute-force models."""

import random
import re

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerostream.functions.text import java_split, split_lines
from aerostream.operators import state, views
from tests.fixtures import flights_df

_SEP = re.compile(r"[^A-Za-z0-9_]+")


def java_split_model(s: str) -> list[str]:
    """String.split("\\W+") on the lower-cased string (Java semantics)."""
    if s == "":
        return [""]
    parts = _SEP.split(s.lower())
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def readline_model(s: str) -> list[str]:
    out = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    if out and out[-1] == "":
        out.pop()
    return out


ALPHABET = st.sampled_from(list("aZ09_ .,!-\té\n\r"))


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=12), min_size=200, max_size=200))
def test_java_split_matches_model(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, v string")
    got = {r["i"]: list(r["t"]) for r in df.select("i", java_split(F.col("v")).alias("t")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == java_split_model(t), repr(t)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=12), min_size=200, max_size=200))
def test_split_lines_matches_readline(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, v string")
    got = {r["i"]: list(r["t"]) for r in df.select("i", split_lines(F.col("v")).alias("t")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == readline_model(t), repr(t)


def test_hot_flight_skew_matches_brute_force(spark):
    """One flight carries a third of all records; results equal a pandas model."""
    rng = random.Random(7)
    rows = []
    for seq in range(30000):
        hot = seq % 3 == 0
        fn = "HOT1" if hot else f"F{rng.randrange(500)}"
        origin = f"AP{rng.randrange(11)}"
        sched = 1_700_000_000_000 + rng.randrange(10**9)
        actual = None if rng.random() < 0.1 else sched + rng.randrange(-600_000, 7_200_000)
        status = rng.choice(["DELAYED", "ON_TIME", "CANCELLED", "SCHEDULED", "delayed"])
        rows.append((seq, fn, f"AL{rng.randrange(7)}", origin, "AP0", sched, actual, status))
    shuffled = rows[:]
    rng.shuffle(shuffled)  # arrival order must come from seq, not row order
    df = flights_df(spark, shuffled).repartition(6)
    pdf = pd.DataFrame(rows, columns=["seq", "flightNumber", "airline", "origin", "destination",
                                      "scheduledDeparture", "actualDeparture", "status"])
    last = pdf.sort_values("seq").groupby("flightNumber").tail(1)
    got = {r["flightNumber"]: r["seq"] for r in state.latest_flight(df, keep_order=True).collect()}
    assert got == dict(zip(last.flightNumber, last.seq))
    want = (last.assign(d=last.status.str.upper().eq("DELAYED").astype(int))
            .groupby("origin").d.sum().to_dict())
    got = {r["origin"]: r["delayed_count"] for r in state.delayed_by_origin(df).collect()}
    assert got == want
    perf = {r["airline"]: r for r in views.airline_performance(df).collect()}
    for airline, g in pdf.groupby("airline"):
        late = ((g.actualDeparture > g.scheduledDeparture) & g.actualDeparture.notna())
        total = int(((g.actualDeparture - g.scheduledDeparture).where(late, 0)).sum())
        assert perf[airline]["total_flights"] == len(g)
        assert perf[airline]["avg_delay_minutes"] == total / (len(g) * 60000)


def test_latest_by_key_has_one_rule_and_one_plan(spark):
    """Nulls in the order lose, ties go to the greater payload, however rows are dealt."""
    rows = [("k1", None, "only"), ("k2", 1, "a"), ("k2", None, "z"), ("k3", 5, "a"), ("k3", 5, "b"), (None, 2, "n")]
    df = spark.createDataFrame(rows, "k string, o long, v string")
    for parts in (1, 3, 7):
        got = {tuple(r) for r in state.latest_by_key(df.repartition(parts), "k", "o", ["v"]).collect()}
        assert got == {("k1", "only"), ("k2", "a"), ("k3", "b"), (None, "n")}
    plan = state.latest_by_key(df, "k", "o", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("Aggregate") >= 2 and plan.count("Exchange hashpartitioning") == 1


def test_integer_division_is_exact(spark):
    from aerostream.functions.flight import floor_div, trunc_div

    values = [9007199254740993000, -9007199254740993001, 1999, -1, 0, None]
    df = spark.createDataFrame([(v,) for v in values], "c long")
    got = df.select(trunc_div(df.c, 1000).alias("t"), floor_div(df.c, 1000).alias("f")).collect()
    assert [r.t for r in got] == [9007199254740993, -9007199254740993, 1, 0, 0, None]
    assert [r.f for r in got] == [9007199254740993, -9007199254740994, 1, -1, 0, None]


def test_newest_per_partition_keeps_what_can_still_be_newest(spark):
    from aerostream.operators.state import latest_by_key, newest_per_partition

    rows = [("HOT", "X", 1, 0, 9), ("HOT", "Y", 5, 0, 1), ("A", "Z", 2, 1, 1), ("HOT", "W", 3, 1, 4), ("A", "V", 9, 1, 0), (None, "N", 1, 0, 0)]
    df = spark.createDataFrame(rows, "k string, origin string, offset long, partition int, ms long").repartition(3)
    plain = {r.k: r.origin for r in newest_per_partition(df, "k", "offset", ["origin"]).collect()}
    assert plain == {"HOT": "Y", "A": "V", None: "N"}
    arrived = df.select("k", "origin", F.struct("partition", "offset", "ms").alias("seq"))
    kept = {(r.k, r.origin) for r in newest_per_partition(arrived, "k", "seq", ["origin"]).collect()}
    assert kept == {("HOT", "Y"), ("HOT", "W"), ("A", "V"), (None, "N")}
    last = {r.k: r.origin for r in latest_by_key(arrived, "k", "seq", ["origin"]).collect()}
    assert last == {"HOT": "W", "A": "V", None: "N"}
    assert newest_per_partition(arrived.limit(0), "k", "seq", ["origin"]).count() == 0
