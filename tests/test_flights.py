"""Keyed latest table, retracting count, lookups and edge rows (batch form)."""

from aerostream.operators import analytics, recent, sinktable, state, views
from aerostream.sources.files import delimited_lines, placeholder_flights
from tests.fixtures import LATEST_CASE, RETRACTION_CASE, RETRACTION_STEPS, flights_df


def test_latest_per_flight(spark):
    latest = {r["flightNumber"]: r for r in state.latest_flight(flights_df(spark, LATEST_CASE)).collect()}
    assert latest["QX1"]["status"] == "DELAYED" and latest["QX1"]["actualDeparture"] == 5900
    assert latest["QX2"]["status"] == "SCHEDULED" and latest["QX2"]["actualDeparture"] is None


def test_latest_is_arrival_order_not_event_time(spark):
    rows = [(0, "X1", "A", "SFO", "JFK", 9000, None, "DELAYED"), (1, "X1", "A", "SFO", "JFK", 1000, None, "ON_TIME")]
    got = state.latest_flight(flights_df(spark, rows)).collect()
    assert got[0]["status"] == "ON_TIME"


def test_retraction_prefixes(spark):
    for i, expected in enumerate(RETRACTION_STEPS):
        df = flights_df(spark, RETRACTION_CASE[: i + 1])
        got = {r["origin"]: r["delayed_count"] for r in state.delayed_by_origin(df).collect()}
        # batch form: an origin without a current flight has no row
        assert got == {o: n for o, n in expected.items() if n or o in got}, (i, got)


def test_origin_change_moves_count(spark):
    rows = [(0, "QX1", "QX", "SFO", "JFK", 1, 2, "DELAYED"), (1, "QX1", "QX", "LAX", "JFK", 1, 2, "DELAYED")]
    got = {r["origin"]: r["delayed_count"] for r in state.delayed_by_origin(flights_df(spark, rows)).collect()}
    assert got == {"LAX": 1}  # batch form: origins with no current flight disappear


def test_lowercase_status_counts(spark):
    rows = [(0, "QX1", "QX", "SFO", "JFK", 1, 2, "delayed")]
    got = state.delayed_by_origin(flights_df(spark, rows)).collect()
    assert got[0]["delayed_count"] == 1


def test_null_key_dropped(spark):
    rows = [(0, None, "AA", "SFO", "JFK", 1, 2, "DELAYED"), (1, "B1", "BB", "SFO", "JFK", 1, 2, "ON_TIME")]
    assert state.latest_flight(flights_df(spark, rows)).count() == 1


def test_lookups(spark):
    f = flights_df(spark, RETRACTION_CASE)
    latest = state.latest_flight(f)
    assert state.get_flight(latest, "QX1").first()["status"] == "ON_TIME"
    assert state.get_flight(latest, "ZZ999").count() == 0
    delayed = state.delayed_by_origin(f, latest)
    assert tuple(state.get_delayed(delayed, "OSL").first()) == ("OSL", 1)
    assert tuple(state.get_delayed(delayed, "XXX").first()) == ("XXX", 0)
    rows = [tuple(r) for r in state.all_delayed(delayed).collect()]
    assert rows == [("OSL", 1, "warn"), ("VIE", 0, "good")]


def test_boundaries(spark):
    rows = [
        (0, "E1", "A", "SFO", "JFK", 1_000_000, 1_000_000 + 900_000, "DELAYED"),   # exactly 15 min: not in R-1
        (1, "E2", "A", "SFO", "JFK", 1_000_000, 1_000_000 + 900_001, "DELAYED"),
        (2, "E3", "A", "SFO", "JFK", 1_000_000, 1_000_000 - 60_000, "ON_TIME"),    # early
        (3, "E4", "A", "SFO", "JFK", 1_000_000, 1_000_000 + 3_600_001, "CANCELLED"),
    ]
    f = flights_df(spark, rows)
    assert sorted(r["flightNumber"] for r in views.delayed_flights(f).collect()) == ["E2", "E4"]
    assert [r["flightNumber"] for r in views.flight_alerts(f).collect()] == ["E4"]
    perf = views.airline_performance(f).first()
    # early departure counts as 0 late minutes; mean over all 4 rows
    assert perf["avg_delay_minutes"] == (900_000 + 900_001 + 3_600_001) / (4 * 60000)
    assert perf["delay_percentage"] == 50.0
    t = {r["flightNumber"]: r for r in recent.enriched_flights(f, as_of_ms=2_000_000).collect()}
    assert t["E3"]["departure_status"] == "ON_TIME" and t["E3"]["delay_minutes"] == 0
    assert t["E4"]["departure_status"] == "CANCELLED" and t["E4"]["delay_minutes"] == 60
    by_airline = analytics.delay_by_airline(f).first()
    assert by_airline["avg_delay_minutes"] == (900_000 + 900_001 - 60_000 + 3_600_001) / (4 * 60000)


def test_percent_rounding_is_exact_half_up(spark):
    # 5657 / 20000 * 100 = 28.285 exactly -> 28.29 (a double round would give 28.28)
    rows = [(i, f"F{i}", "A", "SFO", "JFK", 1, 2, "DELAYED" if i < 5657 else "ON_TIME") for i in range(20000)]
    got = views.airline_performance(flights_df(spark, rows)).first()["delay_percentage"]
    assert got == 28.29


def test_sink_table_format_and_reads(spark):
    f = flights_df(spark, RETRACTION_CASE + [(7, "DD1", "DD", "SEA", "SFO", 1_700_000_000_123, 1_700_000_061_999, "DELAYED")])
    t = sinktable.flight_status_table(f, keep_seq=True)
    rows = {r["flight_number"]: r for r in t.collect()}
    assert rows["DD1"]["scheduled_departure_time"] == "2023-11-14 22:13:20"
    assert rows["DD1"]["actual_departure_time"] == "2023-11-14 22:14:21"
    assert rows["QX1"]["status"] == "ON_TIME"
    assert [r["flight_number"] for r in sinktable.recent(t, 2).collect()] == ["DD1", "QX2"]
    assert sinktable.table_count(t).first()[0] == 3


def test_placeholder_runs_every_query(spark):
    empty = placeholder_flights(spark)
    assert views.airline_performance(empty).count() == 0
    assert analytics.flight_count(empty).first()[0] == 0
    assert state.delayed_by_origin(empty).count() == 0


def test_delimited_lines_skip_header(spark, workdir):
    p = f"{workdir}/movies.csv"
    with open(p, "w") as fh:
        fh.write('title,year\n"Heat, the movie",1995\nAlien,1979\n')
    got = [r[0] for r in delimited_lines(spark, p).collect()]
    assert got == ['"Heat, the movie",1995', "Alien,1979"]


def test_sql_over_registered_views(spark):
    from aerostream.operators.catalog import adhoc_sql, drop_view, register_catalogue_views, save_table
    from aerostream.sources.files import table_exists
    from aerostream.sources.tables import flights
    from tests.conftest import SF_SMALL

    f = flights(spark, SF_SMALL)
    names = register_catalogue_views(spark, f)
    assert table_exists(spark, "airline_performance") and "flights_latest" in names
    save_table(spark.range(3), "dropped_table")
    for name in ("dropped_table", "never_there"):
        drop_view(spark, name)
        assert not table_exists(spark, name)
    worst = adhoc_sql(spark, "SELECT * FROM delayed_flights ORDER BY delay_minutes DESC LIMIT 20")
    assert worst.count() == 20
    top = adhoc_sql(spark, "SELECT * FROM airline_performance ORDER BY delay_percentage DESC").collect()
    assert [r["delay_percentage"] for r in top] == sorted((r["delay_percentage"] for r in top), reverse=True)
    n = adhoc_sql(spark, "SELECT count(*) AS n FROM flights").first()["n"]
    assert n == f.count()
    assert adhoc_sql(spark, "SELECT * FROM hourly_flight_summary ORDER BY window_start DESC LIMIT 24").count() == 24


def test_size_shuffle_partitions(spark):
    from aerostream.session import size_shuffle_partitions
    from aerostream.sources.tables import read_table
    from tests.conftest import SF_SMALL

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        docs = read_table(spark, SF_SMALL, "documents")
        n = size_shuffle_partitions(spark, docs, bytes_per_partition=1 << 16)
        assert n > spark.sparkContext.defaultParallelism  # ~290 KB input / 64 KB
        assert size_shuffle_partitions(spark, docs) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_flight_log_layout_prunes_dates(spark, workdir):
    from aerostream.sources.layout import read_flight_log, write_flight_log
    from aerostream.sources.tables import TEST_AS_OF_MS, flights
    from tests.conftest import SF_MID

    f = flights(spark, SF_MID)
    path = f"{workdir}/log"
    write_flight_log(f, path)
    log = read_flight_log(spark, path)
    for fn, kw in ((recent.recent_cancelled, {}), (recent.enriched_flights, {})):
        a = sorted(map(tuple, fn(f, as_of_ms=TEST_AS_OF_MS, **kw).collect()))
        b = sorted(map(tuple, fn(log, as_of_ms=TEST_AS_OF_MS, **kw).collect()))
        assert a == b and a
        plan = fn(log, as_of_ms=TEST_AS_OF_MS)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(dep_date" in plan and "dep_date#" in plan
    # every other query is unaffected by the extra column
    assert views.airline_performance(log).count() == views.airline_performance(f).count()


def test_hot_date_and_flight_are_written_by_many_tasks(spark, workdir):
    from aerostream.sources.layout import read_flight_log, write_flight_log

    rows = [(i, "HOT" if i % 2 else f"F{i}", "AL1", "AP1", "AP2", 1706572800000 + i, None, "DELAYED") for i in range(4000)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else so few rows are put together again
    try:
        write_flight_log(flights_df(spark, rows).repartition(4), f"{workdir}/hot")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    hot = read_flight_log(spark, f"{workdir}/hot").where("flightNumber = 'HOT'").select("_metadata.file_name").distinct().count()
    assert hot >= 2


def test_lookup_flight_filters_before_latest(spark, workdir):
    from aerostream.sources.layout import read_flight_log, write_flight_log
    from aerostream.sources.tables import flights
    from tests.conftest import SF_SMALL

    f = flights(spark, SF_SMALL)
    write_flight_log(f, f"{workdir}/log")
    log = read_flight_log(spark, f"{workdir}/log").drop("dep_date")
    got = [tuple(r) for r in state.lookup_flight(log, "FL1").collect()]
    want = [tuple(r) for r in state.get_flight(state.latest_flight(f), "FL1").collect()]
    assert got == want and len(got) == 1
    plan = state.lookup_flight(log, "FL1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(flightNumber,FL1)" in plan


def test_airport_comparison_by_hand(spark):
    from aerostream.sources.tables import flights
    from tests.conftest import SF_SMALL

    f = flights(spark, SF_SMALL)
    by = {}
    for r in f.where("actualDeparture is not null").collect():
        for place, role in ((r.origin, 0), (r.destination, 1)):
            by.setdefault(place, ([], []))[role].append((r.actualDeparture - r.scheduledDeparture) / 60000)
    got = {r.airport: r for r in analytics.airport_comparison(f, limit=None).collect()}
    assert set(got) == {k for k, v in by.items() if len(v[0]) + len(v[1]) >= 10}
    for k, r in got.items():
        out, arr = (sum(x) / len(x) if x else None for x in by[k])
        both = [x for x in (out, arr) if x is not None]
        assert r.total_flights == len(by[k][0]) + len(by[k][1])
        assert abs(r.overall_avg_delay - sum(both) / len(both)) < 1e-6


def test_catalogue_lists_tables_and_streams(spark, workdir):
    from aerostream.operators.catalog import catalogue
    from aerostream.streaming.views import start_view

    name = f"listed_{workdir.rsplit('-', 1)[-1]}"
    spark.range(3).selectExpr("id", "CAST(id AS string) AS text").createOrReplaceTempView(name)
    q = start_view(spark.readStream.format("rate").load(), name + "_q", "append", "memory", checkpoint=f"{workdir}/ck")
    try:
        rows = {(r.name, r.kind, r.column, r.type, r.place) for r in catalogue(spark).collect()}
    finally:
        q.stop()
    assert {(name, "view", "id", "bigint", 0), (name, "view", "text", "string", 1), (name + "_q", "stream", None, None, None)} <= rows
    spark.catalog.dropTempView(name)


def test_time_relative_default_now(spark):
    import datetime

    now_ms = int(datetime.datetime.now(datetime.timezone.utc).timestamp() * 1000)
    rows = [(0, "N1", "AL", "SFO", "JFK", now_ms - 60_000, None, "CANCELLED"),      # 1 min ago
            (1, "N2", "AL", "SFO", "JFK", now_ms - 7_200_000, None, "CANCELLED"),   # 2 h ago
            (2, "N3", "AL", "SFO", "JFK", now_ms - 30 * 86_400_000, None, "ON_TIME")]
    f = flights_df(spark, rows)
    got = recent.recent_cancelled(f).collect()
    assert [(r["airline"], r["origin"], r["total_canceled_flights"]) for r in got] == [("AL", "SFO", 1)]
    assert got[0]["calculation_time"] is not None
    assert sorted(r["flightNumber"] for r in recent.enriched_flights(f).collect()) == ["N1", "N2"]


def test_normalise_and_status_severity(spark):
    from pyspark.sql import functions as F

    from aerostream.functions.flight import status_severity
    from aerostream.sources.tables import normalise

    rows = [(0, None, "AA", "SFO", "JFK", 1000, None, "delayed"), (1, "X1", "AA", "SFO", "JFK", 3_600_000, 5, "on_time")]
    out = normalise(flights_df(spark, rows), add_ts=True).collect()
    assert len(out) == 1 and out[0]["status"] == "ON_TIME" and str(out[0]["scheduled_ts"]) == "1970-01-01 01:00:00"
    sev = spark.createDataFrame([("DELAYED",), ("ON_TIME",), ("BOARDING",)], "s string")
    assert [r[0] for r in sev.select(status_severity(F.col("s"))).collect()] == ["bad", "good", "neutral"]
