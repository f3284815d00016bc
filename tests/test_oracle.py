"""Every registered query equals its DuckDB SQL twin on the small scale."""

import pytest

import __spark_entry__ as entry
from aerostream.plans.oracle import FLIGHTS_CTE
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF_SMALL)
    assert ok, msg


def test_every_query_has_an_oracle():
    from aerostream.plans.catalog import QUERIES

    assert set(QUERIES) <= set(entry.oracle_sql())


def test_means_and_percentages_against_avg_and_round(spark, con):
    """AVG in place of one division of an exact sum, ROUND in place of integer
    rounding: equal but for the last bits, and a hundredth where doubles miss a tie."""
    delay = 'CAST("actualDeparture" - "scheduledDeparture" AS DOUBLE) / 60000.0'
    plain = con.sql(f"""WITH {FLIGHTS_CTE}
      SELECT airline, ROUND(COUNT(*) FILTER (status = 'DELAYED') * 100.0 / NULLIF(COUNT(*), 0), 2) AS pct,
        AVG(CASE WHEN "actualDeparture" > "scheduledDeparture" THEN {delay} ELSE 0 END) AS mean
      FROM flights GROUP BY airline""").fetchall()
    got = {r.airline: r for r in entry.queries()["airline_performance"](spark, SF_SMALL).collect()}
    assert len(plain) == len(got)
    for airline, pct, mean in plain:
        assert got[airline].delay_percentage == pytest.approx(pct, abs=0.0101)
        assert got[airline].avg_delay_minutes == pytest.approx(mean, rel=1e-12)
    routes = con.sql(f"""WITH {FLIGHTS_CTE}
      SELECT origin || ' → ' || destination, AVG({delay}) FROM flights GROUP BY origin, destination""").fetchall()
    plain = dict(routes)
    for r in entry.queries()["busiest_routes"](spark, SF_SMALL).collect():
        assert r.avg_delay_minutes == pytest.approx(plain[r.route], rel=1e-12)


def test_every_mean_and_percentage_against_avg_and_round(con):
    """The oracle's exact forms against the plain functions, for every query that
    has one: the module's text with AVG and ROUND in place of them."""
    import inspect

    from aerostream.plans import oracle

    text = inspect.getsource(oracle)
    exact_pct = inspect.getsource(oracle.pct)
    exact_mean = inspect.getsource(oracle.mean)
    plain_pct = "def pct(n, m):\n    return f'ROUND(({n}) * 100.0 / NULLIF({m}, 0), 2)'\n"
    plain_mean = "def mean(x, scale=60000, count=None):\n    return f'AVG(CAST({x} AS DOUBLE) / {scale}.0)'\n"
    scope = {"__name__": "plain_oracle"}
    exec(text.replace(exact_pct, plain_pct).replace(exact_mean, plain_mean), scope)
    # the entry in seconds is made from the exact text by its constants
    changed = sorted(n for n, sql in oracle.SQL.items() if scope["SQL"][n] != sql and n != "delay_by_hour_seconds")
    assert len(changed) >= 15 and {"status_share", "airport_congestion", "delay_by_weekday", "hourly_flight_summary"} <= set(changed)
    for name in changed:
        a, b = con.sql(oracle.SQL[name]), con.sql(scope["SQL"][name])
        exact = {i for i, t in enumerate(a.types) if str(t) != "DOUBLE"}
        key = lambda r, exact=exact: repr([v for i, v in enumerate(r) if i in exact])
        rows, plain = sorted(a.fetchall(), key=key), sorted(b.fetchall(), key=key)
        assert len(rows) == len(plain) and rows, name
        for x, y in zip(rows, plain, strict=True):
            for i, (v, w) in enumerate(zip(x, y, strict=True)):
                assert v == w if i in exact or v is None else v == pytest.approx(float(w), abs=0.0101), (name, x, y)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "delay_percentage" in df.columns
