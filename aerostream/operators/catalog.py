"""Snapshot, export, ad-hoc SQL and catalogue helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostream.schema import SEQ


def snapshot(flights: DataFrame, limit: int = 100, order: str = SEQ) -> DataFrame:
    """The first ``limit`` records of the stream (earliest offsets first)."""
    return flights.orderBy(F.asc(order)).limit(limit)


def sample(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows (no order guaranteed) — a peek at a table."""
    return df.limit(n)


def export_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """CREATE TABLE ... AS SELECT (managed table in the session catalog)."""
    df.write.mode(mode).saveAsTable(name)


def adhoc_sql(spark: SparkSession, sql: str) -> DataFrame:
    """Run SQL text against the registered views (``flights``, ``lines``, ...)."""
    return spark.sql(sql)


def register_catalogue_views(spark: SparkSession, flights: DataFrame, lines: DataFrame | None = None) -> list[str]:
    """Register the maintained views as temp views for SQL users: ``flights``,
    ``delayed_flights``, ``airline_performance``, ``hourly_flight_summary``,
    ``airport_congestion``, ``flight_alerts``, ``flights_latest``,
    ``delayed_by_origin`` and, given text lines, ``word_counts``. The views are
    lazy plans: every SQL statement runs the operators on current data."""
    from aerostream.operators import state, views, words

    defs = {
        "flights": flights,
        "delayed_flights": views.delayed_flights(flights),
        "airline_performance": views.airline_performance(flights),
        "hourly_flight_summary": views.hourly_flight_summary(flights),
        "airport_congestion": views.airport_congestion(flights),
        "flight_alerts": views.flight_alerts(flights),
        "flights_latest": state.latest_flight(flights),
        "delayed_by_origin": state.delayed_by_origin(flights, state.latest_flight(flights)),
    }
    if lines is not None:
        defs["word_counts"] = words.word_count(lines)
    for name, df in defs.items():
        df.createOrReplaceTempView(name)
    return list(defs)


def catalogue(spark: SparkSession) -> DataFrame:
    """Tables, views and running streams of the session: name, kind and, per column,
    name, type and place; a stream has one row without a column."""
    rows = [(t.name, "view" if t.isTemporary or t.tableType == "VIEW" else "table", f.name, f.dataType.simpleString(), i)
            for t in spark.catalog.listTables() for i, f in enumerate(spark.table(t.name).schema.fields)]
    rows += [(q.name or str(q.id), "stream", None, None, None) for q in spark.streams.active]
    return spark.createDataFrame(rows, "name string, kind string, column string, type string, place int")


def drop_view(spark: SparkSession, name: str) -> None:
    """Stop the streaming view ``name`` if running and drop its table/view, idempotent."""
    for q in spark.streams.active:
        if q.name == name:
            q.stop()
    spark.catalog.dropTempView(name)
    if not spark.catalog.tableExists(name):
        return
    kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
    spark.sql(f"DROP {kind} IF EXISTS `{name}`")
