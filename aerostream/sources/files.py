"""File, JDBC and catalog sources, and file-backed streams."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostream.schema import SEQUENCED_FLIGHT_SCHEMA, STATUS, TEXT_SCHEMA
from aerostream.sources.tables import normalise


def parquet_view(spark: SparkSession, path: str, name: str = "flights") -> DataFrame:
    """Register a Parquet file/folder of flight records as a temp view, normalised
    like every other flight source (schema from the footer)."""
    df = normalise(spark.read.parquet(path))
    df.createOrReplaceTempView(name)
    return df


def delimited_lines(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Raw lines of a delimited text file as ``value`` (header line skipped).

    Read as text, so blank lines and any character stay; files are split by byte
    ranges, so a large file is read in parallel. The header is the line at the
    start of each file: of the rows of a file's first block, the first one.
    """
    if not header:
        return spark.read.schema(TEXT_SCHEMA).text(path)
    first = F.col("_metadata.file_block_start") == 0
    lines = spark.read.schema(TEXT_SCHEMA).text(path).select(
        "value", first.alias("_first"), F.monotonically_increasing_id().alias("_at"), F.col("_metadata.file_path").alias("_file"))
    heads = lines.where("_first").groupBy("_file").agg(F.min("_at").alias("_head")).select(F.col("_head").alias("_at"))
    return lines.join(heads, "_at", "left_anti").select("value")


def placeholder_flights(spark: SparkSession) -> DataFrame:
    """Empty stand-in ``flights`` table with the full record schema, so every
    query still runs when the real source could not be read."""
    return spark.createDataFrame([], SEQUENCED_FLIGHT_SCHEMA)


# fixed values: Spark's error conditions for a source that is not there
NOTHING_TO_READ = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _nothing_there(e: AnalysisException) -> bool:
    return (e.getCondition() or "").split(".")[0] in NOTHING_TO_READ


def read_or_placeholder(spark: SparkSession, read) -> DataFrame:
    """``read()`` or, if there is nothing to read (missing path or table, no
    schema to be found), the placeholder table. Any other failure is raised: a
    table that exists is never taken for an empty one."""
    try:
        df = read()
        df.schema  # forces analysis: missing files or columns fail here
        return df
    except AnalysisException as e:
        if _nothing_there(e):
            return placeholder_flights(spark)
        raise


@dataclass(frozen=True)
class Imported:
    """An imported table; ``cut`` if it is the stand-in because time ran out,
    ``missing`` if there was nothing to read."""

    table: DataFrame
    cut: bool = False
    missing: bool = False


def import_table(spark: SparkSession, read: Callable[[], DataFrame], path: str, seconds: float,
                 stand_in: Callable[[SparkSession], DataFrame] = placeholder_flights) -> Imported:
    """Copy ``read()`` to Parquet under ``path`` within a time limit.

    All jobs of the copy run under a tag of their own. At the limit a timer
    cancels that tag, so no job of the copy is left behind, and the stand-in
    takes the table's place; what was written is uncommitted and never read. Any
    failure that is not this cancellation is raised, as are failures that come
    first.
    """
    sc = spark.sparkContext
    tag = f"import-{uuid.uuid4().hex}"
    ran_out = threading.Event()

    def cancel() -> None:
        ran_out.set()
        # jobs may start after the limit, too: of a plan with several stages each is one
        while not done.wait(0.2):
            sc.cancelJobsWithTag(tag)

    done = threading.Event()
    timer = threading.Timer(seconds, cancel)
    timer.daemon = True
    sc.addJobTag(tag)
    timer.start()
    try:
        df = read()
        df.write.mode("overwrite").parquet(path)
    except AnalysisException as e:
        if _nothing_there(e):
            return Imported(stand_in(spark), missing=True)
        raise
    except Exception as e:
        if ran_out.is_set() and _cancelled(e, tag):
            return Imported(stand_in(spark), cut=True)
        raise
    finally:
        done.set()
        timer.cancel()
        sc.removeJobTag(tag)
    return Imported(spark.read.schema(df.schema).parquet(path))


def _cancelled(e: BaseException, tag: str) -> bool:
    """Whether the failure says that the tag's jobs were cancelled."""
    text = str(e) + str(getattr(e, "java_exception", ""))
    return tag in text or "SPARK_JOB_CANCELLED" in text or "cancelled" in text


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """JDBC table scan; with a numeric ``partition_column`` and bounds the scan
    is split into ``num_partitions`` parallel range queries."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return r.load()


def iceberg_catalog_conf(name: str, uri: str, warehouse: str | None = None,
                         credential: str | None = None, extra: dict | None = None) -> dict[str, str]:
    """Session settings for a read-only Iceberg REST catalog called ``name``
    (the Iceberg Spark runtime jar must be on the classpath)."""
    p = f"spark.sql.catalog.{name}"
    conf = {p: "org.apache.iceberg.spark.SparkCatalog", f"{p}.type": "rest", f"{p}.uri": uri}
    if warehouse:
        conf[f"{p}.warehouse"] = warehouse
    if credential:
        conf[f"{p}.credential"] = credential
    for k, v in (extra or {}).items():
        conf[f"{p}.{k}"] = v
    return conf


# ------------------------------------------------------------------- file streams

def flight_file_stream(spark: SparkSession, path: str, fmt: str = "json",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Sequenced flight records arriving as files (JSON lines or Parquet).

    The file source plays the part of the topic in tests and replays: files are
    taken in modification-time order, one micro-batch per trigger.
    """
    r = spark.readStream.schema(SEQUENCED_FLIGHT_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.format(fmt).load(path)
    return df.where(F.col("flightNumber").isNotNull()).withColumn(STATUS, F.upper(F.col(STATUS)))


def text_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(path)
