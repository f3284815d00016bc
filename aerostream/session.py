"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "aerostream", extra: dict | None = None) -> SparkSession:
    """Session with the settings every operator assumes.

    On a cluster pass ``master=None`` (spark-submit decides) and size
    ``shuffle_partitions`` to the data (about 128-256 MB per shuffle partition);
    AQE coalesces small partitions and splits skewed ones at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # 4.1 takes a union's sides as partitioned alike even where the adaptive
        # plan coalesces them unlike each other, and groups such rows apart
        "spark.sql.unionOutputPartitioning": "false",
        "spark.ui.enabled": "false",
        # remove checkpoint files of RDDs that are no longer referenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) a fresh local folder is made
    and registered; on a cluster the setting must point at shared storage.
    ``DataFrame.checkpoint()`` writes under it (the context's RDD checkpoint
    folder is set to it once).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote client: the server owns the checkpoint folder
        sc = None
    root = spark.conf.get(CHECKPOINT_CONF, None) or (sc.getCheckpointDir() if sc else None)
    if not root:
        if sc is not None and not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="aerostream-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(checkpoint_root(spark), *parts)


def estimated_bytes(df) -> int:
    """The optimizer's size estimate of a DataFrame (file sizes for scans)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def size_shuffle_partitions(spark: SparkSession, *inputs, bytes_per_partition: int = 256 << 20,
                            min_partitions: int | None = None) -> int:
    """Set ``spark.sql.shuffle.partitions`` so the inputs' bytes give about
    ``bytes_per_partition`` per shuffle partition (at least one per core), and
    make AQE coalesce toward the same size. Partial aggregation shrinks most
    shuffles far below the input, so this is an upper bound AQE trims at run
    time; it keeps partitions of skew-free large shuffles within executor
    memory instead of spilling."""
    total = sum(estimated_bytes(df) for df in inputs)
    floor = min_partitions or spark.sparkContext.defaultParallelism
    n = max(floor, -(-total // bytes_per_partition))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(bytes_per_partition))
    return n
