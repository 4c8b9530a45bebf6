"""Session settings the pipeline relies on, and the shared scratch location."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# SQL confs the pipeline needs; all are runtime-settable.
REQUIRED_SQL_CONF = {
    # CUR timestamps are UTC; day/month truncation and date keys use it.
    "spark.sql.session.timeZone": "UTC",
    # Re-running a month replaces only the partitions it writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Recommended for scale: AQE re-plans joins from measured sizes, splits
# skewed join partitions and coalesces small shuffle partitions.
SCALE_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # A task of a write by month holds the rows of few months: that many files
    # stay open at once, and its wide rows are sorted only beyond.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # A query's shuffle files go when it ends, not when the driver collects its
    # garbage: a run of many steps needs the disk of its largest one. A frame that
    # is run again shuffles again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Hash keys and sums hardly shrink under snappy.
    "spark.sql.parquet.compression.codec": "zstd",
}


def cluster_conf(
    windowed_input_bytes: int, shuffled_bytes: int | None = None, target_partition_bytes: int = 256 << 20
) -> dict[str, str]:
    """Settings for a large cluster.

    Shuffle partitions are sized from the bytes expected to be shuffled: give
    ``shuffled_bytes`` as measured in an earlier run, else a thirty-second of
    the input is assumed (the shuffles carry partially aggregated rows). AQE
    coalesces them at run time to ``target_partition_bytes`` per task. Scan
    splits use that size of input. Only parallelism depends on these.
    Pass the result to ``SparkSession.builder.config(map=...)`` or
    ``spark-submit --conf``.
    """
    if shuffled_bytes is None:
        shuffled_bytes = windowed_input_bytes // 32
    initial = max(200, -(-shuffled_bytes // target_partition_bytes))
    return {
        **SCALE_SQL_CONF,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        # broadcast joins only from sizes measured at run time (AQE), never
        # from file-size estimates made before the job (compressed parquet
        # sizes can understate the in-memory size many times over)
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        # split a skewed join partition when it is 5x the median and > 1 GiB
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    }


def configure(spark: SparkSession) -> SparkSession:
    for k, v in {**REQUIRED_SQL_CONF, **SCALE_SQL_CONF}.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "costmart") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("COSTMART_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**REQUIRED_SQL_CONF, **SCALE_SQL_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Where it is unset, a local session takes a folder beside the tables of its
    warehouse. On a cluster that folder may be the driver's own, so there the
    setting is required.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.getCheckpointDir():
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/costmart/{name}-{uuid.uuid4().hex[:12]}"
