"""Spark session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Semantics: NTZ timestamps are interpreted without a session zone by every helper in
# ``functions.timeops``, but a fixed session zone keeps DATE<->TIMESTAMP casts stable.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed join
    # partitions (hot job / request keys), switch to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimensions are broadcast only when Spark's size estimate (re-checked by AQE with
    # the real size) is under this bound; larger sides are sort-merge joined.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def configure(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "jobfacts") -> SparkSession:
    """A local session for tests and the benchmark (a cluster passes its own session)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.driver.memory", "8g")
    spark = configure(builder, shuffle_partitions).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Settings for the full-size run (about 100 TB of input on ~1000 executors).  A cluster
# session is created by the platform; apply these with ``spark.conf.set`` or
# ``--conf``.  Shuffle partitions follow from the largest shuffle, the line items by their key:
# measured on sf0.1 it writes 18.2 MB (30 bytes a row) for 16.0 MB of input files in all, so
# about 114 TB for 100 TB, 1.1 GB compressed in each of 100,000 partitions; such a task sorts
# with spills, and more partitions would make shuffle blocks smaller than 3 KB (each of some
# 400,000 map tasks writes one per partition).  AQE coalesces the partitions of smaller
# shuffles to the advisory size; frequent keys are split (``operators.hotkeys``).
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "100000",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    # dimensions are broadcast only under this size (estimate, re-checked by AQE)
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def apply_cluster_settings(spark: SparkSession) -> None:
    for key, value in CLUSTER_SETTINGS.items():
        spark.conf.set(key, value)
