"""Session settings the engine assumes (applied only where the caller has not set them)."""

from __future__ import annotations

import math
import os

from pyspark.sql import SparkSession

# Defaults for running reports: UTC session (DATE(ts) of the source warehouse is UTC),
# ANSI casts (strict CAST raises on bad input, as in the source), adaptive execution
# with partition coalescing and skew-join splitting.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}

# Facts bucketed by a part of their join keys (plans/compact.py) are joined without an exchange
# only if Spark accepts a partitioning by some of the keys. Set it for runs over such tables.
BUCKETED_FACTS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "spendlens", warehouse: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, small shuffle fan-out)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("SPENDLENS_DRIVER_MEMORY", "8g")))
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if warehouse:
        b = b.config("spark.sql.warehouse.dir", warehouse)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set ``DEFAULTS`` on a running session where the cluster has not set them."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    return spark


def cluster_settings(largest_shuffle_bytes: int, partition_bytes: int = 256 << 20,
                     broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """SQL settings sized for a large run from the biggest expected shuffle.

    The biggest shuffle of a report is a roll-up's output after map-side combine, not
    the raw input. Shuffles start with enough partitions to keep each near 64 MB and AQE
    coalesces them to ``partition_bytes``; a partition several times the advisory size
    is split as skewed. Scans read ``partition_bytes`` splits. Dimensions are broadcast
    only below ``broadcast_bytes`` of measured shuffle size (AQE), or a quarter of it by
    file statistics before the run.
    """
    initial = max(200, math.ceil(largest_shuffle_bytes / (64 << 20)))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        # coalesce toward the advisory size rather than keeping one partition per core: on a
        # big shared cluster that avoids floods of tiny tasks (on one small machine it would
        # serialise tiny stages, so local sessions keep Spark's default)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        # the static decision sees compressed file sizes (in memory a table can be several
        # times larger); the adaptive one sees measured shuffle sizes, so it may go higher
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes // 4),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        # a filtered dimension that is not broadcast still prunes the fact before its
        # shuffle through a runtime bloom filter (injected for fact scans over 10 GB)
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }
