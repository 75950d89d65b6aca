"""Session settings for a run started from the command line.

Library code never sets these; a caller with its own session keeps its own.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SHUFFLE_BLOCK_BYTES = 128 * 1024 * 1024
# Every partition costs the driver a status per map task; beyond this many the
# partitions grow instead.
MAX_PARTITIONS = 20_000


def shuffle_partitions(
    shuffled_bytes: int, minimum: int = 200, maximum: int = MAX_PARTITIONS
) -> int:
    """Partitions that keep a shuffle of this size in memory-sized pieces, bounded."""
    return min(maximum, max(minimum, -(-shuffled_bytes // SHUFFLE_BLOCK_BYTES)))


def size_shuffles(spark: SparkSession, shuffled_bytes: int) -> None:
    """Set the initial number of partitions for the volume of a stage."""
    spark.conf.set(
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        str(shuffle_partitions(shuffled_bytes)),
    )


def session(name: str) -> SparkSession:
    """The running session, or one with adaptive execution.

    Adaptive execution merges small partitions and splits skewed joins, so the initial
    number may be generous; ``size_shuffles`` takes it from the volume to shuffle.
    """
    return (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
