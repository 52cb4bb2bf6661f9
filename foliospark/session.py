"""Session settings the library is meant to run with. Nothing here is needed for right results."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS: dict[str, str] = {
    # Plan from measured sizes: coalesce small shuffle partitions, broadcast what proves small,
    # split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Send at most k rows per key and task through a "latest row" shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Filter the large side of a shuffle join by the keys of a selective small side.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Column expressions are built in Python: recording the call site of each costs driver time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


PARTITION_BYTES = 128 * 1024**2


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Partitions for the largest shuffle: about 128 MB each, and no fewer than the cores.

    Adaptive execution merges the surplus for smaller shuffles but never splits a plain partition,
    so size for the largest.
    """
    return max(cores, -(-shuffled_bytes // PARTITION_BYTES))


def configured(
    builder: SparkSession.Builder, shuffled_bytes: int | None = None, cores: int = 200
) -> SparkSession.Builder:
    """Apply the settings; with ``shuffled_bytes``, the size of the largest shuffle, also its width."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffled_bytes is not None:
        wanted = shuffle_partitions(shuffled_bytes, cores)
        builder = builder.config("spark.sql.shuffle.partitions", str(wanted))
    return builder
