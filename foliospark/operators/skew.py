"""Keeping joins splittable when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
BUCKETS = 1 << 16
MOST_BUCKETS = 1 << 20
MOST_FULL = 1 << 12


def splittable(df: DataFrame, key: str) -> DataFrame:
    """Make the next join on a string key start from a shuffle of its own.

    Adaptive execution splits a skewed join only where both inputs come straight from a shuffle. A
    windowed or grouped frame is already partitioned by its key, so Spark would join it in place and
    leave the other input's hot partition whole. Deriving the key anew hides that partitioning.
    The extra shuffle moves only this side, which holds a few columns of one row per key.
    """
    return df.withColumn(key, F.concat(F.col(key), F.lit("")))


def hot(df: DataFrame, keys: Sequence[str], rows: int | None = None) -> Column | None:
    """A condition on the keys that holds for those with more rows in ``df`` than one task should sort; None if there are none.

    Keys are counted by buckets of their hash, so the driver gets a number per full bucket, ``MOST_FULL`` at most, and nothing is joined.
    Keys that share a bucket with a hot one count as hot. Where more buckets are full, as they are when even common keys add up to that many
    rows, finer ones are counted; if those do not tell the hot keys either, all keys count as hot. Reads ``df``: hand in the keys only.
    """
    buckets = BUCKETS
    while True:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
        counts = df.groupBy(bucket.alias("bucket")).count().filter(F.col("count") > (HOT_ROWS if rows is None else rows))
        full = [row["bucket"] for row in counts.orderBy(F.desc("count")).limit(MOST_FULL + 1).collect()]
        if not full:
            return None
        if len(full) <= MOST_FULL:
            return bucket.isin(full)
        if buckets >= MOST_BUCKETS:
            return F.lit(True)
        buckets *= 16
