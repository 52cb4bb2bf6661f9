"""What differs between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def digest(columns: Sequence[str]) -> list[Column]:
    """128 bits that stand for a row's values, nulls told apart from empty texts."""
    parts = [part for name in columns for part in (F.col(name).isNull(), F.col(name))]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"_digest{seed}") for seed in (1, 2)]


def change_set(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, change`` for each key that was ``added``, ``removed`` or ``changed``.

    Both tables have the same columns. Only keys and digests are shuffled, once. Null keys are keys like others; a key with
    several rows has changed if their collection has.
    """
    values = [name for name in new.columns if name not in keys]

    def side(df: DataFrame, one: int) -> DataFrame:
        first, second = digest(values)
        return df.select(*keys, first, second, F.lit(one).alias("_new"))

    rows = side(old, 0).unionByName(side(new, 1))
    is_new = F.col("_new") == 1
    # As decimals the sums can't overflow; equal collections have equal counts and sums on both sides.
    sums = [
        F.sum(F.when(is_new, F.col(name).cast("decimal(20,0)")).otherwise(-F.col(name).cast("decimal(20,0)"))).alias(name)
        for name in ("_digest1", "_digest2")
    ]
    counts = [F.count(F.when(is_new, 1)).alias("_after"), F.count(F.when(~is_new, 1)).alias("_before")]
    compared = rows.groupBy(*keys).agg(*counts, *sums)
    change = (
        F.when(F.col("_before") == 0, "added")
        .when(F.col("_after") == 0, "removed")
        .when((F.col("_before") != F.col("_after")) | (F.col("_digest1") != 0) | (F.col("_digest2") != 0), "changed")
    )
    return compared.withColumn("change", change).filter("change IS NOT NULL").select(*keys, "change")
