"""Trends by period: trailing sums, growth over a year and streaks, with missing periods taken as missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent

AMOUNT = "decimal(28,4)"


def trends(df: DataFrame, keys: Sequence[str], period: str, value: str, *, span: int = 4) -> DataFrame:
    """A row per key and period that has a value, the values of equal ones added up exactly.

    ``period`` is a whole number that rises by one, such as year * 4 + quarter. ``trailing`` is the sum of the last ``span`` periods, null
    unless all of them are there, and ``growth_pct`` compares with the period ``span`` before. ``direction`` is 1, 0 or -1 against the
    period just before, null where that is missing; ``streak`` counts the periods in a row that went the same way, this one
    included, and is 0 without a direction. Rows without a period or value are left out.

    The three windows share one order, so the summed rows are sorted once; a key has a row per period, however many rows it had.
    """
    amount = F.col(value).cast(AMOUNT)
    rows = df.filter(F.col(period).isNotNull() & amount.isNotNull())
    rows = rows.groupBy(*keys, F.col(period).cast("int").alias(period)).agg(F.sum(amount).cast(AMOUNT).alias(value))
    by = Window.partitionBy(*keys).orderBy(period)
    last = by.rangeBetween(1 - span, 0)
    before, earlier = by.rangeBetween(-1, -1), by.rangeBetween(-span, -span)
    rows = rows.withColumns(
        {
            "trailing": F.when(F.count(value).over(last) == span, F.sum(value).over(last)),
            "growth_pct": percent(
                F.col(value).cast("double") - F.max(value).over(earlier).cast("double"), F.max(value).over(earlier).cast("double")
            ),
            "direction": F.sign(F.col(value) - F.max(value).over(before)).cast("int"),
        }
    )
    turned = ~F.col("direction").eqNullSafe(F.lag("direction").over(by)) | F.col("direction").isNull()
    rows = rows.withColumn("_turned", F.when(turned, F.col(period)))
    since = F.last("_turned", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    streak = F.when(F.col("direction").isNull(), 0).otherwise(F.col(period) - since + 1)
    return rows.withColumn("streak", streak.cast("int")).drop("_turned")
