"""Joins with rows that hold for a time: each row's interval is filed under the stretches of days it touches.

The join is one equi-join on the keys and the stretch, so each side is shuffled once and a hot key is spread over its stretches and split
like any other; the exact limits are checked on the few rows that meet. Open ends are closed at the days the other table spans.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .asof import by_days

STRETCH_DAYS = 366
HOT_STRETCH_DAYS = 7


def span_of(df: DataFrame, day: str) -> tuple[dt.date, dt.date] | None:
    """The first and last day of a column."""
    row = df.agg(F.min(F.col(day).cast("date")), F.max(F.col(day).cast("date"))).first()
    return None if row is None or row[0] is None else (row[0], row[1])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    day: str,
    start: str,
    end: str,
    *,
    span: tuple[dt.date, dt.date] | None = None,
    how: str = "inner",
    stretch_days: int = STRETCH_DAYS,
    hot: Column | None = None,
) -> DataFrame:
    """``left`` with the right rows of the same keys that hold on ``day``: from ``start`` to before ``end``.

    A null start or end is open. ``span``, the days ``left`` may lie in, is looked up if not given. A left row meets
    each interval that holds, one if the intervals of a key do not overlap; with ``how="left"`` it stays if none does.
    Keys for which the condition ``hot`` holds get stretches of a week, so that no task sorts a large part of one key's rows; it must
    come out alike for both sides' keys, as that of ``skew.hot`` does for keys of one type.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    span = span or span_of(left, day) or (dt.date(1970, 1, 1), dt.date(1970, 1, 1))
    first, last = (F.lit(value) for value in span)
    stretch = by_days(stretch_days if hot is None else F.when(hot, HOT_STRETCH_DAYS).otherwise(stretch_days))
    low = F.greatest(F.coalesce(F.col(start), first), first)
    high = F.least(F.coalesce(F.date_sub(F.col(end), 1), last), last)
    held = right.withColumns({"_low": low, "_high": high}).filter("_low <= _high")
    held = held.withColumn("_stretch", F.explode(F.sequence(stretch(F.col("_low")), stretch(F.col("_high")))))
    rest = [name for name in right.columns if name not in keys]
    held = held.select(*(F.col(name).alias(f"_held_{name}") for name in keys), "_stretch", "_low", "_high", *rest)
    meets = [F.col(name) == F.col(f"_held_{name}") for name in keys]
    meets += [stretch(F.col(day)) == F.col("_stretch"), F.col(day).cast("date").between(F.col("_low"), F.col("_high"))]
    # The plan sizes ``held`` by its scan, not by the stretches it is exploded into: never broadcast it.
    return left.join(held.hint("merge"), meets, how).select(*left.columns, *rest)
