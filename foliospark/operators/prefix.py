"""Running sums and minima over long keys.

A window sorts all rows of a key in one task. With ``cut`` the key's order is split into stretches that different tasks sort, and what
the stretches before it add up to is joined to each: that table has a row per key and stretch only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .asof import Cut


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, str],
    *,
    least: bool = False,
    before: bool = False,
    cut: Cut | None = None,
) -> DataFrame:
    """For each ``new name: column`` the sum, or with ``least`` the minimum, from the key's first row to this one.

    With ``before`` this row does not count; a first row's sum or minimum is then null. ``order`` must tell the rows of a key apart; ``cut`` is applied to its first column, which must not be null.
    """
    combine = F.min if least else F.sum
    last = -1 if before else W.currentRow
    kinds = {new: df.schema[column].dataType for new, column in sums.items()}
    if cut is None:
        so_far = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, last)
        return df.withColumns({new: combine(column).over(so_far).cast(kinds[new]) for new, column in sums.items()})
    rows = df.withColumn("_cut", cut(F.col(order[0])))
    parts = rows.groupBy(*keys, "_cut").agg(*(combine(column).alias(f"_before_{new}") for new, column in sums.items()))
    earlier = W.partitionBy(*keys).orderBy("_cut").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumns({f"_before_{new}": combine(f"_before_{new}").over(earlier) for new in sums})
    within = W.partitionBy(*keys, "_cut").orderBy(*order).rowsBetween(W.unboundedPreceding, last)
    rows = rows.withColumns({new: combine(column).over(within) for new, column in sums.items()})

    def whole(new: str) -> Column:
        own, carried = F.col(new), F.col(f"_before_{new}")
        both = F.least(own, carried) if least else F.coalesce(own + carried, own, carried)
        return both.cast(kinds[new])

    joined = rows.join(parts, [*keys, "_cut"]).withColumns({new: whole(new) for new in sums})
    return joined.select(*df.columns, *sums)
