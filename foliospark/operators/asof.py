"""As-of joins: for each row the last row of another table up to its time, or the first one from it on.

Both tables are united and sorted by key and time, and a running ``last`` that skips nulls carries the wanted row along: no
range join, and work in proportion to the rows. Many rows that ask about one moment of a key ask once. ``cut`` splits a
key's time into stretches that different tasks sort; what was last before a stretch is carried into it, so a hot key has no
task of its own.

Left rows that are alone at their keys and time (``once``) ride along in that window: nothing is joined back, and where both
sides are already partitioned by some of the keys nothing is shuffled. Where a key has a few right rows only, ``histories``
puts them into one row per key, which any number of left rows meet in one equi-join (``asof_history``). ``asof_join_along`` sends
repeated left rows through the window too, but for keys with too many of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import skew

Cut = Callable[[Column], Column]
ROWS_ALONG = 100_000  # left rows of one key that a task may sort and hold at once: about 10 MB


def by_days(days: int | Column) -> Cut:
    """Stretches of so many days, for dates and timestamps; a column gives each key stretches of its own."""
    return lambda time: F.floor(F.unix_date(time.cast("date")) / F.lit(days))


def by_width(width: float) -> Cut:
    """Stretches of equal width, for numbers."""
    return lambda number: F.floor(number / F.lit(width))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    at: str,
    right_at: str,
    values: Sequence[str],
    *,
    forward: bool = False,
    cut: Cut | None = None,
    once: bool = False,
) -> DataFrame:
    """``left`` with ``values`` of the right row of the same keys that is last at or before ``at``.

    ``forward`` takes the first one at or after it. Left rows without one, without a time or with a null key get nulls.
    ``right`` must hold one row per keys and time (see ``temporal.latest_per_key``); rows without a time count as absent.
    ``once`` sends the left rows themselves through the window: for a ``left`` that holds one row per keys and time too, or few rows per key.
    """
    if once:
        return _riding(left, right, keys, at, right_at, values, forward, cut)
    stretch = cut or (lambda time: F.lit(0).cast("long"))
    row = F.struct(*(F.col(name) for name in values))
    kind = right.select(row.alias("row")).schema["row"].dataType
    known = right.filter(F.col(right_at).isNotNull()).select(*keys, F.col(right_at).alias("_at"), row.alias("_row"))
    known = known.withColumn("_cut", stretch(F.col("_at")))
    asked = left.filter(F.col(at).isNotNull()).select(*keys, F.col(at).alias("_at")).distinct()
    asked = asked.withColumn("_cut", stretch(F.col("_at")))

    rows = known.withColumn("_turn", F.lit(1)).unionByName(
        asked.withColumns({"_row": F.lit(None).cast(kind), "_turn": F.lit(2)})
    )
    if cut is not None:
        rows = rows.unionByName(_carried(known, asked, keys, forward, kind))
    found = rows.withColumn("_found", _last_so_far([*keys, "_cut"], forward)).filter("_turn = 2")
    found = found.select(*keys, F.col("_at").alias(at), "_found")
    return left.join(found, [*keys, at], "left").select(
        *left.columns, *(F.col("_found")[name].alias(name) for name in values)
    )


def asof_join_along(
    left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, right_at: str, values: Sequence[str], *, cut: Cut | None = None
) -> DataFrame:
    """``asof_join`` in which left rows ride along, however many have one moment, so that each side is shuffled once.

    Keys with more than ``ROWS_ALONG`` left rows are looked up first and ask once for each moment in stretches of ``cut``, so that none
    of them fills a task; ``right`` should hold no more rows per key than that, as one row per day does. Reads ``left`` twice, so it should be
    worked out already.
    """
    hot = skew.hot(left.select(*keys), keys, ROWS_ALONG)
    if hot is None:
        return asof_join(left, right, keys, at, right_at, values, once=True)
    cold = asof_join(left.filter(~hot), right.filter(~hot), keys, at, right_at, values, once=True)
    return cold.unionByName(asof_join(left.filter(hot), right.filter(hot), keys, at, right_at, values, cut=cut))


def _last_so_far(within: Sequence[str], forward: bool) -> Column:
    # At one time the known row comes before the question; what is carried in comes before all.
    order = [F.when(F.col("_turn") == 0, 0).otherwise(1), F.desc("_at") if forward else F.asc("_at"), F.col("_turn")]
    so_far = W.partitionBy(*within).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return F.last("_row", ignorenulls=True).over(so_far)


def _riding(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    at: str,
    right_at: str,
    values: Sequence[str],
    forward: bool,
    cut: Cut | None,
) -> DataFrame:
    """The as-of join of left rows that go through the window themselves."""
    row = F.struct(*(F.col(name) for name in values))
    kind = right.select(row.alias("row")).schema["row"].dataType
    known = right.filter(F.col(right_at).isNotNull()).select(*keys, F.col(right_at).alias("_at"), row.alias("_row"))
    asked = left.withColumnRenamed(at, "_at")
    within = list(keys)
    if cut is not None:
        within.append("_cut")
        known, asked = (df.withColumn("_cut", cut(F.col("_at"))) for df in (known, asked))
    rows = known.withColumn("_turn", F.lit(1))
    if cut is not None:
        rows = rows.unionByName(_carried(known, asked, keys, forward, kind))
    rows = rows.unionByName(asked.withColumns({"_row": F.lit(None).cast(kind), "_turn": F.lit(2)}), allowMissingColumns=True)
    found = rows.withColumn("_found", _last_so_far(within, forward)).filter("_turn = 2")
    # Null keys share a partition of the window, and a missing time sorts somewhere: neither finds a row.
    asks = F.col("_at").isNotNull()
    for key in keys:
        asks = asks & F.col(key).isNotNull()
    moment = F.col("_at").cast(left.schema[at].dataType).alias(at)
    return found.select(
        *(moment if name == at else F.col(name) for name in left.columns),
        *(F.when(asks, F.col("_found")[name]).alias(name) for name in values),
    )


def histories(right: DataFrame, keys: Sequence[str], right_at: str, values: Sequence[str]) -> DataFrame:
    """One row per keys with all their right rows in order of time, for ``asof_history``: a few rows per key."""
    known = right.filter(F.col(right_at).isNotNull())
    row = F.struct(F.col(right_at).alias("_at"), F.struct(*(F.col(name) for name in values)).alias("_row"))
    return known.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("_history"))


def asof_history(left: DataFrame, found: DataFrame, keys: Sequence[str], at: str, values: Sequence[str]) -> DataFrame:
    """``left`` with ``values`` of the last row at or before ``at`` in the ``histories`` of its keys; rows without one stay out."""
    up_to = F.filter("_history", lambda known: known["_at"] <= F.col(at))
    joined = left.join(found, list(keys)).select(*left.columns, F.try_element_at(up_to, F.lit(-1))["_row"].alias("_found"))
    return joined.filter(F.col("_found").isNotNull()).select(
        *left.columns, *(F.col("_found")[name].alias(name) for name in values)
    )


def _carried(known: DataFrame, asked: DataFrame, keys: Sequence[str], forward: bool, kind: object) -> DataFrame:
    """For each stretch that is asked about, the row its neighbours on the way hand over: a few per key."""
    edge = F.min_by("_row", "_at") if forward else F.max_by("_row", "_at")
    ends = known.groupBy(*keys, "_cut").agg(edge.alias("_row")).withColumn("_asked", F.lit(False))
    wanted = asked.select(*keys, "_cut").distinct()
    wanted = wanted.withColumns({"_row": F.lit(None).cast(kind), "_asked": F.lit(True)})
    order = F.desc("_cut") if forward else F.asc("_cut")
    # Rows of the stretch itself are no handover: only those of stretches before it on the way.
    before = W.partitionBy(*keys).orderBy(order).rangeBetween(W.unboundedPreceding, -1)
    both = ends.unionByName(wanted).withColumn("_row", F.last("_row", ignorenulls=True).over(before))
    both = both.filter(F.col("_asked") & F.col("_row").isNotNull())
    nothing = F.lit(None).cast(known.schema["_at"].dataType)
    return both.select(*keys, nothing.alias("_at"), "_row", "_cut", F.lit(0).alias("_turn"))
