"""Performance attribution: which decisions made a portfolio differ from its benchmark, by segment, region or in all.

In each period a segment's excess splits into allocation (holding more or less of it than the benchmark does), selection (holding better
or worse things in it) and interaction (both at once). They add up to the period's excess return. Returns of periods multiply, so a
period's effects are carried to the end by what the portfolio earned before it and the benchmark earned after it; then
they add up to the excess over all periods too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import exact_sum, half_up, ratio

VALUE = "decimal(38,4)"
SIDES = ("held_start", "held_end", "market_start", "market_end")
EFFECTS = ("allocation", "selection", "interaction")


def _present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows without a null or NaN in these columns; joins on them then add no filter, so that plans that read the rows stay alike."""
    kinds = dict(df.dtypes)
    for name in names:
        df = df.filter(F.col(name).isNotNull())
        if kinds[name] in ("float", "double"):
            df = df.filter(~F.isnan(name))
    return df


def _sums(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact values by segment."""
    usable = df.filter((F.col("start") > 0) & F.col("end").isNotNull())
    return usable.groupBy(*by).agg(*(F.sum(F.col(c).cast("decimal(28,4)")).alias(c) for c in ("start", "end")))


def _side(sums: DataFrame, by: Sequence[str], own: bool) -> DataFrame:
    """The values on one side, zero on the other."""
    values, nothing = [F.col("start"), F.col("end")], [F.lit(0), F.lit(0)]
    return sums.select(*by, *(values + nothing if own else nothing + values)).toDF(*by, *SIDES)


def segments(held: DataFrame, benchmark: DataFrame, keys: Sequence[str], period: str, dims: Sequence[str]) -> DataFrame:
    """A row per portfolio, period and segment that the portfolio or the benchmark holds, with what both held at start and end."""
    sums = _sums(_present(held, [period]), [*keys, period, *dims])
    own = _side(_present(sums, keys), [*keys, period, *dims], own=True)
    if benchmark.sameSemantics(held.drop(*keys)):
        # The benchmark is all portfolios together: add up their sums, not their positions once more.
        together = sums.groupBy(period, *dims).agg(*(F.sum(c).alias(c) for c in ("start", "end")))
    else:
        together = _sums(_present(benchmark, [period]), [period, *dims])
    market = _side(together, [period, *dims], own=False)
    there = own.select(*keys, period).distinct()
    both = own.unionByName(market.join(there, period).select(*own.columns))
    return both.groupBy(*keys, period, *dims).agg(*(F.sum(c).cast(VALUE).alias(c) for c in SIDES))


def _growth(end: str, start: str) -> Column:
    return ratio(F.col(end).cast("double"), F.col(start).cast("double"))


def attribution(
    held: DataFrame, benchmark: DataFrame, keys: Sequence[str], period: str, dims: Sequence[str]
) -> DataFrame:
    """Linked effects per portfolio: one row for each segment, for each value of each of ``dims``, and for the whole.

    ``held`` has ``keys, period, dims, start, end``, the values of a position when a period begins and ends; ``benchmark`` the same
    without keys. Positions without a positive start or without an end, and rows without a key or period, are left out, and
    so are periods in which the benchmark has none. ``level`` names the dimensions a row is for; a null dimension in
    its level is a segment of its own. A segment that the benchmark lacks counts as earning the benchmark's
    return there, one that the portfolio lacks as earning the segment's. Effects are added to ten decimals.
    """
    leaves = segments(held, benchmark, keys, period, dims)
    whole = leaves.groupBy(*keys, period).agg(*(F.sum(c).cast(VALUE).alias(f"all_{c}") for c in SIDES))
    whole = whole.filter("all_market_start > 0 AND all_held_start > 0").withColumns(
        {"grown": _growth("all_held_end", "all_held_start"), "market_grown": _growth("all_market_end", "all_market_start")}
    )
    periods = Window.partitionBy(*keys).orderBy(period)
    first, last = Window.unboundedPreceding, Window.unboundedFollowing
    one = F.lit(1.0)
    whole = whole.withColumns(
        {
            "carried": F.coalesce(F.product("grown").over(periods.rowsBetween(first, -1)), one)
            * F.coalesce(F.product("market_grown").over(periods.rowsBetween(1, last)), one),
            "portfolio_return": F.product("grown").over(periods.rowsBetween(first, last)) - one,
            "benchmark_return": F.product("market_grown").over(periods.rowsBetween(first, last)) - one,
        }
    )
    rows = leaves.join(whole, [*keys, period])
    share, market_share = _growth("held_start", "all_held_start"), _growth("market_start", "all_market_start")
    rows = rows.withColumns({"over": share - market_share, "share": share, "market_share": market_share})
    rows = rows.withColumn("segment_grown", F.coalesce(_growth("market_end", "market_start"), F.col("market_grown")))
    better = F.coalesce(_growth("held_end", "held_start"), F.col("segment_grown")) - F.col("segment_grown")
    parts = {
        "allocation": F.col("over") * (F.col("segment_grown") - F.col("market_grown")),
        "selection": F.col("market_share") * better,
        "interaction": F.col("over") * better,
    }
    rows = rows.withColumns({name: effect * F.col("carried") for name, effect in parts.items()})
    sets = [[*keys, *dims], *([*keys, d] for d in dims if len(dims) > 1), [*keys]]
    level = F.concat_ws(",", *(F.when(F.grouping(d) == 0, F.lit(d)) for d in dims))
    rolled = rows.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(c) for c in (*keys, *dims))).agg(
        F.coalesce(F.nullif(level, F.lit("")), F.lit("total")).alias("level"),
        *(exact_sum(F.col(name)).alias(name) for name in EFFECTS),
        *(half_up(F.max(name), 8).alias(name) for name in ("portfolio_return", "benchmark_return")),
    )
    allocation, selection, interaction = (F.col(name).cast("decimal(30,10)") for name in EFFECTS)
    excess = (allocation + selection + interaction).cast("double").alias("excess")
    return rolled.select(*keys, "level", *dims, *EFFECTS, excess, "portfolio_return", "benchmark_return")
