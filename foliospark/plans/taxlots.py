"""Realised gains: which lots a sale takes, without pairing lots and sales.

Lots and sales of a position are laid end to end by their quantities, so that each is an interval of shares, and a sale takes the
lots its interval overlaps. The ends of all intervals cut the shares into segments that belong to one lot and one sale
each, found by two as-of joins; there are no more of them than lots and sales together.

Trades are ``keys, day, id, quantity, price``. The id tells the trades of a position's day apart. Quantities are exact to four decimals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.asof import Cut, asof_join
from ..operators.prefix import running
from .history import kept

SHARES = "decimal(28,4)"
MONEY = "decimal(18,4)"


def _trades(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a day or a positive quantity are no trades."""
    amounts = F.col("quantity").cast(SHARES).alias("quantity"), F.col("price").cast(MONEY).alias("price")
    return df.select(*keys, "day", "id", *amounts).filter("day IS NOT NULL AND quantity > 0")


def _ends(df: DataFrame, start: Column, end: Column) -> DataFrame:
    spans = df.withColumns({"start": start.cast(SHARES), "end": end.cast(SHARES)})
    return spans.filter(F.col("start") < F.col("end"))


def _segments(lots: DataFrame, sales: DataFrame, keys: Sequence[str], cut: Cut | None) -> DataFrame:
    def side(df: DataFrame, name: str) -> DataFrame:
        renamed = (F.col(c).alias(f"{name}_{c}") for c in ("day", "id", "price", "start", "end"))
        return df.select(*keys, *renamed)

    lots, sales = side(lots, "lot"), side(sales, "sale")
    ends = lots.select(*keys, F.col("lot_end").alias("end")).unionByName(sales.select(*keys, F.col("sale_end").alias("end")))
    ends = ends.distinct()
    for df, name in ((lots, "lot"), (sales, "sale")):
        values = [f"{name}_{c}" for c in ("day", "id", "price", "start")]
        ends = asof_join(ends, df, keys, "end", f"{name}_end", values, forward=True, cut=cut, once=True)
    shares = (F.col("end") - F.greatest("lot_start", "sale_start")).cast(SHARES)
    return ends.filter("lot_id IS NOT NULL AND sale_id IS NOT NULL").select(
        *keys, "sale_id", "sale_day", "lot_id", "lot_day", shares.alias("quantity"), "sale_price", F.col("lot_price").alias("cost")
    )


def first_in_first_out(
    buys: DataFrame,
    sales: DataFrame,
    keys: Sequence[str],
    *,
    cut: Cut | None = None,
    share_cut: Cut | None = None,
) -> DataFrame:
    """Segments in which the lots bought first go first; a day's buys come before its sales.

    A sale takes only what was bought before it. The deepest that the net position has been below zero is what was sold without
    being there; it takes no lots. ``cut`` splits the days of a hot position, ``share_cut`` its shares. Without them nothing is
    shuffled between the steps if the trades come partitioned by the keys.
    """
    nothing = F.lit(0).cast(SHARES)
    both = _trades(buys, keys).withColumn("is_sale", F.lit(False))
    both = both.unionByName(_trades(sales, keys).withColumn("is_sale", F.lit(True)))
    both = both.withColumns(
        {
            "bought": F.when(F.col("is_sale"), nothing).otherwise(F.col("quantity")),
            "sold": F.when(F.col("is_sale"), F.col("quantity")).otherwise(nothing),
        }
    )
    order = ["day", "is_sale", "id"]
    both = running(both, keys, order, {"bought_to": "bought", "sold_to": "sold"}, cut=cut)
    both = both.withColumn("left_over", (F.col("bought_to") - F.col("sold_to")).cast(SHARES))
    both = running(both, keys, order, {"lowest_before": "left_over"}, least=True, before=True, cut=cut)
    short_before = F.greatest(-F.col("lowest_before"), nothing)
    short = F.greatest(-F.col("left_over"), short_before)
    start = F.when(F.col("is_sale"), F.col("sold_to") - F.col("quantity") - short_before).otherwise(
        F.col("bought_to") - F.col("quantity")
    )
    end = F.when(F.col("is_sale"), F.col("sold_to") - short).otherwise(F.col("bought_to"))
    # Both sides feed the ends and an as-of join each: work them out once, not once per read.
    placed = _ends(both, start, end).select(*keys, "is_sale", "day", "id", "price", "start", "end")
    placed = kept(placed, in_place=cut is None)
    return _segments(placed.filter("NOT is_sale"), placed.filter("is_sale"), keys, share_cut)


def highest_cost_first(
    lots: DataFrame, sales: DataFrame, keys: Sequence[str], *, share_cut: Cut | None = None
) -> DataFrame:
    """Segments in which the dearest lots go first, then the oldest, over lots that are all there before the first sale."""
    held, sold = _trades(lots, keys), _trades(sales, keys)
    held = held.withColumn("cheap", -F.col("price"))
    held = running(held, keys, ["cheap", "day", "id"], {"end": "quantity"})
    sold = running(sold, keys, ["day", "id"], {"end": "quantity"})
    # Both sides feed the ends and an as-of join each: work them out once, not once per read.
    spans = (kept(_ends(df, F.col("end") - F.col("quantity"), F.col("end")), in_place=True) for df in (held, sold))
    return _segments(*spans, keys, share_cut)


def realised(sales: DataFrame, segments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per sale: shares sold, shares that lots covered, their cost, proceeds and gain."""
    shares, cost, price = F.col("quantity"), F.col("cost"), F.col("sale_price")
    sums = segments.groupBy(*keys, F.col("sale_day").alias("day"), F.col("sale_id").alias("id")).agg(
        F.sum(shares).alias("matched"), F.sum(shares * cost).alias("cost"), F.sum(shares * price).alias("proceeds")
    )
    none = F.lit(0)
    return _trades(sales, keys).join(sums, [*keys, "day", "id"], "left").select(
        *keys,
        "day",
        "id",
        "quantity",
        *(F.coalesce(c, none).alias(c) for c in ("matched", "cost", "proceeds")),
        (F.coalesce("proceeds", none) - F.coalesce("cost", none)).alias("gain"),
    )
