"""Picking rows in time: the latest row, the next row and the currently valid estimates.

Selection is ``row_number() <= k`` over a window. Spark turns that into a group limit that runs
before the shuffle, so each task sends at most k rows per key however many rows one key has.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int
) -> DataFrame:
    place = "_place"
    ranked = df.withColumn(place, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(place) <= k).drop(place)


def _ties(tie_breakers: Sequence[str]) -> list[Column]:
    if not tie_breakers:
        raise ValueError("tie_breakers must name at least one column, or equal dates pick a random row")
    return [F.col(name).asc_nulls_last() for name in tie_breakers]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_col: str, tie_breakers: Sequence[str], k: int = 1
) -> DataFrame:
    """The k most recent rows of each key (one by default)."""
    return _first_per_key(df, keys, [F.col(order_col).desc_nulls_last(), *_ties(tie_breakers)], k)


def next_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    as_of: dt.date,
    tie_breakers: Sequence[str],
    k: int = 1,
) -> DataFrame:
    """The k rows of each key that come first on or after ``as_of``."""
    future = df.filter(F.col(order_col) >= F.lit(as_of))
    return _first_per_key(future, keys, [F.col(order_col).asc(), *_ties(tie_breakers)], k)


def current_estimates(
    estimates: DataFrame, item: str, as_of: dt.date | None, horizon_days: int | None = None
) -> DataFrame:
    """Estimates of one item whose revision is still valid, for periods from ``as_of`` on.

    ``horizon_days`` closes the period range; ``as_of=None`` keeps every period.
    """
    kept = estimates.filter((F.col("FE_ITEM") == item) & F.col("CONS_END_DATE").isNull())
    if as_of is None:
        return kept
    kept = kept.filter(F.col("FE_FP_END") >= F.lit(as_of))
    if horizon_days is not None:
        kept = kept.filter(F.col("FE_FP_END") <= F.date_add(F.lit(as_of), horizon_days))
    return kept


def split_by_date(
    live: DataFrame, history: DataFrame, date_col: str, as_of: dt.date
) -> tuple[DataFrame, DataFrame]:
    """Rows of the day ``as_of`` from the live source and earlier rows from the history.

    The day is a half-open range, so dates and timestamps both work and both ranges reach the scan.
    """
    day, following = F.lit(as_of), F.lit(as_of + dt.timedelta(days=1))
    moment = F.col(date_col)
    return live.filter((moment >= day) & (moment < following)), history.filter(moment < day)
