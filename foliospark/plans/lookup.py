"""Listings and lookups on holdings and reference tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.symbols import normalize_symbol, strip_region
from ..operators.resolve import securities
from ..operators.skew import splittable
from ..operators.temporal import latest_per_key


def mapping_chain(
    sym: DataFrame, sec_map: DataFrame, ticker: str | None = None, limit: int | None = None
) -> DataFrame:
    """Ticker -> security id -> company id, for one ticker or all of them."""
    if ticker is not None:
        sym = sym.filter(F.col("ticker_region") == ticker)
    rows = securities(sym, sec_map)
    return rows if limit is None else rows.limit(limit)


def holdings_by_size(
    holdings: DataFrame, instrument_type: str | None = "Equity", sort: bool = False
) -> DataFrame:
    """Holdings of one instrument type, largest first when sorted."""
    if instrument_type is not None:
        holdings = holdings.filter(F.col("instrument_type") == instrument_type)
    listed = holdings.select("instrument_type", "symbol", "number_of_shares")
    return listed.orderBy(F.desc("number_of_shares"), "symbol") if sort else listed


def security_history(
    sym: DataFrame,
    sec_map: DataFrame,
    facts: DataFrame,
    *,
    min_date: dt.date,
    ticker: str | None = None,
    k: int = 5,
    region: str = "US",
) -> DataFrame:
    """The k latest annual rows along the whole chain, per ticker.

    Companies are cut to their k latest rows before the join and tickers after it.
    """
    if ticker is not None:
        sym = sym.filter(F.col("ticker_region") == normalize_symbol(F.lit(ticker), region))
    values = ["FF_SALES", "FF_EPS_BASIC"]
    recent = facts.filter(F.col("DATE") >= F.lit(min_date)).select("fsym_id", "DATE", *values)
    recent = latest_per_key(recent, ["fsym_id"], "DATE", values, k)
    recent = recent.withColumnRenamed("fsym_id", "fsym_company_id")
    chain = securities(sym, sec_map).join(
        splittable(recent, "fsym_company_id"), "fsym_company_id"
    )
    ties = ["fsym_id", "fsym_company_id", *values]
    return latest_per_key(chain, ["ticker_region"], "DATE", ties, k).select(
        strip_region(F.col("ticker_region"), region).alias("portfolio_ticker"),
        F.col("ticker_region").alias("ticker_region_format"),
        F.col("fsym_id").alias("symbology_fsym_id"),
        F.col("fsym_company_id").alias("mapped_company_id"),
        F.col("DATE").alias("fiscal_date"),
        F.col("FF_SALES").alias("revenue"),
        F.col("FF_EPS_BASIC").alias("eps"),
    )
