"""Symbol resolution: ticker -> security id -> company id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import coverage_status
from ..functions.symbols import normalize_symbol
from .skew import splittable


def with_ticker(
    holdings: DataFrame, symbol_col: str = "symbol", region: str | None = "US"
) -> DataFrame:
    return holdings.withColumn("ticker_region", normalize_symbol(F.col(symbol_col), region))


def securities(sym: DataFrame, sec_map: DataFrame) -> DataFrame:
    """Symbology joined to a security map: every ticker with its security and company id."""
    return sym.join(sec_map, "fsym_id").select("ticker_region", "fsym_id", "fsym_company_id")


def resolve(
    holdings: DataFrame,
    sym: DataFrame,
    sec_map: DataFrame,
    symbol_col: str = "symbol",
    region: str | None = "US",
    how: str = "inner",
) -> DataFrame:
    """Holdings with ``ticker_region``, ``fsym_id`` and ``fsym_company_id`` added.

    The two reference tables meet first, so the holdings, which may hold many lots of one symbol,
    are shuffled once. A left join keeps the security id of a symbol that has no company.
    """
    keys = sym.join(sec_map, "fsym_id", how).select("ticker_region", "fsym_id", "fsym_company_id")
    return with_ticker(holdings, symbol_col, region).join(keys, "ticker_region", how)


def coverage_check(
    holdings: DataFrame, sym: DataFrame, region: str | None = "US", emoji: bool = False
) -> DataFrame:
    """Each holding's symbol with its security id and whether one was found."""
    found = with_ticker(holdings.select("symbol"), region=region).join(sym, "ticker_region", "left")
    return found.select("symbol", "ticker_region", "fsym_id", coverage_status().column(emoji))


def symbology_lookup(
    sym: DataFrame,
    tickers: Sequence[str] | DataFrame,
    ticker_col: str = "ticker_region",
    limit: int | None = None,
) -> DataFrame:
    """Reference rows of the given tickers: a short list, or a frame with the same ticker column."""
    if isinstance(tickers, DataFrame):
        rows = sym.join(tickers.select(ticker_col).distinct(), ticker_col, "left_semi")
    else:
        rows = sym.filter(F.col(ticker_col).isin(list(tickers)))
    return rows if limit is None else rows.limit(limit)


def matched_symbols(
    holdings: DataFrame, sym: DataFrame, region: str | None = "US", limit: int | None = None
) -> DataFrame:
    """Holdings whose symbol exists in the symbology, as a plain join."""
    rows = (
        with_ticker(holdings, region=region)
        .join(sym, "ticker_region")
        .select("symbol", "ticker_region", "fsym_id")
    )
    return rows if limit is None else rows.limit(limit)


def known_tickers(coverage: DataFrame, holdings: DataFrame) -> DataFrame:
    """Reference tickers that are held (semi join: holdings never multiply them)."""
    held = holdings.select(F.col("ticker_symbol").alias("ticker")).distinct()
    return coverage.select("ticker").join(held, "ticker", "left_semi")


def unmatched_holdings(coverage: DataFrame, holdings: DataFrame) -> DataFrame:
    """Holdings without a reference row (anti join), one output row per holding."""
    known = splittable(coverage.select(F.col("ticker").alias("ticker_symbol")), "ticker_symbol")
    missing = holdings.select("ticker_symbol").join(known, "ticker_symbol", "left_anti")
    nothing = F.lit(None).cast("string")
    return missing.select(
        "ticker_symbol", nothing.alias("entity_id"), nothing.alias("proper_name")
    )


def held_tickers(holdings: DataFrame) -> DataFrame:
    return holdings.select("ticker_symbol").distinct()
