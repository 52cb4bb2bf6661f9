"""Ticker normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_symbol(symbol: Column, region: str | None = "US") -> Column:
    """Upper-case a ticker and give it a region suffix unless it already carries that suffix.

    ``region=None`` only upper-cases, for holdings that store the full ticker already.
    """
    upper = F.upper(symbol)
    if region is None:
        return upper
    suffix = f"-{region.upper()}"
    return F.when(upper.endswith(suffix), upper).otherwise(F.concat(upper, F.lit(suffix)))


def strip_region(ticker_region: Column, region: str = "US") -> Column:
    """The ticker without its region suffix."""
    return F.regexp_replace(ticker_region, f"-{region.upper()}$", "")
