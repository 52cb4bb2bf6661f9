"""Shares of a total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share_pct(df: DataFrame, count_col: str, digits: int = 1) -> Column:
    """Percentage of the grand total of a frame's column, as a decimal; the total is a scalar subquery."""
    total = df.agg(F.sum(count_col)).scalar()
    return F.round(F.col(count_col) * F.lit(100.0).cast("decimal(4,1)") / total, digits)


def share_of_total(
    df: DataFrame, count_col: str, label_col: str, label_as: str = "share_label", unit: str = "stocks"
) -> DataFrame:
    """Adds ``pct_of_portfolio`` and a text such as ``"Buy: 12 stocks (8.3%)"``."""
    share = share_pct(df, count_col)
    text = F.concat(
        F.col(label_col),
        F.lit(": "),
        F.col(count_col).cast("string"),
        F.lit(f" {unit} ("),
        share.cast("string"),
        F.lit("%)"),
    )
    return df.withColumns({"pct_of_portfolio": share.cast("double"), label_as: text})
