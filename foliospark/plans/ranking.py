"""Listings, action items, scores and tiers derived from the dashboard.

Functions that feed published tables return unsorted frames; ``sort=True`` gives the reading order,
with the symbol as last key. Top-k reports sort and limit in one step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import rules as R

LISTING = (
    "symbol",
    "shares_held",
    "my_current_annual_earnings",
    "my_projected_annual_earnings",
    "projected_eps_growth_pct",
    "profit_margin_pct",
    "debt_to_equity_ratio",
    "num_analysts_covering",
    "risk_assessment",
    "action_recommendation",
)


def _largest_first(column: str) -> list[Column]:
    return [F.col(column).desc_nulls_last(), F.col("symbol").asc()]


def _sorted(df: DataFrame, sort: bool, *order: Column) -> DataFrame:
    return df.orderBy(*order) if sort else df


def dashboard_listing(dashboard: DataFrame, sort: bool = False) -> DataFrame:
    """The ten columns of the stock-by-stock table, largest current earnings first."""
    return _sorted(dashboard.select(*LISTING), sort, *_largest_first("my_current_annual_earnings"))


def growth_opportunities(
    dashboard: DataFrame, min_growth_pct: float = 10, sort: bool = False
) -> DataFrame:
    growing = dashboard.filter(F.col("projected_eps_growth_pct") > min_growth_pct).select(
        "symbol",
        "shares_held",
        "projected_eps_growth_pct",
        "my_expected_earnings_increase",
        "profit_margin_pct",
        "risk_assessment",
        "action_recommendation",
    )
    return _sorted(growing, sort, *_largest_first("projected_eps_growth_pct"))


def risk_alerts(dashboard: DataFrame, sort: bool = False) -> DataFrame:
    alarming = F.col("risk_assessment").contains("High") | F.col("action_recommendation").contains(
        "SELL"
    )
    alerts = dashboard.filter(alarming).select(
        "symbol",
        "shares_held",
        "my_current_annual_earnings",
        "projected_eps_growth_pct",
        "profit_margin_pct",
        "debt_to_equity_ratio",
        "risk_assessment",
        "action_recommendation",
    )
    return _sorted(alerts, sort, *_largest_first("my_current_annual_earnings"))


def quality_stocks(
    dashboard: DataFrame, min_margin_pct: float = 15, max_leverage: float = 1.5, sort: bool = False
) -> DataFrame:
    sound = (F.col("profit_margin_pct") > min_margin_pct) & (
        F.col("debt_to_equity_ratio") < max_leverage
    )
    stocks = dashboard.filter(sound).select(
        "symbol",
        "profit_margin_pct",
        "debt_to_equity_ratio",
        "projected_eps_growth_pct",
        "my_current_annual_earnings",
        "risk_assessment",
    )
    return _sorted(stocks, sort, *_largest_first("profit_margin_pct"))


def _label_inputs(dashboard: DataFrame) -> DataFrame:
    return dashboard.withColumns(
        {
            "risk": F.col("risk_assessment"),
            "action": F.col("action_recommendation"),
            "growth_pct": F.col("projected_eps_growth_pct"),
        }
    )


def _pressing(min_growth_pct: float) -> Column:
    risk, action = F.col("risk_assessment"), F.col("action_recommendation")
    return (
        action.contains("SELL")
        | action.contains("STRONG BUY")
        | risk.contains("High")
        | (F.col("projected_eps_growth_pct") > min_growth_pct)
    )


def action_items(
    dashboard: DataFrame, min_growth_pct: float = 20, emoji: bool = False, with_rank: bool = False
) -> DataFrame:
    """Positions that call for action, with a priority label.

    ``with_rank`` adds ``priority_rank``, the coarser key that readers sort the list by.
    """
    extra = [R.priority_rank().column()] if with_rank else []
    return _label_inputs(dashboard.filter(_pressing(min_growth_pct))).select(
        *LISTING, R.priority_action().column(emoji), *extra
    )


def by_priority(items: DataFrame) -> DataFrame:
    """Action items in reading order; needs ``priority_rank``."""
    return items.orderBy(F.col("priority_rank"), *_largest_first("my_current_annual_earnings"))


def _score() -> Column:
    return M.performance_score(
        F.col("projected_eps_growth_pct"),
        F.col("profit_margin_pct"),
        F.col("debt_to_equity_ratio"),
        F.col("num_analysts_covering"),
    )


def stock_rankings(dashboard: DataFrame) -> DataFrame:
    """Each position with its score out of 100."""
    return dashboard.select(
        "symbol",
        "shares_held",
        F.col("my_current_annual_earnings").alias("annual_earnings_contribution"),
        F.col("projected_eps_growth_pct").alias("growth_rate"),
        "profit_margin_pct",
        "debt_to_equity_ratio",
        "num_analysts_covering",
        _score().alias("performance_score"),
        "risk_assessment",
        "action_recommendation",
    )


def top_ranked(rankings: DataFrame, k: int = 15) -> DataFrame:
    """The k best scores; equal scores go to the larger earnings, then by symbol."""
    return rankings.orderBy(
        F.col("performance_score").desc_nulls_last(),
        *_largest_first("annual_earnings_contribution"),
    ).limit(k)


def stock_performance(dashboard: DataFrame, emoji: bool = False) -> DataFrame:
    """Each position with its performance tier; unknown growth falls in the lowest tier."""
    return _label_inputs(dashboard).select(
        "symbol",
        "shares_held",
        "my_current_annual_earnings",
        "my_projected_annual_earnings",
        "projected_eps_growth_pct",
        "profit_margin_pct",
        R.performance_tier().column(emoji),
    )


def position_labels(dashboard: DataFrame, min_growth_pct: float = 20, emoji: bool = False) -> DataFrame:
    """Each position with its tier and, where it calls for action, its risk, action and priority labels."""
    pressing = _pressing(min_growth_pct)
    return _label_inputs(dashboard).select(
        "symbol",
        R.performance_tier().column(emoji),
        F.when(pressing, F.col("risk_assessment")).alias("risk_assessment"),
        F.when(pressing, F.col("action_recommendation")).alias("action_recommendation"),
        F.when(pressing, R.priority_action().column(emoji)).alias("priority_action"),
    )


def earnings_waterfall(dashboard: DataFrame) -> DataFrame:
    return dashboard.select("symbol", "my_current_annual_earnings", "my_projected_annual_earnings")


def performance_summary(
    dashboard: DataFrame, rankings: DataFrame | None = None, sort: bool = False
) -> DataFrame:
    """Earnings, growth, labels and score of each position.

    With ``rankings`` the score comes from that published table by symbol, without it from the same
    row. A score depends on the symbol alone, so the rankings shrink to one row per symbol and score
    first: several lots of a symbol each get their score once and never pair up with each other.
    """
    if rankings is None:
        scored = dashboard.withColumn("performance_score", _score())
    else:
        scores = rankings.select("symbol", "performance_score").distinct()
        scored = dashboard.join(scores, "symbol")
    summary = scored.select(
        "symbol",
        F.col("my_current_annual_earnings").alias("current_earnings"),
        F.col("my_projected_annual_earnings").alias("projected_earnings"),
        F.col("projected_eps_growth_pct").alias("growth_rate"),
        "risk_assessment",
        "action_recommendation",
        "performance_score",
    )
    return _sorted(summary, sort, *_largest_first("performance_score"))


def top_earnings(dashboard: DataFrame, k: int = 10) -> DataFrame:
    """The k positions with the largest known current earnings."""
    known = dashboard.filter(F.col("my_current_annual_earnings").isNotNull())
    return (
        known.orderBy(*_largest_first("my_current_annual_earnings"))
        .limit(k)
        .select(
            "symbol",
            F.col("my_current_annual_earnings").alias("current_earnings"),
            F.col("my_projected_annual_earnings").alias("projected_earnings"),
        )
    )
