"""The named datasets a dashboard front end reads: name -> function of the dashboard frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.distribution import share_of_total
from . import ranking, rollup


def risk_shares(dashboard: DataFrame) -> DataFrame:
    grouped = rollup.risk_distribution(dashboard)
    return share_of_total(grouped, "num_stocks", "risk_category", "risk_label")


def action_shares(dashboard: DataFrame) -> DataFrame:
    grouped = rollup.action_distribution(dashboard)
    return share_of_total(grouped, "num_stocks", "recommendation", "action_label")


def best_ranked(dashboard: DataFrame) -> DataFrame:
    return ranking.top_ranked(ranking.stock_rankings(dashboard))


DATASETS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "portfolio_overview": rollup.portfolio_overview,
    "risk_distribution": risk_shares,
    "action_distribution": action_shares,
    "stock_performance": ranking.stock_performance,
    "portfolio_summary": rollup.portfolio_summary,
    "stock_rankings": best_ranked,
    "action_items": ranking.action_items,
    "top_earnings": ranking.top_earnings,
}


def dataset(name: str, dashboard: DataFrame) -> DataFrame:
    if name not in DATASETS:
        raise KeyError(f"unknown dataset {name!r}; known: {', '.join(DATASETS)}")
    return DATASETS[name](dashboard)
