"""Portfolio-level rollups. All are one-pass aggregates with partial sums before the shuffle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import rules as R
from ..functions.numeric import (
    count_if,
    exact_sum,
    half_up,
    money_sum,
    ratio,
    rounded_avg,
    sum_if,
    weighted_avg,
)
from .enrich import positions, ticker_profile


def portfolio_risk_summary(
    holdings: DataFrame,
    sym: DataFrame,
    ff_map: DataFrame,
    ff: DataFrame,
    fe_map: DataFrame,
    fe: DataFrame,
    *,
    as_of: dt.date,
    min_date: dt.date,
    portfolio_name: str = "My Portfolio",
    instrument_type: str = "Equity",
    region: str | None = "US",
    rules: R.RuleSet | None = None,
    emoji: bool = False,
) -> DataFrame:
    """One row of totals, averages, risk counts and an overall rating.

    Leverage is tested unrounded here, growth and margin as rounded percentages. Shares and lots are
    added up per symbol before the join, which then meets one row per symbol, however many lots a
    symbol has; counts and averages weigh by lots.
    """
    profile = ticker_profile(
        sym, ff_map, ff, fe_map, fe, as_of=as_of, min_date=min_date, per="company"
    )
    held = positions(holdings, instrument_type, region)
    held = held.groupBy("symbol", "ticker_region").agg(
        exact_sum(F.col("shares_held")).alias("shares_held"), F.count("*").alias("lots")
    )
    shares, lots = F.col("shares_held"), F.col("lots")
    rows = held.join(profile, "ticker_region").withColumns(
        {
            "now": M.position_earnings(shares, F.col("current_eps"), None),
            "ahead": M.position_earnings(shares, F.col("forward_eps"), None),
        }
    )
    growth, margin = F.col("growth_pct"), F.col("profit_margin_pct")
    leverage, income = F.col("debt_to_equity_exact"), F.col("net_income")
    at_risk = (income < 0) | (growth < -10)
    totals = rows.agg(
        F.count_distinct("symbol").alias("total_holdings"),
        money_sum(F.col("now")).alias("total_current_annual_earnings"),
        money_sum(F.col("ahead")).alias("total_projected_annual_earnings"),
        M.portfolio_growth_pct(F.col("now"), F.col("ahead")).alias("portfolio_growth_rate_pct"),
        weighted_avg(growth, lots).alias("mean_growth_pct"),
        weighted_avg(margin, lots).alias("mean_margin_pct"),
        half_up(weighted_avg(leverage, lots)).alias("avg_debt_to_equity"),
        count_if(income < 0, lots).alias("unprofitable_companies"),
        count_if(leverage > 2.5, lots).alias("high_leverage_companies"),
        count_if(growth < -10, lots).alias("declining_earnings_companies"),
        count_if(F.col("operating_cash_flow") < 0, lots).alias("negative_cash_flow_companies"),
        count_if(growth > 20, lots).alias("high_growth_stocks"),
        count_if((margin > 15) & (leverage < 1.5), lots).alias("quality_stocks"),
        ratio(
            sum_if(at_risk, shares).cast("double"), exact_sum(shares).cast("double")
        ).alias("at_risk_weight"),
    )
    return totals.select(
        F.lit(portfolio_name).alias("portfolio_name"),
        "total_holdings",
        "total_current_annual_earnings",
        "total_projected_annual_earnings",
        "portfolio_growth_rate_pct",
        half_up(F.col("mean_growth_pct")).alias("avg_eps_growth_pct"),
        half_up(F.col("mean_margin_pct")).alias("avg_profit_margin_pct"),
        "avg_debt_to_equity",
        "unprofitable_companies",
        "high_leverage_companies",
        "declining_earnings_companies",
        "negative_cash_flow_companies",
        "high_growth_stocks",
        "quality_stocks",
        (rules or R.portfolio_health_rating()).column(emoji),
    )


def _averages(growth: str, margin: str, leverage: str) -> list[Column]:
    return [
        rounded_avg(F.col("projected_eps_growth_pct")).alias(growth),
        rounded_avg(F.col("profit_margin_pct")).alias(margin),
        rounded_avg(F.col("debt_to_equity_ratio")).alias(leverage),
    ]


def _flags(risky: str, sell: str, buy: str) -> list[Column]:
    """``buy`` counts strong buys as well: the label contains the word."""
    risk, action = F.col("risk_assessment"), F.col("action_recommendation")
    return [
        count_if(risk.contains("High")).alias(risky),
        count_if(action.contains("SELL")).alias(sell),
        count_if(action.contains("BUY")).alias(buy),
    ]


def dashboard_metrics(dashboard: DataFrame) -> DataFrame:
    """Headline numbers of the dashboard; counts positions, not distinct symbols."""
    return dashboard.agg(
        F.count("symbol").alias("total_positions"),
        money_sum(F.col("my_current_annual_earnings")).alias("total_current_annual_earnings"),
        money_sum(F.col("my_projected_annual_earnings")).alias("total_projected_annual_earnings"),
        *_averages("avg_growth_rate", "avg_profit_margin", "avg_debt_to_equity"),
        *_flags("high_risk_stocks", "sell_recommendations", "buy_opportunities"),
    )


def portfolio_summary(dashboard: DataFrame, portfolio_name: str = "My Portfolio") -> DataFrame:
    """The published summary; ``publish_table`` adds ``last_updated``."""
    totals = dashboard.agg(
        F.count_distinct("symbol").alias("total_holdings"),
        money_sum(F.col("my_current_annual_earnings")).alias("total_current_earnings"),
        money_sum(F.col("my_projected_annual_earnings")).alias("total_projected_earnings"),
        *_averages("avg_growth_rate", "avg_profit_margin", "avg_debt_to_equity"),
        *_flags("high_risk_stocks", "stocks_to_sell", "buying_opportunities"),
        count_if(F.col("projected_eps_growth_pct") > 20).alias("high_growth_stocks"),
    )
    return totals.select(F.lit(portfolio_name).alias("portfolio_name"), "*")


def portfolio_overview(dashboard: DataFrame, metric_category: str = "Portfolio Health") -> DataFrame:
    now, ahead = F.col("my_current_annual_earnings"), F.col("my_projected_annual_earnings")
    totals = dashboard.agg(
        F.count_distinct("symbol").alias("total_stocks"),
        money_sum(now).alias("total_annual_earnings"),
        money_sum(ahead).alias("projected_annual_earnings"),
        M.portfolio_growth_pct(now, ahead).alias("portfolio_growth_pct"),
        rounded_avg(F.col("profit_margin_pct")).alias("avg_profit_margin"),
        rounded_avg(F.col("debt_to_equity_ratio")).alias("avg_leverage"),
    )
    return totals.select(F.lit(metric_category).alias("metric_category"), "*")


def _distribution(
    dashboard: DataFrame, label: Column, name: str, earnings: str, growth: str
) -> DataFrame:
    return (
        dashboard.withColumns(
            {"risk": F.col("risk_assessment"), "action": F.col("action_recommendation")}
        )
        .withColumn(name, label)
        .groupBy(name)
        .agg(
            F.count("*").alias("num_stocks"),
            money_sum(F.col("my_current_annual_earnings")).alias(earnings),
            rounded_avg(F.col("projected_eps_growth_pct")).alias(growth),
        )
    )


def risk_distribution(dashboard: DataFrame) -> DataFrame:
    """Positions, earnings and growth per risk category, high risk first."""
    grouped = _distribution(
        dashboard, R.risk_category().column(), "risk_category", "total_earnings", "avg_growth_rate"
    )
    return grouped.orderBy(R.display_rank(F.col("risk_category"), R.RISK_ORDER))


def action_distribution(dashboard: DataFrame) -> DataFrame:
    """Positions, earnings and growth per recommendation, from sell to strong buy."""
    grouped = _distribution(
        dashboard,
        R.recommendation_group().column(),
        "recommendation",
        "current_earnings_impact",
        "avg_expected_growth",
    )
    return grouped.orderBy(R.display_rank(F.col("recommendation"), R.RECOMMENDATION_ORDER))
