"""Derived metrics: each takes and returns Columns, so Catalyst fuses them into one projection.

Ratios that rules compare come in two forms where it matters: a rounded percentage for display and
the unrounded fraction for tests.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import exact_sum, half_up, percent, ratio


def profit_margin_pct(net_income: Column, sales: Column) -> Column:
    return percent(net_income, sales)


def equity_ratio_pct(common_equity: Column, assets: Column) -> Column:
    return percent(common_equity, assets)


def cash_flow_margin_pct(operating_cash_flow: Column, sales: Column) -> Column:
    return percent(operating_cash_flow, sales)


def total_debt(short_term: Column, long_term: Column) -> Column:
    """NULL when either part is unknown."""
    return short_term + long_term


def debt_to_equity(
    short_term: Column, long_term: Column, common_equity: Column, digits: int | None = 2
) -> Column:
    """Total debt over common equity; ``digits=None`` keeps the unrounded quotient."""
    value = ratio(total_debt(short_term, long_term), common_equity)
    return value if digits is None else half_up(value, digits)


def long_term_leverage(long_term: Column, common_equity: Column) -> Column:
    """Long-term debt over equity, only where both are positive."""
    return F.when((long_term > 0) & (common_equity > 0), long_term / common_equity)


def position_earnings(shares: Column, eps: Column, digits: int | None = 2) -> Column:
    """A holder's share of company earnings, for reported or estimated EPS."""
    value = shares * eps
    return value if digits is None else half_up(value, digits)


def earnings_increase(shares: Column, current_eps: Column, forward_eps: Column) -> Column:
    return half_up(shares * (forward_eps - current_eps))


def eps_growth(current_eps: Column, forward_eps: Column, base_guard: str = "nonzero") -> Column:
    """Growth as an unrounded fraction.

    ``base_guard="nonzero"`` divides by any base but zero, so a negative base flips the sign;
    ``"positive"`` yields NULL unless the base is above zero.
    """
    change = forward_eps - current_eps
    if base_guard == "nonzero":
        return ratio(change, current_eps)
    if base_guard == "positive":
        return F.when(current_eps > 0, change / current_eps)
    raise ValueError(f"base_guard must be 'nonzero' or 'positive', not {base_guard!r}")


def as_pct(fraction: Column, digits: int | None = 2) -> Column:
    value = fraction * F.lit(100.0)
    return value if digits is None else half_up(value, digits)


def estimate_spread(high: Column, low: Column, mean: Column) -> Column:
    """Width of the estimate range relative to its mean, as an unrounded fraction."""
    return ratio(high - low, mean)


def position_value(shares: Column, cost_basis: Column) -> Column:
    return shares * cost_basis


def portfolio_growth_pct(current: Column, projected: Column) -> Column:
    """Aggregate: growth of total projected over total current earnings."""
    now = exact_sum(current).cast("double")
    return percent(exact_sum(projected).cast("double") - now, now)


def performance_score(
    growth_pct: Column, margin_pct: Column, leverage: Column, analysts: Column
) -> Column:
    """Score out of 100: up to 30 for growth, 30 for margin, 20 for leverage, 20 for coverage.

    NULL analysts make the score NULL.
    """

    def capped(value: Column) -> Column:
        return F.when(value > 0, F.least(value, F.lit(30.0))).otherwise(F.lit(0.0))

    health = F.when(leverage < 2, 20).otherwise(10)
    coverage = F.when(analysts >= 10, 20).otherwise(analysts * 2)
    return half_up(capped(growth_pct) + capped(margin_pct) + health + coverage, 0)
