"""Ordered-rule classifiers.

A rule set is data: SQL conditions over agreed input columns, tried in order, first match wins. A
comparison with NULL never matches, so an unknown input falls through to the default label (or to
``unknown_label`` when the caller gives one). Thresholds are keyword arguments of the builders.

Input columns: ``net_income``, ``debt_to_equity``, ``profit_margin_pct``, ``growth`` (unrounded
fraction), ``growth_pct`` (rounded percentage), ``analysts``, ``spread`` (unrounded fraction),
``eps_mean``, ``risk`` and ``action`` (labels given by earlier rule sets).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def classify(
    rules: Iterable[tuple[Column | str, object]],
    default: object,
    unknown_label: object | None = None,
    inputs: Iterable[str] = (),
) -> Column:
    """First matching label, as one CASE expression.

    With ``unknown_label``, rows that match nothing and miss any of ``inputs`` get that label
    instead of the default.
    """
    branches = [(F.expr(c) if isinstance(c, str) else c, label) for c, label in rules]
    inputs = list(inputs)
    if unknown_label is not None and inputs:
        missing = reduce(Column.__or__, [F.col(name).isNull() for name in inputs])
        branches.append((missing, unknown_label))
    if not branches:
        return F.lit(default)
    (first, label), *rest = branches
    case = F.when(first, F.lit(label))
    for condition, label in rest:
        case = case.when(condition, F.lit(label))
    return case.otherwise(F.lit(default))


@dataclass(frozen=True)
class RuleSet:
    """Named classifier: ``column()`` builds the label column over the agreed input names."""

    output: str
    inputs: tuple[str, ...]
    rules: tuple[tuple[str, object], ...]
    default: object
    marks: dict[object, str] = field(default_factory=dict)

    @property
    def labels(self) -> list[object]:
        found = [label for _, label in self.rules] + [self.default]
        return list(dict.fromkeys(found))

    def column(self, emoji: bool = False, unknown_label: str | None = None) -> Column:
        def shown(label: object) -> object:
            return f"{self.marks[label]} {label}" if emoji and label in self.marks else label

        return classify(
            [(condition, shown(label)) for condition, label in self.rules],
            shown(self.default),
            unknown_label,
            self.inputs,
        ).alias(self.output)


# Labels and their emoji marks.
RED, YELLOW, GREEN, WHITE = "🔴", "🟡", "🟢", "⚪"
WARN, CHECK, CROSS, MONEY_BAG, PAUSE = "⚠️", "✅", "❌", "💰", "⏸️"
ROCKET, RISING, LEVEL, FALLING = "🚀", "📈", "➡️", "📉"


def coverage_status() -> RuleSet:
    return RuleSet(
        output="status",
        inputs=(),
        rules=(("fsym_id is not null", "FOUND"),),
        default="NOT FOUND",
        marks={"FOUND": CHECK, "NOT FOUND": CROSS},
    )


def financial_health(
    high_debt: float = 2.5, thin_margin: float = 5, strong_margin: float = 15, safe_debt: float = 1.5
) -> RuleSet:
    return RuleSet(
        output="financial_health",
        inputs=("net_income", "debt_to_equity", "profit_margin_pct"),
        rules=(
            ("net_income < 0", "Unprofitable"),
            (f"debt_to_equity > {high_debt}", "High Leverage Risk"),
            (f"profit_margin_pct < {thin_margin}", "Low Margin"),
            (f"profit_margin_pct > {strong_margin} and debt_to_equity < {safe_debt}", "Strong"),
        ),
        default="Healthy",
    )


def analyst_signal(min_analysts: int = 3, wide_spread: float = 0.5) -> RuleSet:
    return RuleSet(
        output="analyst_signal",
        inputs=("analysts", "spread", "eps_mean"),
        rules=(
            (f"analysts < {min_analysts}", "Low Coverage - Limited Data"),
            (f"spread > {wide_spread}", "High Uncertainty - Divergent Views"),
            ("eps_mean > 0", "Positive Outlook - Profitable Expected"),
        ),
        default="Negative Outlook - Losses Expected",
    )


def investment_recommendation(
    high_debt: float = 2.5,
    decline: float = -0.15,
    strong: float = 0.20,
    positive: float = 0.05,
    flat: float = -0.10,
) -> RuleSet:
    return RuleSet(
        output="investment_recommendation",
        inputs=("net_income", "debt_to_equity", "growth"),
        rules=(
            ("net_income < 0", "SELL - Company Unprofitable"),
            (f"debt_to_equity > {high_debt}", "SELL - Excessive Leverage Risk"),
            (f"growth < {decline}", "SELL - Declining Earnings Expected"),
            (f"growth > {strong}", "STRONG BUY - High Growth Expected"),
            (f"growth > {positive}", "BUY - Positive Growth Expected"),
            (f"growth > {flat}", "HOLD - Flat Growth"),
        ),
        default="HOLD - Monitor Closely",
    )


def risk_level(high_debt: float = 2.5, thin_margin: float = 3, raised_debt: float = 1.5) -> RuleSet:
    return RuleSet(
        output="risk_level",
        inputs=("net_income", "debt_to_equity", "profit_margin_pct"),
        rules=(
            ("net_income < 0", "High Risk"),
            (f"debt_to_equity > {high_debt}", "High Risk"),
            (f"profit_margin_pct < {thin_margin}", "Medium Risk"),
            (f"debt_to_equity > {raised_debt}", "Medium Risk"),
        ),
        default="Low Risk",
    )


def portfolio_health_rating(
    high_weight: float = 0.30, medium_weight: float = 0.15, growth: float = 10, margin: float = 10
) -> RuleSet:
    """Over aggregates: ``at_risk_weight``, ``mean_growth_pct`` and ``mean_margin_pct``."""
    return RuleSet(
        output="portfolio_health_rating",
        inputs=("at_risk_weight", "mean_growth_pct", "mean_margin_pct"),
        rules=(
            (f"at_risk_weight > {high_weight}", "HIGH RISK - Consider Rebalancing"),
            (f"at_risk_weight > {medium_weight}", "MEDIUM RISK - Monitor Closely"),
            (
                f"mean_growth_pct > {growth} and mean_margin_pct > {margin}",
                "EXCELLENT - Strong Growth Portfolio",
            ),
        ),
        default="HEALTHY - Well Positioned",
        marks={
            "HIGH RISK - Consider Rebalancing": WARN,
            "MEDIUM RISK - Monitor Closely": WARN,
            "EXCELLENT - Strong Growth Portfolio": CHECK,
            "HEALTHY - Well Positioned": CHECK,
        },
    )


def risk_assessment(
    high_debt: float = 2.5,
    decline: float = -0.15,
    thin_margin: float = 3,
    strong_margin: float = 15,
    safe_debt: float = 1.5,
) -> RuleSet:
    return RuleSet(
        output="risk_assessment",
        inputs=("net_income", "debt_to_equity", "growth", "profit_margin_pct"),
        rules=(
            ("net_income < 0", "High Risk - Unprofitable"),
            (f"debt_to_equity > {high_debt}", "High Risk - Excessive Debt"),
            (f"growth < {decline}", "Medium Risk - Declining Earnings"),
            (f"profit_margin_pct < {thin_margin}", "Medium Risk - Low Margins"),
            (
                f"profit_margin_pct > {strong_margin} and debt_to_equity < {safe_debt}",
                "Low Risk - Strong Fundamentals",
            ),
        ),
        default="Low Risk",
        marks={
            "High Risk - Unprofitable": RED,
            "High Risk - Excessive Debt": RED,
            "Medium Risk - Declining Earnings": YELLOW,
            "Medium Risk - Low Margins": YELLOW,
            "Low Risk - Strong Fundamentals": GREEN,
            "Low Risk": GREEN,
        },
    )


def action_recommendation(
    decline: float = -0.15, strong: float = 0.20, positive: float = 0.05, flat: float = -0.10
) -> RuleSet:
    """Leverage plays no part here, unlike in ``investment_recommendation``."""
    return RuleSet(
        output="action_recommendation",
        inputs=("net_income", "growth"),
        rules=(
            ("net_income < 0", "SELL - Company Losing Money"),
            (f"growth < {decline}", "SELL - Earnings Declining"),
            (f"growth > {strong}", "STRONG BUY - High Growth Expected"),
            (f"growth > {positive}", "BUY - Positive Growth"),
            (f"growth > {flat}", "HOLD - Stable"),
        ),
        default="HOLD - Monitor",
        marks={
            "SELL - Company Losing Money": CROSS,
            "SELL - Earnings Declining": CROSS,
            "STRONG BUY - High Growth Expected": MONEY_BAG,
            "BUY - Positive Growth": CHECK,
            "HOLD - Stable": PAUSE,
            "HOLD - Monitor": WARN,
        },
    )


def priority_action(growth_pct: float = 25) -> RuleSet:
    return RuleSet(
        output="priority_action",
        inputs=("action", "risk", "growth_pct"),
        rules=(
            ("action like '%SELL%'", "URGENT - Consider Selling"),
            ("risk like '%High%'", "REVIEW - High Risk"),
            (f"growth_pct > {growth_pct}", "OPPORTUNITY - Strong Growth"),
            ("action like '%STRONG BUY%'", "OPPORTUNITY - Consider Buying More"),
        ),
        default="MONITOR - Stable",
        marks={
            "URGENT - Consider Selling": RED,
            "REVIEW - High Risk": YELLOW,
            "OPPORTUNITY - Strong Growth": GREEN,
            "OPPORTUNITY - Consider Buying More": MONEY_BAG,
            "MONITOR - Stable": WHITE,
        },
    )


def priority_rank(growth_pct: float = 25) -> RuleSet:
    """Sort key of the action list; coarser than ``priority_action``."""
    return RuleSet(
        output="priority_rank",
        inputs=("action", "risk", "growth_pct"),
        rules=(
            ("action like '%SELL%'", 1),
            ("risk like '%High%'", 2),
            (f"growth_pct > {growth_pct}", 3),
        ),
        default=4,
    )


def risk_category() -> RuleSet:
    return RuleSet(
        output="risk_category",
        inputs=("risk",),
        rules=(("risk like '%High%'", "High Risk"), ("risk like '%Medium%'", "Medium Risk")),
        default="Low Risk",
    )


def recommendation_group() -> RuleSet:
    return RuleSet(
        output="recommendation",
        inputs=("action",),
        rules=(
            ("action like '%STRONG BUY%'", "Strong Buy"),
            ("action like '%BUY%'", "Buy"),
            ("action like '%SELL%'", "Sell"),
        ),
        default="Hold",
    )


def performance_tier(top: float = 15, above: float = 5, stable: float = -5) -> RuleSet:
    return RuleSet(
        output="performance_tier",
        inputs=("growth_pct",),
        rules=(
            (f"growth_pct > {top}", "Top Performer"),
            (f"growth_pct > {above}", "Above Average"),
            (f"growth_pct > {stable}", "Stable"),
        ),
        default="Underperformer",
        marks={
            "Top Performer": ROCKET,
            "Above Average": RISING,
            "Stable": LEVEL,
            "Underperformer": FALLING,
        },
    )


def leverage_risk(high: float = 2.0, medium: float = 1.0) -> RuleSet:
    return RuleSet(
        output="risk_assessment",
        inputs=("debt_to_equity",),
        rules=((f"debt_to_equity > {high}", "High Risk"), (f"debt_to_equity > {medium}", "Medium Risk")),
        default="Low Risk",
    )


def growth_and_leverage_action(
    strong: float = 15, more: float = 10, sell: float = -10, safe_debt: float = 1.0, high_debt: float = 2.0
) -> RuleSet:
    return RuleSet(
        output="action_recommendation",
        inputs=("growth_pct", "debt_to_equity"),
        rules=(
            (f"growth_pct > {strong} and debt_to_equity < {safe_debt}", "Strong Buy"),
            (f"growth_pct > {more}", "Buy More"),
            (f"growth_pct < {sell}", "Consider Selling"),
            (f"debt_to_equity > {high_debt}", "Review - High Debt"),
        ),
        default="Hold",
    )


def growth_recommendation(strong: float = 0.15, buy: float = 0.05, hold: float = -0.05) -> RuleSet:
    return RuleSet(
        output="recommendation",
        inputs=("growth",),
        rules=((f"growth > {strong}", "Strong Buy"), (f"growth > {buy}", "Buy"), (f"growth > {hold}", "Hold")),
        default="Sell",
    )


RULE_SETS: dict[str, Callable[..., RuleSet]] = {
    "coverage_status": coverage_status,
    "financial_health": financial_health,
    "analyst_signal": analyst_signal,
    "investment_recommendation": investment_recommendation,
    "risk_level": risk_level,
    "portfolio_health_rating": portfolio_health_rating,
    "risk_assessment": risk_assessment,
    "action_recommendation": action_recommendation,
    "priority_action": priority_action,
    "priority_rank": priority_rank,
    "risk_category": risk_category,
    "recommendation_group": recommendation_group,
    "performance_tier": performance_tier,
    "leverage_risk": leverage_risk,
    "growth_and_leverage_action": growth_and_leverage_action,
    "growth_recommendation": growth_recommendation,
}

# Display order of the grouped labels.
RISK_ORDER = ("High Risk", "Medium Risk", "Low Risk")
RECOMMENDATION_ORDER = ("Sell", "Hold", "Buy", "Strong Buy")


def display_rank(label: Column, order: tuple[str, ...]) -> Column:
    """Position of a label in a display order; labels outside it come last."""
    return classify([(label == name, place) for place, name in enumerate(order, 1)], len(order) + 1)
