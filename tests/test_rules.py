"""Every branch of every rule set, with NULLs and values exactly at each threshold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from foliospark.functions import rules as R

NUMBERS = (
    "net_income debt_to_equity profit_margin_pct growth growth_pct analysts spread eps_mean"
    " at_risk_weight mean_growth_pct mean_margin_pct"
).split()
TEXTS = ["risk", "action", "fsym_id"]

CASES = {
    "coverage_status": [({"fsym_id": "x"}, "FOUND"), ({}, "NOT FOUND")],
    "financial_health": [
        ({"net_income": -1, "debt_to_equity": 9}, "Unprofitable"),
        ({"net_income": 0, "debt_to_equity": 2.51, "profit_margin_pct": 1}, "High Leverage Risk"),
        ({"net_income": 1, "debt_to_equity": 2.5, "profit_margin_pct": 4.99}, "Low Margin"),
        ({"net_income": 1, "debt_to_equity": 1.49, "profit_margin_pct": 15.01}, "Strong"),
        ({"net_income": 1, "debt_to_equity": 1.5, "profit_margin_pct": 16}, "Healthy"),
        ({"net_income": 1, "debt_to_equity": 1, "profit_margin_pct": 15}, "Healthy"),
        ({"net_income": 1, "debt_to_equity": 1, "profit_margin_pct": 5}, "Healthy"),
        ({}, "Healthy"),
    ],
    "analyst_signal": [
        ({"analysts": 2, "spread": 9, "eps_mean": 1}, "Low Coverage - Limited Data"),
        ({"analysts": 3, "spread": 0.51, "eps_mean": 1}, "High Uncertainty - Divergent Views"),
        ({"analysts": 3, "spread": 0.5, "eps_mean": 1}, "Positive Outlook - Profitable Expected"),
        ({"analysts": 3, "spread": 0.5, "eps_mean": 0}, "Negative Outlook - Losses Expected"),
        ({}, "Negative Outlook - Losses Expected"),
    ],
    "investment_recommendation": [
        ({"net_income": -1}, "SELL - Company Unprofitable"),
        ({"net_income": 1, "debt_to_equity": 2.51, "growth": 1}, "SELL - Excessive Leverage Risk"),
        ({"growth": -0.151}, "SELL - Declining Earnings Expected"),
        ({"growth": -0.15}, "HOLD - Monitor Closely"),
        ({"growth": 0.201}, "STRONG BUY - High Growth Expected"),
        ({"growth": 0.20}, "BUY - Positive Growth Expected"),
        ({"growth": 0.05}, "HOLD - Flat Growth"),
        ({"growth": -0.10}, "HOLD - Monitor Closely"),
        ({}, "HOLD - Monitor Closely"),
    ],
    "risk_level": [
        ({"net_income": -1}, "High Risk"),
        ({"debt_to_equity": 2.51}, "High Risk"),
        ({"debt_to_equity": 2.5}, "Medium Risk"),
        ({"profit_margin_pct": 2.99}, "Medium Risk"),
        ({"profit_margin_pct": 3, "debt_to_equity": 1.5}, "Low Risk"),
        ({"debt_to_equity": 1.51}, "Medium Risk"),
        ({}, "Low Risk"),
    ],
    "portfolio_health_rating": [
        ({"at_risk_weight": 0.31}, "HIGH RISK - Consider Rebalancing"),
        ({"at_risk_weight": 0.30}, "MEDIUM RISK - Monitor Closely"),
        (
            {"at_risk_weight": 0.15, "mean_growth_pct": 10.1, "mean_margin_pct": 10.1},
            "EXCELLENT - Strong Growth Portfolio",
        ),
        (
            {"at_risk_weight": 0.15, "mean_growth_pct": 10, "mean_margin_pct": 11},
            "HEALTHY - Well Positioned",
        ),
        ({}, "HEALTHY - Well Positioned"),
    ],
    "risk_assessment": [
        ({"net_income": -1}, "High Risk - Unprofitable"),
        ({"debt_to_equity": 2.51}, "High Risk - Excessive Debt"),
        ({"growth": -0.151}, "Medium Risk - Declining Earnings"),
        ({"growth": -0.15, "profit_margin_pct": 2.99}, "Medium Risk - Low Margins"),
        ({"profit_margin_pct": 15.01, "debt_to_equity": 1.49}, "Low Risk - Strong Fundamentals"),
        ({"profit_margin_pct": 15, "debt_to_equity": 1}, "Low Risk"),
        ({"profit_margin_pct": 16, "debt_to_equity": 2.5}, "Low Risk"),
        ({"profit_margin_pct": 3}, "Low Risk"),
        ({}, "Low Risk"),
    ],
    "action_recommendation": [
        ({"net_income": -1, "growth": 1}, "SELL - Company Losing Money"),
        ({"growth": -0.151}, "SELL - Earnings Declining"),
        ({"growth": 0.201}, "STRONG BUY - High Growth Expected"),
        ({"growth": 0.2}, "BUY - Positive Growth"),
        ({"growth": 0.05}, "HOLD - Stable"),
        ({"growth": -0.10}, "HOLD - Monitor"),
        ({"debt_to_equity": 99}, "HOLD - Monitor"),
        ({}, "HOLD - Monitor"),
    ],
    "priority_action": [
        ({"action": "SELL - x", "risk": "High Risk"}, "URGENT - Consider Selling"),
        ({"action": "HOLD", "risk": "High Risk", "growth_pct": 99}, "REVIEW - High Risk"),
        ({"action": "STRONG BUY", "risk": "Low", "growth_pct": 25.1}, "OPPORTUNITY - Strong Growth"),
        (
            {"action": "STRONG BUY", "risk": "Low", "growth_pct": 25},
            "OPPORTUNITY - Consider Buying More",
        ),
        ({"action": "BUY", "risk": "Low", "growth_pct": 10}, "MONITOR - Stable"),
        ({}, "MONITOR - Stable"),
    ],
    "priority_rank": [
        ({"action": "SELL - x"}, 1),
        ({"risk": "High Risk"}, 2),
        ({"growth_pct": 25.1}, 3),
        ({"action": "STRONG BUY", "growth_pct": 25}, 4),
        ({}, 4),
    ],
    "risk_category": [
        ({"risk": "🔴 High Risk - x"}, "High Risk"),
        ({"risk": "Medium Risk - x"}, "Medium Risk"),
        ({"risk": "Low Risk"}, "Low Risk"),
        ({}, "Low Risk"),
    ],
    "recommendation_group": [
        ({"action": "💰 STRONG BUY - x"}, "Strong Buy"),
        ({"action": "BUY - x"}, "Buy"),
        ({"action": "SELL - x"}, "Sell"),
        ({"action": "HOLD - x"}, "Hold"),
        ({}, "Hold"),
    ],
    "performance_tier": [
        ({"growth_pct": 15.1}, "Top Performer"),
        ({"growth_pct": 15}, "Above Average"),
        ({"growth_pct": 5}, "Stable"),
        ({"growth_pct": -4.99}, "Stable"),
        ({"growth_pct": -5}, "Underperformer"),
        ({}, "Underperformer"),
    ],
    "leverage_risk": [
        ({"debt_to_equity": 2.01}, "High Risk"),
        ({"debt_to_equity": 2}, "Medium Risk"),
        ({"debt_to_equity": 1}, "Low Risk"),
        ({}, "Low Risk"),
    ],
    "growth_and_leverage_action": [
        ({"growth_pct": 15.1, "debt_to_equity": 0.99}, "Strong Buy"),
        ({"growth_pct": 15.1, "debt_to_equity": 1}, "Buy More"),
        ({"growth_pct": 15, "debt_to_equity": 0.5}, "Buy More"),
        ({"growth_pct": 10, "debt_to_equity": 2.01}, "Review - High Debt"),
        ({"growth_pct": -10.1, "debt_to_equity": 3}, "Consider Selling"),
        ({"growth_pct": -10, "debt_to_equity": 2}, "Hold"),
        ({"debt_to_equity": 2.01}, "Review - High Debt"),
        ({}, "Hold"),
    ],
    "growth_recommendation": [
        ({"growth": 0.151}, "Strong Buy"),
        ({"growth": 0.15}, "Buy"),
        ({"growth": 0.05}, "Hold"),
        ({"growth": -0.05}, "Sell"),
        ({}, "Sell"),
    ],
}


def frame(spark, inputs):
    schema = ", ".join(
        ["n int", *(f"{c} double" for c in NUMBERS), *(f"{c} string" for c in TEXTS)]
    )
    rows = [
        (
            i,
            *[None if row.get(c) is None else float(row[c]) for c in NUMBERS],
            *[row.get(c) for c in TEXTS],
        )
        for i, row in enumerate(inputs)
    ]
    return spark.createDataFrame(rows, schema)


def labels(spark, inputs, column):
    return [r.v for r in frame(spark, inputs).select("n", column.alias("v")).orderBy("n").collect()]


def test_every_rule_set_has_cases():
    assert set(CASES) == set(R.RULE_SETS)


@pytest.mark.parametrize("name", list(CASES))
def test_branches(spark, name):
    rules = R.RULE_SETS[name]()
    inputs, wanted = zip(*CASES[name])
    assert labels(spark, inputs, rules.column()) == list(wanted)
    assert set(wanted) == set(rules.labels), "every label must be reached"


def test_emoji_prefix(spark):
    rules = R.risk_assessment()
    got = labels(spark, [{"net_income": -1}, {"growth": -0.9}, {}], rules.column(emoji=True))
    assert got == [
        "🔴 High Risk - Unprofitable",
        "🟡 Medium Risk - Declining Earnings",
        "🟢 Low Risk",
    ]


@pytest.mark.parametrize("name", list(CASES))
def test_marks_belong_to_labels(name):
    rules = R.RULE_SETS[name]()
    assert set(rules.marks) <= set(rules.labels)
    assert not rules.marks or set(rules.marks) == set(rules.labels)


def test_unknown_label_replaces_only_the_default(spark):
    rules = R.action_recommendation()
    inputs = [{"net_income": -1}, {"net_income": 1}, {"net_income": 1, "growth": -0.12}]
    got = labels(spark, inputs, rules.column(unknown_label="Unknown"))
    assert got == ["SELL - Company Losing Money", "Unknown", "HOLD - Monitor"]


def test_thresholds_are_parameters(spark):
    strict = R.risk_level(high_debt=1.0)
    assert labels(spark, [{"debt_to_equity": 1.1}], strict.column()) == ["High Risk"]


def test_classify_takes_columns_and_text(spark):
    column = R.classify([(F.col("growth") > 1, "a"), ("growth > 0", "b")], "c")
    assert labels(spark, [{"growth": 2}, {"growth": 1}, {}], column) == ["a", "b", "c"]
    assert labels(spark, [{}], R.classify([], "only")) == ["only"]


def test_display_rank(spark):
    got = labels(
        spark,
        [{"risk": "Medium Risk"}, {"risk": "High Risk"}, {"risk": "else"}],
        R.display_rank(F.col("risk"), R.RISK_ORDER),
    )
    assert got == [2, 1, 4]
