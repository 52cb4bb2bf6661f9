from __future__ import annotations

import datetime as dt

import pytest
from tests.conftest import AS_OF, MIN_DATE, rows_by

from foliospark.functions import rules as R
from foliospark.plans import enrich

DAY = dt.date
DATES = {"as_of": AS_OF, "min_date": MIN_DATE}

DASHBOARD_COLUMNS = """symbol shares_held latest_fiscal_date revenue_mm net_income_mm operating_cf_mm
    profit_margin_pct cash_flow_margin_pct debt_to_equity_ratio equity_ratio_pct current_eps forward_eps
    next_estimate_period num_analysts_covering analyst_disagreement_pct my_current_annual_earnings
    my_projected_annual_earnings my_expected_earnings_increase projected_eps_growth_pct risk_assessment
    action_recommendation""".split()


def test_holdings_fundamentals(market):
    held, sym, ff_map, ff, _, _ = market.core
    got = rows_by(enrich.holdings_fundamentals(held, sym, ff_map, ff, min_date=MIN_DATE), "symbol")
    assert set(got) == {"aapl", "MSFT-US", "GOOGL", "DEBT", "ZERO", "LOSS", "PLAIN"}
    assert got["aapl"] == {
        "symbol": "aapl",
        "shares_held": 100.0,
        "latest_fiscal_date": DAY(2023, 12, 31),
        "revenue_millions": 1000.0,
        "net_income_millions": 200.0,
        "earnings_per_share": 4.0,
        "my_share_of_earnings": 400.0,
        "profit_margin_pct": 20.0,
        "equity_ratio_pct": 40.0,
        "debt_to_equity": 0.5,
        "operating_cf_millions": 250.0,
        "financial_health": "Strong",
    }
    assert got["MSFT-US"]["financial_health"] == "High Leverage Risk"
    assert got["LOSS"]["financial_health"] == "Unprofitable"
    assert got["PLAIN"]["financial_health"] == "Low Margin"
    assert got["DEBT"]["debt_to_equity"] is None
    assert got["ZERO"]["debt_to_equity"] is None
    assert got["ZERO"]["financial_health"] == "Healthy"
    assert got["GOOGL"]["earnings_per_share"] == 2.0, "equal dates: the smaller sales come first"


def test_min_date_and_instrument_type(market):
    held, sym, ff_map, ff, _, _ = market.core
    late = enrich.holdings_fundamentals(held, sym, ff_map, ff, min_date=DAY(2024, 1, 1))
    assert late.count() == 0
    funds = enrich.holdings_fundamentals(
        held, sym, ff_map, ff, min_date=MIN_DATE, instrument_type="Fund"
    )
    assert [r.symbol for r in funds.collect()] == ["MSFT"]


def test_holdings_estimates(market):
    held, sym, _, _, fe_map, fe = market.core
    rows = enrich.holdings_estimates(held, sym, fe_map, fe, as_of=AS_OF, horizon_days=None).collect()
    aapl = sorted((r for r in rows if r.symbol == "aapl"), key=lambda r: r.fiscal_period_end)
    assert [r.eps_consensus for r in aapl] == [5.0, 6.0]
    assert aapl[0].my_projected_earnings == 500.0
    assert aapl[0].my_best_case_earnings == 550.0
    assert aapl[0].my_worst_case_earnings == 450.0
    assert aapl[0].eps_std_deviation == 0.13
    assert aapl[0].estimate_spread_pct == 20.0
    assert aapl[0].analyst_signal == "Positive Outlook - Profitable Expected"
    assert aapl[1].analyst_signal == "Low Coverage - Limited Data"
    loss = next(r for r in rows if r.symbol == "LOSS")
    assert loss.analyst_signal == "Negative Outlook - Losses Expected"
    near = enrich.holdings_estimates(held, sym, fe_map, fe, as_of=AS_OF, horizon_days=365)
    assert {r.fiscal_period_end for r in near.collect()} == {DAY(2024, 12, 31)}


def test_investment_analysis(market):
    got = rows_by(enrich.investment_analysis(*market.core, **DATES), "symbol")
    labels = {s: (r["investment_recommendation"], r["risk_level"]) for s, r in got.items()}
    assert labels == {
        "aapl": ("STRONG BUY - High Growth Expected", "Low Risk"),
        "MSFT-US": ("SELL - Excessive Leverage Risk", "High Risk"),
        "GOOGL": ("SELL - Declining Earnings Expected", "Low Risk"),
        "DEBT": ("SELL - Declining Earnings Expected", "Low Risk"),
        "ZERO": ("STRONG BUY - High Growth Expected", "Low Risk"),
        "LOSS": ("SELL - Company Unprofitable", "High Risk"),
        "PLAIN": ("HOLD - Monitor Closely", "Medium Risk"),
    }
    assert got["aapl"]["my_expected_earnings_growth"] == 100.0
    assert got["aapl"]["eps_growth_pct"] == 25.0
    assert got["PLAIN"]["forward_eps"] is None
    assert got["MSFT-US"]["estimate_period"] == DAY(2025, 12, 31)


def test_dashboard(market):
    frame = enrich.portfolio_dashboard(*market.core, **DATES)
    assert frame.columns == DASHBOARD_COLUMNS
    got = rows_by(frame, "symbol")
    assert got["aapl"]["cash_flow_margin_pct"] == 25.0
    assert got["aapl"]["analyst_disagreement_pct"] == 20.0
    assert got["aapl"]["my_projected_annual_earnings"] == 500.0
    assert got["LOSS"]["projected_eps_growth_pct"] == -50.0, "a negative base flips the sign"
    labels = {s: (r["risk_assessment"], r["action_recommendation"]) for s, r in got.items()}
    assert labels == {
        "aapl": ("Low Risk - Strong Fundamentals", "STRONG BUY - High Growth Expected"),
        "MSFT-US": ("High Risk - Excessive Debt", "BUY - Positive Growth"),
        "GOOGL": ("Medium Risk - Declining Earnings", "SELL - Earnings Declining"),
        "DEBT": ("Medium Risk - Declining Earnings", "SELL - Earnings Declining"),
        "ZERO": ("Low Risk", "STRONG BUY - High Growth Expected"),
        "LOSS": ("High Risk - Unprofitable", "SELL - Company Losing Money"),
        "PLAIN": ("Medium Risk - Low Margins", "HOLD - Monitor"),
    }


def test_dashboard_options(market):
    marked = rows_by(enrich.portfolio_dashboard(*market.core, **DATES, emoji=True), "symbol")
    assert marked["aapl"]["action_recommendation"] == "💰 STRONG BUY - High Growth Expected"
    unknown = enrich.portfolio_dashboard(*market.core, **DATES, unknown_label="Unknown")
    assert rows_by(unknown, "symbol")["PLAIN"]["action_recommendation"] == "Unknown"
    rules = (R.leverage_risk(), R.growth_recommendation())
    custom = enrich.portfolio_dashboard(*market.core, **DATES, rules=rules)
    assert rows_by(custom, "symbol")["MSFT-US"]["risk_assessment"] == "High Risk"
    # the caller names the label column through the rule set
    assert "action_recommendation" in custom.columns


def test_several_lots_of_one_symbol_stay_apart(market, table):
    lots = table("equity_holdings", [("Equity", "AAPL", float(n)) for n in range(1, 6)])
    got = enrich.portfolio_dashboard(lots, *market.core[1:], **DATES).collect()
    assert sorted(r.my_current_annual_earnings for r in got) == [4.0, 8.0, 12.0, 16.0, 20.0]


def test_ticker_with_two_companies(market, table):
    """One row per ticker after the join, or one per company: the two readings differ."""
    links = table("ff_sec_map", [("AAPL-S", "AAPL-C"), ("AAPL-S", "MSFT-C")])
    per_ticker = enrich.latest_fundamentals(market.sym, links, market.ff, min_date=MIN_DATE)
    per_company = enrich.latest_fundamentals(
        market.sym, links, market.ff, min_date=MIN_DATE, per="company"
    )
    assert [r.fsym_company_id for r in per_ticker.collect()] == ["AAPL-C"]
    assert sorted(r.fsym_company_id for r in per_company.collect()) == ["AAPL-C", "MSFT-C"]
    with pytest.raises(ValueError, match="per must be"):
        enrich.latest_fundamentals(market.sym, links, market.ff, min_date=MIN_DATE, per="x")


def test_newest_of_two_companies_wins(market, table):
    links = table("ff_sec_map", [("AAPL-S", "OLD-C"), ("AAPL-S", "NEW-C")])
    nothing = (None,) * 9
    facts = table(
        "ff_basic_af",
        [("OLD-C", DAY(2022, 1, 1), *nothing), ("NEW-C", DAY(2023, 1, 1), *nothing)],
    )
    got = enrich.latest_fundamentals(market.sym, links, facts, min_date=MIN_DATE)
    assert [r.fsym_company_id for r in got.collect()] == ["NEW-C"]


def test_leverage_dashboard(market):
    frame = enrich.leverage_dashboard(*market.core, as_of=AS_OF)
    rows = frame.collect()
    aapl = sorted((r for r in rows if r.symbol == "aapl"), key=lambda r: r.eps_current)
    assert [r.eps_current for r in aapl] == [1.0, 3.0, 4.0], "every annual row is kept"
    assert aapl[2].projected_eps_growth_pct == 25.0
    assert aapl[2].debt_to_equity_ratio == 0.375
    assert (aapl[2].risk_assessment, aapl[2].action_recommendation) == ("Low Risk", "Strong Buy")
    loss = next(r for r in rows if r.symbol == "LOSS")
    assert loss.projected_eps_growth_pct is None
    assert any(r.instrument_type == "Fund" for r in rows)
    latest = enrich.leverage_dashboard(*market.core, as_of=AS_OF, latest_only=True)
    assert latest.count() == 8


def test_leverage_dashboard_with_all_estimates(market):
    rows = enrich.leverage_dashboard(*market.core, as_of=AS_OF, estimates="all").collect()
    aapl = sorted((r.eps_current, r.consensus_eps_estimate) for r in rows if r.symbol == "aapl")
    assert aapl == [(now, ahead) for now in (1.0, 3.0, 4.0) for ahead in (4.1, 5.0, 6.0)]
    assert [r.consensus_eps_estimate for r in rows if r.symbol == "PLAIN"] == [None]
    with pytest.raises(ValueError, match="estimates"):
        enrich.leverage_dashboard(*market.core, as_of=AS_OF, estimates="some")


def test_deep_dive(market):
    one = enrich.deep_dive(*market.core, **DATES, symbol="aapl").collect()
    assert sorted((r.fiscal_year, r.estimate_period.year) for r in one) == [
        (2022, 2024),
        (2022, 2025),
        (2023, 2024),
        (2023, 2025),
    ]
    first = next(r for r in one if r.fiscal_year == 2022 and r.estimate_period.year == 2024)
    assert first.my_annual_earnings_this_year == 300.0
    assert first.my_projected_annual_earnings == 500.0
    assert first.eps_growth_pct == 66.67
    everything = enrich.deep_dive(*market.core, **DATES).collect()
    assert [r for r in everything if r.symbol == "PLAIN"][0].forward_eps is None
    assert sorted(map(str, (r for r in everything if r.symbol == "aapl"))) == sorted(map(str, one))


def test_reading_order(market):
    held, sym, ff_map, ff, fe_map, fe = market.core
    facts = enrich.holdings_fundamentals(held, sym, ff_map, ff, min_date=MIN_DATE, sort=True)
    by_size = ["aapl", "GOOGL", "MSFT-US", "DEBT", "LOSS", "PLAIN", "ZERO"]
    assert [r.symbol for r in facts.collect()] == by_size
    analysis = enrich.investment_analysis(*market.core, **DATES, sort=True)
    assert [r.symbol for r in analysis.collect()] == by_size
    ahead = enrich.holdings_estimates(
        held, sym, fe_map, fe, as_of=AS_OF, horizon_days=None, sort=True
    ).collect()
    assert [(r.symbol, r.fiscal_period_end.year) for r in ahead[:3]] == [
        ("aapl", 2024),
        ("aapl", 2025),
        ("GOOGL", 2024),
    ]
    years = enrich.deep_dive(*market.core, **DATES, sort=True).collect()
    keys = [(-r.fiscal_year, r.estimate_period or DAY(1, 1, 1)) for r in years]
    assert keys == sorted(keys)
