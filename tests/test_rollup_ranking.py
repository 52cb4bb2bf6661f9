from __future__ import annotations

from tests.conftest import AS_OF, MIN_DATE, rows_by
import pytest

from foliospark.plans import datasets, enrich, ranking, rollup

DATES = {"as_of": AS_OF, "min_date": MIN_DATE}


@pytest.fixture
def dashboard(market):
    return enrich.portfolio_dashboard(*market.core, **DATES)


def test_risk_summary(market):
    row = rollup.portfolio_risk_summary(*market.core, **DATES).first().asDict()
    assert row == {
        "portfolio_name": "My Portfolio",
        "total_holdings": 7,
        # 400 + 100 + 150 + 10 + 10 - 20 + 5
        "total_current_annual_earnings": 655.0,
        # 500 + 110 + 78 + 8 + 12.1 - 10, none for PLAIN
        "total_projected_annual_earnings": 698.1,
        "portfolio_growth_rate_pct": 6.58,
        # 25, 10, -48, -20, 21, -50
        "avg_eps_growth_pct": -10.33,
        # 20, 4, 10, 50, 50, -50, 2
        "avg_profit_margin_pct": 12.29,
        # .5, 3, .1, .6, .3
        "avg_debt_to_equity": 0.9,
        "unprofitable_companies": 1,
        "high_leverage_companies": 1,
        "declining_earnings_companies": 3,
        "negative_cash_flow_companies": 1,
        "high_growth_stocks": 2,
        "quality_stocks": 1,
        "portfolio_health_rating": "HIGH RISK - Consider Rebalancing",
    }


def test_risk_summary_counts_each_lot(market):
    """Three lots of each symbol: sums and counts triple, means and the number of holdings stay."""
    once = rollup.portfolio_risk_summary(*market.core, **DATES).first().asDict()
    held, *rest = market.core
    lots = held.unionByName(held).unionByName(held)
    thrice = rollup.portfolio_risk_summary(lots, *rest, **DATES).first().asDict()
    for name, value in once.items():
        tripled = name.startswith("total_current") or name.startswith("total_projected")
        tripled = tripled or name.endswith(("companies", "stocks"))
        assert thrice[name] == (pytest.approx(3 * value) if tripled else value), name


def test_labels_of_several_lots_do_not_pair_up(dashboard):
    twice = dashboard.unionByName(dashboard)
    labels = ranking.position_labels(twice)
    assert labels.count() == twice.count()
    items = ranking.action_items(twice).select("symbol", "priority_action")
    pressing = labels.filter("priority_action is not null").select("symbol", "priority_action")
    assert sorted(pressing.collect()) == sorted(items.collect()) != []


def test_risk_summary_of_nothing(market):
    row = rollup.portfolio_risk_summary(market.holdings.limit(0), *market.core[1:], **DATES).first()
    assert row.total_holdings == 0
    assert row.total_current_annual_earnings is None
    assert row.unprofitable_companies is None
    assert row.portfolio_health_rating == "HEALTHY - Well Positioned"


def test_metrics_count_rows_and_summary_counts_symbols(dashboard):
    twice = dashboard.unionByName(dashboard)
    assert rollup.dashboard_metrics(twice).first().total_positions == 14
    assert rollup.portfolio_summary(twice).first().total_holdings == 7
    assert rollup.portfolio_overview(twice).first().total_stocks == 7


def test_summary_flags(dashboard):
    row = rollup.portfolio_summary(dashboard).first()
    assert row.high_risk_stocks == 2
    assert row.stocks_to_sell == 3
    assert row.buying_opportunities == 3, "strong buys are buys"
    assert row.high_growth_stocks == 2


def test_distributions_cover_the_dashboard_in_order(dashboard):
    risks = rollup.risk_distribution(dashboard).collect()
    assert [(r.risk_category, r.num_stocks) for r in risks] == [
        ("High Risk", 2),
        ("Medium Risk", 3),
        ("Low Risk", 2),
    ]
    actions = rollup.action_distribution(dashboard).collect()
    assert [(r.recommendation, r.num_stocks) for r in actions] == [
        ("Sell", 3),
        ("Hold", 1),
        ("Buy", 1),
        ("Strong Buy", 2),
    ]
    assert sum(r.current_earnings_impact for r in actions) == 655.0


def test_emoji_labels_give_the_same_rollups(market, dashboard):
    marked = enrich.portfolio_dashboard(*market.core, **DATES, emoji=True)
    for build in (rollup.portfolio_summary, rollup.risk_distribution, rollup.action_distribution):
        assert build(marked).collect() == build(dashboard).collect()


def test_listings(dashboard):
    rows = ranking.dashboard_listing(dashboard, sort=True).collect()
    assert [r.symbol for r in rows] == ["aapl", "GOOGL", "MSFT-US", "DEBT", "ZERO", "PLAIN", "LOSS"]
    growing = ranking.growth_opportunities(dashboard, sort=True).collect()
    assert [r.symbol for r in growing] == ["aapl", "ZERO"]
    alerts = ranking.risk_alerts(dashboard, sort=True).collect()
    assert [r.symbol for r in alerts] == ["GOOGL", "MSFT-US", "DEBT", "LOSS"]
    assert [r.symbol for r in ranking.quality_stocks(dashboard, sort=True).collect()] == ["aapl"]


def test_action_items(dashboard):
    items = ranking.by_priority(ranking.action_items(dashboard, with_rank=True)).collect()
    assert [(r.symbol, r.priority_rank, r.priority_action) for r in items] == [
        ("GOOGL", 1, "URGENT - Consider Selling"),
        ("DEBT", 1, "URGENT - Consider Selling"),
        ("LOSS", 1, "URGENT - Consider Selling"),
        ("MSFT-US", 2, "REVIEW - High Risk"),
        ("aapl", 4, "OPPORTUNITY - Consider Buying More"),
        ("ZERO", 4, "OPPORTUNITY - Consider Buying More"),
    ]
    assert "priority_rank" not in ranking.action_items(dashboard).columns


def test_rankings(dashboard):
    scores = {r.symbol: r.performance_score for r in ranking.stock_rankings(dashboard).collect()}
    # growth + margin + leverage + coverage
    assert scores["aapl"] == 25 + 20 + 20 + 20
    assert scores["MSFT-US"] == 10 + 4 + 10 + 10
    assert scores["LOSS"] == 0 + 0 + 20 + 8
    assert scores["DEBT"] == 0 + 30 + 10 + 6
    assert scores["PLAIN"] is None
    top = ranking.top_ranked(ranking.stock_rankings(dashboard), 2).collect()
    assert [r.symbol for r in top] == ["aapl", "ZERO"]


def test_unknown_growth_is_an_underperformer(dashboard):
    tiers = rows_by(ranking.stock_performance(dashboard), "symbol")
    assert tiers["PLAIN"]["performance_tier"] == "Underperformer"
    assert tiers["aapl"]["performance_tier"] == "Top Performer"


def test_performance_summary_keeps_each_lot_once(market, table):
    lots = table("equity_holdings", [("Equity", "AAPL", 1.0), ("Equity", "AAPL", 2.0)])
    frame = enrich.portfolio_dashboard(lots, *market.core[1:], **DATES)
    joined = ranking.performance_summary(frame, ranking.stock_rankings(frame), sort=True).collect()
    in_place = ranking.performance_summary(frame, sort=True).collect()
    for got in (joined, in_place):
        pairs = sorted((r.current_earnings, r.performance_score) for r in got)
        assert pairs == [(4.0, 85.0), (8.0, 85.0)]


def test_top_earnings_and_waterfall(dashboard):
    top = ranking.top_earnings(dashboard, 3).collect()
    assert [(r.symbol, r.current_earnings) for r in top] == [
        ("aapl", 400.0),
        ("GOOGL", 150.0),
        ("MSFT-US", 100.0),
    ]
    assert ranking.earnings_waterfall(dashboard).count() == 7


def test_datasets(dashboard):
    assert len(datasets.DATASETS) == 8
    shares = {r.risk_category: r for r in datasets.dataset("risk_distribution", dashboard).collect()}
    assert shares["High Risk"].risk_label == "High Risk: 2 stocks (28.6%)"
    assert shares["Medium Risk"].pct_of_portfolio == 42.9
    with pytest.raises(KeyError, match="unknown dataset"):
        datasets.dataset("nothing", dashboard)
    for name in datasets.DATASETS:
        assert datasets.dataset(name, dashboard).count() > 0
