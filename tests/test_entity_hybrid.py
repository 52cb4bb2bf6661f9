from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from tests.conftest import rows_by

from foliospark.operators import resolve as res
from foliospark.plans import entity, hybrid

DAY = dt.date


@pytest.fixture
def lots(table):
    """The five sample positions and one of a ticker without coverage."""
    money = Decimal
    return table(
        "customer_holdings",
        [
            (1001, "AAPL", money("100.00"), DAY(2023, 1, 15), money("150.25"), "Brokerage"),
            (1001, "MSFT", money("50.00"), DAY(2023, 2, 20), money("280.50"), "IRA"),
            (1002, "GOOGL", money("75.00"), DAY(2023, 3, 10), money("105.75"), "Brokerage"),
            (1002, "TSLA", money("25.00"), DAY(2023, 4, 5), money("220.00"), "401k"),
            (1003, "AMZN", money("60.00"), DAY(2023, 5, 12), money("95.50"), "Brokerage"),
        ],
    )


@pytest.fixture
def coverage(table):
    return table(
        "sym_coverage",
        [
            ("MSFT", "0016YD-E", "Microsoft Corporation", "EQY", "US"),
            ("AAPL", "000C7F-E", "Apple Inc.", "EQY", "US"),
            ("GOOGL", "02079K-E", "Alphabet Inc.", "EQY", "US"),
        ],
    )


@pytest.fixture
def facts(table):
    def row(name, year, eps, income):
        return (name, year, 1000.0, income, 5000.0, 2000.0, eps)

    return table(
        "entity_facts",
        [
            row("0016YD-E", 2023, 10.0, 5.0),
            row("0016YD-E", 2022, 9.0, 5.0),
            row("000C7F-E", 2023, 6.0, 5.0),
            row("02079K-E", 2023, 0.0, -5.0),
        ],
    )


@pytest.fixture
def eps(table):
    return table(
        "entity_eps",
        [
            ("0016YD-E", 2024, 12.0, 13.0, 11.0, 30, 0.5),
            ("0016YD-E", 2025, 14.0, 15.0, 12.0, 20, 0.5),
            ("000C7F-E", 2024, 6.1, 7.0, 6.0, 40, 0.5),
            ("02079K-E", 2024, 1.0, 2.0, 0.0, 3, 0.5),
        ],
    )


YEARS = {"facts_year": 2023, "estimate_year": 2024}


def test_portfolio_fundamentals(lots, coverage, facts):
    rows = entity.portfolio_fundamentals(lots, coverage, facts, fiscal_year=2023, sort=True).collect()
    assert [(r.ticker_symbol, r.proper_name, float(r.position_value)) for r in rows] == [
        ("AAPL", "Apple Inc.", 15025.0),
        ("MSFT", "Microsoft Corporation", 14025.0),
        ("GOOGL", "Alphabet Inc.", 7931.25),
    ]


def test_portfolio_estimates(lots, coverage, eps):
    rows = entity.portfolio_estimates(lots, coverage, eps, fiscal_year=2024, sort=True).collect()
    assert [(r.ticker_symbol, r.projected_earnings) for r in rows] == [
        ("AAPL", 610.0),
        ("MSFT", 600.0),
        ("GOOGL", 75.0),
    ]


def test_portfolio_outlook(lots, coverage, facts, eps):
    got = rows_by(entity.portfolio_outlook(lots, coverage, facts, eps, **YEARS), "ticker_symbol")
    assert got["MSFT"]["eps_growth_pct"] == 20.0
    assert {t: r["recommendation"] for t, r in got.items()} == {
        "MSFT": "Strong Buy",
        "AAPL": "Hold",
        "GOOGL": "Sell",  # no growth on a zero base
    }
    assert got["GOOGL"]["eps_growth_pct"] is None


def test_top_positions(lots, coverage, facts, eps):
    rows = entity.top_positions(lots, coverage, facts, eps, **YEARS, k=2).collect()
    assert [r.ticker_symbol for r in rows] == ["AAPL", "MSFT"]


def test_listings_and_filters(lots, coverage, facts, eps):
    assert entity.annual_facts(facts, 2023).count() == 3
    assert entity.annual_eps(eps, 2024).count() == 3
    recent = entity.recent_holdings(lots, coverage, since=DAY(2023, 2, 20))
    assert sorted(r.ticker for r in recent.collect()) == ["GOOGL", "MSFT"]
    assert entity.positions_where(lots, "customer_id", 1001).count() == 2
    assert entity.ticker_shares(lots).columns == ["ticker_symbol", "shares_held"]
    assert entity.customer_tickers(lots).columns == ["customer_id", "ticker_symbol"]
    assert rows_by(entity.positions_per_ticker(lots), "ticker_symbol")["AAPL"]["count"] == 1


def test_unmatched_sample_tickers(lots, coverage):
    missing = res.unmatched_holdings(coverage, lots).collect()
    assert sorted(r.ticker_symbol for r in missing) == ["AMZN", "TSLA"]


def test_adapters_from_the_security_schema(market, spark):
    names = spark.createDataFrame([("AAPL", "Apple Inc.")], "ticker string, proper_name string")
    row = entity.adapt_coverage(market.sym, market.ff_map, names).first()
    assert tuple(row) == ("AAPL", "AAPL-C", "Apple Inc.", "EQY", "US")
    assert rows_by(entity.adapt_facts(market.ff), "entity_id")["LOSS-C"]["fiscal_year"] == 2023
    assert entity.adapt_eps(market.fe).count() == 8


def test_customer_rollup_against_the_row_join(table):
    """Duplicated financial rows multiply positions exactly as the plain join does."""
    rng = random.Random(11)
    lots = [
        (
            rng.randrange(5),
            rng.choice("ABCDE"),
            Decimal(rng.randrange(1, 500)),
            DAY(2023, 1, 1),
            Decimal(rng.randrange(100, 9999)) / 100,
            "IRA",
        )
        for _ in range(200)
    ]
    figures = [(rng.choice("ABCD"), 2023, 1.0, rng.choice([-1.0, 1.0, None])) for _ in range(8)]
    figures += [("A", 2022, 1.0, -1.0)]
    got = hybrid.customer_rollup(
        table("customer_holdings", lots), table("annual_financials", figures), fiscal_year=2023
    )
    wanted = defaultdict(lambda: [0, Decimal(0), 0])
    for customer, ticker, shares, _, cost, _ in lots:
        for other, year, _, income in figures:
            if other == ticker and year == 2023:
                entry = wanted[customer]
                entry[0] += 1
                entry[1] += shares * cost
                entry[2] += income is not None and income < 0
    assert {
        r.customer_id: [r.positions, r.portfolio_value, r.risk_count] for r in got.collect()
    } == dict(wanted)


def test_holdings_financials_and_top_investments(lots, table):
    figures = table("annual_financials", [("AAPL", 2023, 1.0, 2.0), ("MSFT", 2023, 1.0, -2.0), ("MSFT", 2022, 1.0, 1.0)])
    joined = hybrid.holdings_financials(lots, figures, fiscal_year=2023)
    assert sorted(r.ticker_symbol for r in joined.collect()) == ["AAPL", "MSFT"]
    top = hybrid.top_investments(lots, figures, fiscal_year=2023, k=1).collect()
    assert [(r.ticker_symbol, float(r.investment)) for r in top] == [("AAPL", 15025.0)]


def test_enrich_transactions(table):
    got = hybrid.enrich_transactions(
        table("transactions", [(1, 10, 5.0, 1), (2, 11, 6.0, 9)]),
        table("countries", [(1, "France", "Europe"), (2, "Japan", "Asia")]),
    )
    assert [tuple(r) for r in got.collect()] == [(1, 10, 5.0, "France", "Europe")]


def test_revenue_by_category(table):
    got = hybrid.revenue_by_category(
        table("sales", [(1, 2.0), (1, 3.0), (2, 1.0), (9, 7.0)]),
        table("products", [(1, "x", 10.0), (2, "x", 1.5), (3, "y", 1.0)]),
    )
    assert [tuple(r) for r in got.collect()] == [("x", 51.5)]


def test_live_and_history(table):
    live = table("orders", [(DAY(2024, 6, 30), 10.0), (DAY(2024, 6, 29), 99.0)])
    history = table("orders", [(DAY(2024, 6, 30), 5.0), (DAY(2024, 6, 29), 1.0), (DAY(2020, 1, 1), 2.0)])
    got = hybrid.live_and_history(live, history, as_of=DAY(2024, 6, 30)).collect()
    assert [tuple(r) for r in got] == [("Real-Time", 1, 10.0), ("Historical", 2, 3.0)]
    none = hybrid.live_and_history(live, history, as_of=DAY(2019, 1, 1)).collect()
    assert [tuple(r) for r in none] == [("Real-Time", 0, None), ("Historical", 0, None)]
