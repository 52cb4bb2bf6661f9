"""Every registered query against its SQL, and the counts known for the derived tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
import check_oracle
from foliospark.fixtures import Tables
from foliospark.queries import registry
from oracle.sql import ORACLE

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return check_oracle.connect(SMALL)


def test_every_query_has_sql():
    """The corpus queries, where present, state in README.md which of them SQL can't express."""
    assert set(registry()) == set(ORACLE)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(entry_points.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    assert check_oracle.compare(spark, connection, SMALL, name) == ""


def test_entry_has_rows(spark):
    frame = entry_points.entry(spark)
    assert frame.count() == 138
    assert len(frame.columns) == 21


def test_known_counts(spark):
    t = Tables(spark, MIDDLE)
    assert t.equity_holdings.count() == 2000
    assert t.sym_ticker_region.count() == t.sec_map.count() == 1800
    assert t.fe_sec_map.count() == 1601
    assert t.ff_basic_af.count() == 700
    assert t.fe_basic_conh_af.count() == 2800


def test_every_branch_is_hit_at_the_middle_scale(spark):
    frame = entry_points.queries()["q12_portfolio_dashboard"](spark, MIDDLE).cache()
    assert frame.count() == 1353
    risks = {r[0]: r[1] for r in frame.groupBy("risk_assessment").count().collect()}
    assert risks == {
        "High Risk - Unprofitable": 259,
        "High Risk - Excessive Debt": 37,
        "Medium Risk - Declining Earnings": 593,
        "Medium Risk - Low Margins": 41,
        "Low Risk - Strong Fundamentals": 132,
        "Low Risk": 291,
    }
    actions = {r[0]: r[1] for r in frame.groupBy("action_recommendation").count().collect()}
    assert actions == {
        "SELL - Company Losing Money": 259,
        "SELL - Earnings Declining": 610,
        "STRONG BUY - High Growth Expected": 47,
        "BUY - Positive Growth": 103,
        "HOLD - Stable": 62,
        "HOLD - Monitor": 272,
    }
    assert frame.filter("debt_to_equity_ratio is null").count() == 103
    assert frame.filter("forward_eps is null").count() == 153
    frame.unpersist()


def test_matched_and_unmatched_make_up_the_holdings(spark):
    queries = entry_points.queries()
    matched = queries["semi_matched"](spark, SMALL)
    missing = queries["anti_unmatched"](spark, SMALL)
    everything = Tables(spark, SMALL).equity_holdings.select("symbol")
    assert matched.intersect(missing).count() == 0
    assert matched.unionByName(missing).exceptAll(everything).count() == 0
    assert matched.count() + missing.count() == everything.count()


def test_distributions_add_up(spark):
    queries = entry_points.queries()
    rows = queries["q12_portfolio_dashboard"](spark, SMALL).count()
    for name in ("d2_risk_distribution", "d3_action_distribution"):
        groups = queries[name](spark, SMALL).collect()
        assert sum(r.num_stocks for r in groups) == rows
        assert abs(sum(r.pct_of_portfolio for r in groups) - 100) <= 0.2
