"""What the plans must look like at scale, whatever the size of the test data."""

from __future__ import annotations

import re

import pytest
from tests.conftest import AS_OF, MIN_DATE
from pyspark.sql import functions as F

from foliospark import queries as registered
from foliospark.fixtures import Tables
from foliospark.operators import resolve, temporal
from foliospark.plans import enrich, entity, history, hybrid
from foliospark.sources import introspect

FOLDER = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups")
DASHBOARD_BASED = "q12_portfolio_dashboard"


@pytest.fixture
def tables(spark):
    return Tables(spark, FOLDER)


@pytest.fixture
def no_broadcast(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def executed(frame):
    """The final plan only; a subquery shows an initial plan of its own, further indented."""
    return re.split(r"^\+- == Initial Plan ==", final_plan(frame), flags=re.MULTILINE)[0]


@pytest.mark.parametrize("name", sorted(registered.BUILDERS))
def test_no_python_no_cross_join_no_forced_broadcast(tables, name):
    text = introspect.explain_text(registered.BUILDERS[name](tables), "extended")
    assert not any(node in text for node in PYTHON_NODES)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "hint" not in text.lower(), "broadcasts are left to measured sizes"


@pytest.mark.parametrize(
    "name", ["q12_portfolio_dashboard", "q30_portfolio_fundamentals", "q33_customer_rollup"]
)
def test_nothing_needs_a_broadcast(tables, no_broadcast, name):
    text = executed(registered.BUILDERS[name](tables))
    assert "BroadcastExchange" not in text
    assert "SortMergeJoin" in text


def test_latest_row_is_cut_before_the_shuffle(tables):
    frame = temporal.latest_per_key(tables.ff_basic_af, ["fsym_id"], "DATE", ["FF_SALES"])
    text = introspect.explain_text(frame, "simple")
    limits = [line for line in text.splitlines() if "WindowGroupLimit" in line]
    assert len(limits) == 2
    assert "Partial" in limits[1] and "Final" in limits[0]
    between = text[text.index(limits[0]) : text.index(limits[1])]
    assert "Exchange hashpartitioning(fsym_id" in between


def test_profile_joins_in_place(tables, no_broadcast):
    """Fundamentals and estimates are both partitioned by ticker when they meet."""
    _, sym, ff_map, ff, fe_map, fe = tables.core
    frame = enrich.ticker_profile(
        sym, ff_map, ff, fe_map, fe, as_of=registered.AS_OF, min_date=registered.MIN_DATE
    )
    text = introspect.explain_text(frame, "simple")
    top_join = text[text.index("SortMergeJoin") :]
    first_exchange = top_join.index("Exchange")
    assert "Window " in top_join[:first_exchange]


def test_estimates_reuse_the_scan_of_the_fundamentals(tables, no_broadcast):
    text = executed(registered.BUILDERS[DASHBOARD_BASED](tables))
    assert "ReusedExchange" in text
    scans = re.findall(r"FileScan parquet \[[^\]]*\][^\n]*lineitem", text)
    assert len(scans) == 2, "one for the holdings, one for all annual figures"


def test_filters_and_columns_reach_the_scan(tables):
    pushed = introspect.explain_pushdown(tables.ff_basic_af.select("FF_SALES"))
    assert any(
        "l_extendedprice" in text and "l_quantity" not in text and "l_orderkey" not in text
        for text in pushed.read_schemas
    )
    recent = introspect.explain_pushdown(registered.BUILDERS["q38_recent_holdings"](tables))
    assert any("GreaterThanOrEqual(o_orderdate" in text for text in recent.filters)
    days = introspect.explain_pushdown(registered.BUILDERS["q37_live_and_history"](tables))
    assert sum("o_orderdate" in text for text in days.filters) == 2
    columns = introspect.explain_pushdown(registered.BUILDERS["q39_positions_per_ticker"](tables))
    assert any(text == "struct<l_orderkey:bigint,l_partkey:bigint>" for text in columns.read_schemas)


@pytest.mark.parametrize("name", ["q40_annual_facts", "q40_annual_eps", "q30_portfolio_fundamentals"])
def test_the_year_of_the_facts_reaches_the_scan(tables, name):
    pushed = introspect.explain_pushdown(registered.BUILDERS[name](tables))
    assert any(
        "GreaterThanOrEqual(l_shipdate,1999" in text and "LessThan(l_shipdate,2000" in text
        for text in pushed.filters
    )


def test_risk_summary_adds_up_lots_before_the_join(tables, no_broadcast):
    text = introspect.explain_text(registered.BUILDERS["q10_portfolio_risk_summary"](tables), "simple")
    below = text[text.index("SortMergeJoin") :]
    assert re.search(r"HashAggregate\(keys=\[symbol", below)


def test_labels_plan_the_dashboard_once(tables):
    def scans(name):
        text = introspect.explain_text(registered.BUILDERS[name](tables), "simple")
        return text.count("FileScan parquet")

    assert scans("emoji_labels") == scans(DASHBOARD_BASED)


def test_instrument_filter_reaches_a_plain_scan(spark, market, tmp_path):
    path = str(tmp_path / "holdings")
    market.holdings.write.parquet(path)
    pushed = introspect.explain_pushdown(enrich.positions(spark.read.parquet(path)))
    assert any("EqualTo(instrument_type,Equity)" in text for text in pushed.filters)


def test_rollups_aggregate_before_the_shuffle(tables):
    for name in ("q33_customer_rollup", "q36_revenue_by_category", "q19_portfolio_summary"):
        text = introspect.explain_text(registered.BUILDERS[name](tables), "simple")
        assert "partial_sum" in text


def test_top_k_never_sorts_everything(tables):
    for name in ("q31_top_positions", "q33_top_investments", "d6_stock_rankings", "d8_top_earnings"):
        assert "TakeOrderedAndProject" in introspect.explain_text(
            registered.BUILDERS[name](tables), "simple"
        )


def test_published_frames_are_not_sorted(tables):
    names = ("q12_portfolio_dashboard", "q21_stock_rankings", "q25_stock_performance")
    for name in (*names, "d7_action_items", "q05_holdings_fundamentals", "q30_portfolio_fundamentals"):
        text = introspect.explain_text(registered.BUILDERS[name](tables), "simple")
        assert "rangepartitioning" not in text


@pytest.fixture
def skew_sensitive(settings, no_broadcast):
    """Treat a few kilobytes as a skewed partition."""
    settings(
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


def hot_lots(spark, hot, rest, n=60_000):
    """A third of all lots in one symbol, the others spread over the rest."""
    choices = F.array(*[F.lit(name) for name in rest])
    other = F.element_at(choices, (F.col("id") % len(rest) + 1).cast("int"))
    return spark.range(0, n, 1, 8).select(
        F.lit("Equity").alias("instrument_type"),
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(other).alias("symbol"),
        (F.xxhash64("id") % 1000).cast("double").alias("number_of_shares"),
        F.col("id").alias("lot"),
    )


def test_a_hot_symbol_is_split_in_the_dashboard(spark, market, skew_sensitive):
    lots = hot_lots(spark, "AAPL", ["MSFT", "GOOGL", "DEBT", "ZERO", "LOSS", "PLAIN", "TSLA", "AMZN"])
    frame = enrich.portfolio_dashboard(
        lots, *market.core[1:], as_of=AS_OF, min_date=MIN_DATE
    )
    text = executed(frame)
    assert re.search(r"SortMergeJoin\(skew=true\)", text)
    counts = {r.symbol: r["count"] for r in frame.groupBy("symbol").count().collect()}
    assert counts["AAPL"] == 20_000
    assert sum(counts.values()) == 20_000 + 40_000 * 6 // 8


def test_a_hot_ticker_is_split_in_the_entity_queries(spark, market, skew_sensitive):
    lots = hot_lots(spark, "AAPL", ["MSFT", "GOOGL", "LOSS", "PLAIN"]).select(
        F.col("lot").alias("customer_id"),
        F.col("symbol").alias("ticker_symbol"),
        F.col("number_of_shares").alias("shares_held"),
        F.lit(1.0).alias("cost_basis"),
    )
    names = market.sym.select(
        F.regexp_replace("ticker_region", "-US", "").alias("ticker"), F.lit("n").alias("proper_name")
    )
    coverage = entity.adapt_coverage(market.sym, market.ff_map, names)
    facts, eps = entity.adapt_facts(market.ff), entity.adapt_eps(market.fe)
    outlook = entity.portfolio_outlook(lots, coverage, facts, eps, facts_year=2023, estimate_year=2024)
    assert re.search(r"SortMergeJoin\(skew=true\)", executed(outlook))
    yearly = entity.portfolio_fundamentals(lots, coverage, facts, fiscal_year=2022)
    assert re.search(r"SortMergeJoin\(skew=true\)", executed(yearly))
    assert yearly.count() == 20_000


def test_a_hot_customer_and_ticker_in_the_rollup(spark, skew_sensitive, table):
    """The hot ticker is split in the join, the hot customer is summed up before its shuffle."""
    lots = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, F.lit("A"))
        .otherwise(F.concat(F.lit("B"), F.col("id") % 40))
        .alias("ticker_symbol"),
        (F.xxhash64("id") % 100).cast("double").alias("shares_held"),
        F.lit(3.0).alias("cost_basis"),
    )
    names = ["A"] + [f"B{n}" for n in range(40)]
    figures = table("annual_financials", [(n, 2023, 1.0, -1.0 if n == "A" else 1.0) for n in names])
    frame = hybrid.customer_rollup(lots, figures, fiscal_year=2023)
    rows = {r.customer_id: r for r in frame.collect()}
    assert sum(r.positions for r in rows.values()) == 60_000
    assert sum(r.risk_count for r in rows.values()) == 20_000
    text = executed(frame)
    assert re.search(r"SortMergeJoin\(skew=true\)", text)
    above = text[: text.index("SortMergeJoin")]
    assert "partial_sum" in above[above.index("Exchange hashpartitioning(customer_id") :]


def test_a_hot_symbol_is_split_where_it_meets_its_securities(spark, skew_sensitive):
    lots = hot_lots(spark, "HOT", ["AAPL", "MSFT", "GOOGL", "LOSS"]).select(
        F.col("lot").alias("customer_id"),
        F.col("symbol").alias("ticker_symbol"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.xxhash64("lot") % 300).cast("int")).alias("purchase_date"),
    )
    changed = F.lit("2020-02-01").cast("date")
    symbols = lots.select(F.concat("ticker_symbol", F.lit("-US")).alias("ticker_region")).distinct()
    old = symbols.select("ticker_region", F.lit("old").alias("fsym_id"), F.lit(None).cast("date").alias("valid_from"), changed.alias("valid_to"))
    new = symbols.select("ticker_region", F.lit("new").alias("fsym_id"), changed.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    found = history.securities_at(lots, old.unionByName(new), how="left")
    assert re.search(r"SortMergeJoin\(skew=true\)", executed(found))
    counts = {r.fsym_id: r["count"] for r in found.groupBy("fsym_id").count().collect()}
    assert counts == {"old": lots.filter(F.col("purchase_date") < changed).count(), "new": lots.filter(F.col("purchase_date") >= changed).count()}


def test_a_hot_ticker_is_split_in_the_anti_join(spark, market, skew_sensitive):
    lots = hot_lots(spark, "NONE", ["AAPL", "MSFT", "GOOGL", "LOSS"])
    lots = lots.select(F.col("symbol").alias("ticker_symbol"))
    names = market.sym.select(
        F.regexp_replace("ticker_region", "-US", "").alias("ticker"), F.lit("n").alias("proper_name")
    )
    coverage = entity.adapt_coverage(market.sym, market.ff_map, names)
    missing = resolve.unmatched_holdings(coverage, lots)
    assert re.search(r"SortMergeJoin\(skew=true\)", executed(missing))
    assert missing.count() == 20_000


def test_attribution_reads_the_lots_once(tables, no_broadcast):
    """Prices of a year and of the next come from the one aggregate of the lots, not from lineitem and orders again."""
    text = executed(registered.BUILDERS["q44_attribution"](tables))
    assert len(re.findall(r"FileScan parquet [^\n]*orders\.parquet", text)) == 1


def test_attribution_shuffles_the_positions_once(tables, no_broadcast):
    """The benchmark is added up from the portfolios' sums, so the positions' windows are not shuffled for it again."""
    text = executed(registered.BUILDERS["q44_attribution"](tables))
    for keys in ("account_type", "year"):
        assert len(re.findall(rf"- Exchange hashpartitioning\(ticker_symbol#\d+, {keys}", text)) == 1


def test_fifo_works_out_lots_and_sales_once(tables):
    """The segments read the trades only through the two materialised sides, and the realised sums read the sales once more."""
    text = registered.BUILDERS["q43_realised_gains_fifo"](tables)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet [^\n]*lineitem\.parquet", text)) == 1
    assert not re.findall(r"FileScan parquet [^\n]*orders\.parquet", text)
