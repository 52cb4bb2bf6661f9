"""Every registered query: name -> function of (spark, folder of the test tables)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import publish
from .fixtures import AS_OF, MIN_DATE, RAW, Tables
from .functions import metrics as M
from .functions import rules as R
from .functions.numeric import exact_avg, exact_sum, ratio, sum_if
from .functions.symbols import normalize_symbol
from .operators import resolve as res
from .operators import skew, temporal, trace
from .operators.asof import asof_join_along, by_days, by_width
from .operators.changes import change_set
from .operators.distribution import share_of_total
from .plans import datasets, enrich, entity, history, hybrid, lookup, performance, ranking, rollup, taxlots, trends
from .sources.managed import query as sql_query
from .streaming import live

FACTS_YEAR = 1999
ESTIMATE_YEAR = 2000
LOT_SPAN = (dt.date(1990, 1, 1), dt.date(2010, 12, 31))  # days that purchases may lie in
LOTS_UNTIL = dt.date(1999, 1, 1)
PURCHASED_SINCE = dt.date(1999, 1, 1)
DATES = {"as_of": AS_OF, "min_date": MIN_DATE}
ENTITY_YEARS = {"facts_year": FACTS_YEAR, "estimate_year": ESTIMATE_YEAR}

Build = Callable[[Tables], DataFrame]
BUILDERS: dict[str, Build] = {}


def _register(name: str) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        BUILDERS[name] = build
        return build

    return add


def dashboard(t: Tables, **options: object) -> DataFrame:
    return enrich.portfolio_dashboard(*t.core, **DATES, **options)


def equity(t: Tables) -> DataFrame:
    return t.equity_holdings.filter(F.col("instrument_type") == "Equity")


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare equal across engines."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# Lookups and traces.


@_register("q01_symbology_lookup")
def _(t: Tables) -> DataFrame:
    funds = t.equity_holdings.filter(F.col("instrument_type") == "Fund")
    return res.symbology_lookup(t.sym_ticker_region, res.with_ticker(funds))


@_register("q02_mapping_chain")
def _(t: Tables) -> DataFrame:
    return lookup.mapping_chain(t.sym_ticker_region, t.sec_map)


@_register("q03_holdings_by_size")
def _(t: Tables) -> DataFrame:
    return lookup.holdings_by_size(t.equity_holdings, sort=True)


@_register("q04_coverage_check")
def _(t: Tables) -> DataFrame:
    return res.coverage_check(equity(t), t.sym_ticker_region)


@_register("q08_join_trace")
def _(t: Tables) -> DataFrame:
    return trace.join_trace(
        equity(t), t.sym_ticker_region, t.sec_map, t.ff_basic_af, min_date=MIN_DATE
    ).orderBy("step")


@_register("q09_matched_symbols")
def _(t: Tables) -> DataFrame:
    return res.matched_symbols(equity(t), t.sym_ticker_region)


@_register("q28_security_history")
def _(t: Tables) -> DataFrame:
    return lookup.security_history(
        t.sym_ticker_region, t.sec_map, t.ff_basic_af, min_date=dt.date(1995, 1, 1), k=3
    )


@_register("q34_unmatched_holdings")
def _(t: Tables) -> DataFrame:
    return res.unmatched_holdings(t.sym_coverage, t.customer_holdings)


@_register("q34_known_tickers")
def _(t: Tables) -> DataFrame:
    return res.known_tickers(t.sym_coverage, t.customer_holdings)


@_register("q34_held_tickers")
def _(t: Tables) -> DataFrame:
    return res.held_tickers(t.customer_holdings)


# Enrichment.


@_register("q05_holdings_fundamentals")
def _(t: Tables) -> DataFrame:
    held, sym, ff_map, ff, _, _ = t.core
    return enrich.holdings_fundamentals(held, sym, ff_map, ff, min_date=MIN_DATE)


@_register("q06_holdings_estimates")
def _(t: Tables) -> DataFrame:
    held, sym, _, _, fe_map, fe = t.core
    return enrich.holdings_estimates(held, sym, fe_map, fe, as_of=AS_OF, horizon_days=365)


@_register("q07_investment_analysis")
def _(t: Tables) -> DataFrame:
    return enrich.investment_analysis(*t.core, **DATES)


@_register("q11_deep_dive")
def _(t: Tables) -> DataFrame:
    return enrich.deep_dive(*t.core, **DATES)


@_register("q12_portfolio_dashboard")
def _(t: Tables) -> DataFrame:
    return dashboard(t)


@_register("q29_leverage_dashboard")
def _(t: Tables) -> DataFrame:
    return enrich.leverage_dashboard(*t.core, as_of=AS_OF)


@_register("q29_leverage_dashboard_latest")
def _(t: Tables) -> DataFrame:
    return enrich.leverage_dashboard(*t.core, as_of=AS_OF, latest_only=True)


@_register("q29_leverage_dashboard_all_estimates")
def _(t: Tables) -> DataFrame:
    return enrich.leverage_dashboard(*t.core, as_of=AS_OF, estimates="all")


# Rollups, listings and rankings of the dashboard.


@_register("q10_portfolio_risk_summary")
def _(t: Tables) -> DataFrame:
    return rollup.portfolio_risk_summary(*t.core, **DATES)


@_register("q13_dashboard_listing")
def _(t: Tables) -> DataFrame:
    view = publish.publish_view(dashboard(t), f"foliospark_dashboard_{uuid4().hex}")
    columns = ", ".join(ranking.LISTING)
    return sql_query(
        t.spark, f"select {columns} from {view} order by my_current_annual_earnings desc, symbol"
    )


@_register("q14_dashboard_metrics")
def _(t: Tables) -> DataFrame:
    return rollup.dashboard_metrics(dashboard(t))


@_register("q15_stock_by_stock")
def _(t: Tables) -> DataFrame:
    return ranking.dashboard_listing(dashboard(t), sort=True)


@_register("q16_growth_opportunities")
def _(t: Tables) -> DataFrame:
    return ranking.growth_opportunities(dashboard(t), sort=True)


@_register("q17_risk_alerts")
def _(t: Tables) -> DataFrame:
    return ranking.risk_alerts(dashboard(t), sort=True)


@_register("q18_quality_stocks")
def _(t: Tables) -> DataFrame:
    return ranking.quality_stocks(dashboard(t), sort=True)


@_register("q19_portfolio_summary")
def _(t: Tables) -> DataFrame:
    return rollup.portfolio_summary(dashboard(t))


@_register("q20_action_items")
def _(t: Tables) -> DataFrame:
    return ranking.by_priority(ranking.action_items(dashboard(t), with_rank=True))


@_register("q21_stock_rankings")
def _(t: Tables) -> DataFrame:
    return ranking.stock_rankings(dashboard(t))


@_register("q22_portfolio_overview")
def _(t: Tables) -> DataFrame:
    return rollup.portfolio_overview(dashboard(t))


@_register("q23_risk_distribution")
def _(t: Tables) -> DataFrame:
    return rollup.risk_distribution(dashboard(t))


@_register("q24_action_distribution")
def _(t: Tables) -> DataFrame:
    return rollup.action_distribution(dashboard(t))


@_register("q25_stock_performance")
def _(t: Tables) -> DataFrame:
    return ranking.stock_performance(dashboard(t))


@_register("q26_earnings_waterfall")
def _(t: Tables) -> DataFrame:
    return ranking.earnings_waterfall(dashboard(t))


@_register("q27_performance_summary")
def _(t: Tables) -> DataFrame:
    return ranking.performance_summary(dashboard(t))


@_register("q27_rankings_join")
def _(t: Tables) -> DataFrame:
    frame = dashboard(t)
    return ranking.performance_summary(frame, ranking.stock_rankings(frame))


@_register("emoji_labels")
def _(t: Tables) -> DataFrame:
    return ranking.position_labels(dashboard(t, emoji=True), emoji=True)


# Datasets for a dashboard front end.


def _dataset(name: str) -> Build:
    return lambda t: datasets.dataset(name, dashboard(t))


for _number, _name in enumerate(datasets.DATASETS, 1):
    BUILDERS[f"d{_number}_{_name}"] = _dataset(_name)


# Entity schema.


@_register("q30_portfolio_fundamentals")
def _(t: Tables) -> DataFrame:
    return doubles(
        entity.portfolio_fundamentals(
            t.customer_holdings, t.sym_coverage, t.entity_facts(FACTS_YEAR), fiscal_year=FACTS_YEAR
        )
    )


@_register("q31_top_positions")
def _(t: Tables) -> DataFrame:
    return doubles(
        entity.top_positions(
            t.customer_holdings, t.sym_coverage, t.entity_facts(FACTS_YEAR), t.entity_eps(ESTIMATE_YEAR), **ENTITY_YEARS
        )
    )


@_register("q32_portfolio_estimates")
def _(t: Tables) -> DataFrame:
    return doubles(
        entity.portfolio_estimates(
            t.customer_holdings, t.sym_coverage, t.entity_eps(ESTIMATE_YEAR), fiscal_year=ESTIMATE_YEAR
        )
    )


@_register("q32_portfolio_outlook")
def _(t: Tables) -> DataFrame:
    return doubles(
        entity.portfolio_outlook(
            t.customer_holdings, t.sym_coverage, t.entity_facts(FACTS_YEAR), t.entity_eps(ESTIMATE_YEAR), **ENTITY_YEARS
        )
    )


@_register("q38_recent_holdings")
def _(t: Tables) -> DataFrame:
    lots = t.lots(since=PURCHASED_SINCE)
    return doubles(entity.recent_holdings(lots, t.sym_coverage, since=PURCHASED_SINCE))


@_register("q39_positions_by_account")
def _(t: Tables) -> DataFrame:
    return doubles(entity.positions_where(t.customer_holdings, "account_type", "IRA"))


@_register("q39_ticker_shares")
def _(t: Tables) -> DataFrame:
    return doubles(entity.ticker_shares(t.customer_holdings))


@_register("q39_customer_tickers")
def _(t: Tables) -> DataFrame:
    return entity.customer_tickers(t.customer_holdings)


@_register("q39_positions_per_ticker")
def _(t: Tables) -> DataFrame:
    return entity.positions_per_ticker(t.customer_holdings)


@_register("q40_annual_facts")
def _(t: Tables) -> DataFrame:
    return entity.annual_facts(t.entity_facts(FACTS_YEAR), FACTS_YEAR)


@_register("q40_annual_eps")
def _(t: Tables) -> DataFrame:
    return entity.annual_eps(t.entity_eps(ESTIMATE_YEAR), ESTIMATE_YEAR)


# Hybrid patterns.


@_register("q33_holdings_financials")
def _(t: Tables) -> DataFrame:
    return doubles(
        hybrid.holdings_financials(
            t.customer_holdings, t.annual_financials(FACTS_YEAR), fiscal_year=FACTS_YEAR
        )
    )


@_register("q33_top_investments")
def _(t: Tables) -> DataFrame:
    return doubles(
        hybrid.top_investments(t.customer_holdings, t.annual_financials(FACTS_YEAR), fiscal_year=FACTS_YEAR)
    )


@_register("q33_customer_rollup")
def _(t: Tables) -> DataFrame:
    return doubles(
        hybrid.customer_rollup(t.customer_holdings, t.annual_financials(FACTS_YEAR), fiscal_year=FACTS_YEAR)
    )


@_register("q35_enrich_transactions")
def _(t: Tables) -> DataFrame:
    return hybrid.enrich_transactions(t.transactions, t.countries)


@_register("q36_revenue_by_category")
def _(t: Tables) -> DataFrame:
    return hybrid.revenue_by_category(t.sales, t.products)


@_register("q37_live_and_history")
def _(t: Tables) -> DataFrame:
    return hybrid.live_and_history(t.orders, t.orders, as_of=AS_OF)


# Single operators.


@_register("normalize_symbol")
def _(t: Tables) -> DataFrame:
    both = t.equity_holdings.select("symbol").unionByName(
        t.customer_holdings.select(F.col("ticker_symbol").alias("symbol")).distinct()
    )
    return both.select("symbol", normalize_symbol(F.col("symbol")).alias("ticker_region"))


@_register("resolve")
def _(t: Tables) -> DataFrame:
    found = res.resolve(t.equity_holdings, t.sym_ticker_region, t.sec_map, how="left")
    return found.select("symbol", "ticker_region", "fsym_id", "fsym_company_id")


@_register("latest_per_key")
def _(t: Tables) -> DataFrame:
    facts = t.ff_basic_af.select("fsym_id", "DATE", "FF_SALES").withColumnRenamed("DATE", "fiscal_date")
    return temporal.latest_per_key(facts, ["fsym_id"], "fiscal_date", ["FF_SALES"])


@_register("next_per_key")
def _(t: Tables) -> DataFrame:
    columns = ["fsym_id", "FE_ITEM", "FE_FP_END", "FE_MEAN"]
    current = t.fe_basic_conh_af.filter(F.col("CONS_END_DATE").isNull()).select(*columns)
    return temporal.next_per_key(current, ["fsym_id", "FE_ITEM"], "FE_FP_END", AS_OF, ["FE_MEAN"])


@_register("current_estimates")
def _(t: Tables) -> DataFrame:
    return temporal.current_estimates(t.fe_basic_conh_af, "EPS", AS_OF, 365).drop("CONS_END_DATE")


@_register("semi_matched")
def _(t: Tables) -> DataFrame:
    held = res.with_ticker(t.equity_holdings)
    return held.join(t.sym_ticker_region, "ticker_region", "left_semi").select("symbol")


@_register("anti_unmatched")
def _(t: Tables) -> DataFrame:
    held = res.with_ticker(t.equity_holdings)
    return held.join(t.sym_ticker_region, "ticker_region", "left_anti").select("symbol")


@_register("share_of_total")
def _(t: Tables) -> DataFrame:
    counts = t.customer_holdings.groupBy("account_type").agg(F.count("*").alias("lots"))
    return share_of_total(counts, "lots", "account_type", "account_label", unit="lots")


@_register("score")
def _(t: Tables) -> DataFrame:
    return ranking.stock_rankings(dashboard(t)).select("symbol", "performance_score")


# Live windows, change sets, history and tax lots.

LIVE_SINCE = dt.date(2024, 1, 20)
WINDOWS = "window_start timestamp_ntz, event_type string, events bigint, total double"


@_register("q37_live_stream")
def _(t: Tables) -> DataFrame:
    """The live side as a stream that publishes hourly windows, read back beside the history."""
    # A pattern, since a stream takes a folder or a pattern of files, and the table may be a single file.
    events = live.read_files(t.spark, f"{t.folder}/events.parque[t]", RAW["events"])
    wanted = {"time": "ts", "value": "value", "keys": ["event_type"]}
    since = F.lit(dt.datetime.combine(LIVE_SINCE, dt.time())).cast("timestamp_ntz")
    totals = live.windowed_totals(events.filter(F.col("ts") >= since), **wanted, lateness="2 days")
    run = f"{publish.working_folder(t.spark)}/live-{uuid4().hex}"
    live.publish_windows(totals, f"{run}/windows", f"{run}/checkpoint").awaitTermination()
    windows = live.published(t.spark, f"{run}/windows", WINDOWS, ["event_type"])
    return live.live_windows_and_history(windows, t.raw("events"), **wanted, as_of=LIVE_SINCE)


@_register("k3_change_set")
def _(t: Tables) -> DataFrame:
    return change_set(t.shares_traded(1998), t.shares_traded(1999), ["ticker_symbol"])


@_register("q41_point_in_time")
def _(t: Tables) -> DataFrame:
    _, *core = t.core
    return doubles(history.point_in_time(t.customer_holdings, *core))


@_register("q42_security_at_date")
def _(t: Tables) -> DataFrame:
    lots = history.securities_at(t.customer_holdings, t.symbol_history, how="left", traded=t.traded_tickers, span=LOT_SPAN)
    return doubles(lots.select("customer_id", "ticker_symbol", "purchase_date", "shares_held", "fsym_id"))


@_register("q43_realised_gains_fifo")
def _(t: Tables) -> DataFrame:
    keys = ["ticker_symbol"]
    sales = t.trades(sold=True)
    cuts = {"cut": by_days(366), "share_cut": by_width(1000)}
    # Only hot tickers are cut; each other's trades stay together, so that they are shuffled once.
    hot = skew.hot(t.traded_tickers, keys)
    bought, sold = (t.trades(sold=side, together=True) for side in (False, True))
    if hot is None:
        segments = taxlots.first_in_first_out(bought, sold, keys)
    else:
        segments = taxlots.first_in_first_out(t.trades(sold=False).filter(hot), sales.filter(hot), keys, **cuts)
        segments = segments.unionByName(taxlots.first_in_first_out(bought.filter(~hot), sold.filter(~hot), keys))
    return doubles(taxlots.realised(sales, segments, keys))


@_register("q43_realised_gains_highest_cost")
def _(t: Tables) -> DataFrame:
    keys = ["ticker_symbol"]
    lots = t.trades(sold=False).filter(F.col("day") < LOTS_UNTIL)
    sales = t.trades(sold=True).filter(F.col("day") >= LOTS_UNTIL)
    return doubles(taxlots.realised(sales, taxlots.highest_cost_first(lots, sales, keys), keys))


@_register("q44_attribution")
def _(t: Tables) -> DataFrame:
    """Each kind of account against all of them, by category and brand."""
    held = t.yearly_positions
    return performance.attribution(held, held.drop("account_type"), ["account_type"], "year", ["category", "brand"])


@_register("q45_sales_trends")
def _(t: Tables) -> DataFrame:
    """Quarterly value traded of each ticker."""
    day = F.col("l_shipdate")
    lines = t.raw("lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey")).alias("ticker_symbol"),
        (F.year(day) * 4 + F.quarter(day)).alias("quarter"),
        F.col("l_extendedprice").alias("sales"),
    )
    return doubles(trends.trends(lines, ["ticker_symbol"], "quarter", "sales"))


@_register("asof_price")
def _(t: Tables) -> DataFrame:
    """Each lot with the last sale of its ticker on or before its day."""
    prices = temporal.latest_per_key(t.trades(sold=True), ["ticker_symbol", "day"], "day", ["price"])
    prices = prices.select("ticker_symbol", "day", F.col("price").alias("last_price"))
    lots = t.customer_holdings.select("customer_id", "ticker_symbol", "shares_held", "purchase_date")
    # Hot tickers are looked up and joined apart: work out the lots (lineitem joined with orders) and prices once.
    lots, prices = history.kept(lots), history.kept(prices)
    found = asof_join_along(lots, prices, ["ticker_symbol"], "purchase_date", "day", ["day", "last_price"], cut=by_days(366))
    return doubles(found)


# Rule sets, each over the frame that holds its inputs.


def _profile(t: Tables) -> DataFrame:
    _, sym, ff_map, ff, fe_map, fe = t.core
    return enrich.ticker_profile(sym, ff_map, ff, fe_map, fe, **DATES)


def _labels(t: Tables) -> DataFrame:
    return dashboard(t).select(
        F.col("symbol").alias("ticker_region"),
        F.col("risk_assessment").alias("risk"),
        F.col("action_recommendation").alias("action"),
        F.col("projected_eps_growth_pct").alias("growth_pct"),
    )


def _signals(t: Tables) -> DataFrame:
    current = temporal.current_estimates(t.fe_basic_conh_af, "EPS", AS_OF)
    spread = M.estimate_spread(F.col("FE_HIGH"), F.col("FE_LOW"), F.col("FE_MEAN"))
    return current.select(
        F.concat_ws("@", "fsym_id", F.col("FE_FP_END").cast("string")).alias("ticker_region"),
        F.col("FE_NUM_EST").alias("analysts"),
        spread.alias("spread"),
        F.col("FE_MEAN").alias("eps_mean"),
    )


def _coverage(t: Tables) -> DataFrame:
    return res.with_ticker(t.equity_holdings).join(t.sym_ticker_region, "ticker_region", "left")


def _leverage(t: Tables) -> DataFrame:
    frame = enrich.leverage_dashboard(*t.core, as_of=AS_OF, latest_only=True)
    return frame.select(
        F.col("symbol").alias("ticker_region"),
        F.col("projected_eps_growth_pct").alias("growth_pct"),
        F.col("debt_to_equity_ratio").alias("debt_to_equity"),
    )


def _by_instrument(t: Tables) -> DataFrame:
    """At-risk weight and mean ratios per instrument type, the inputs of the portfolio rating."""
    held = enrich.positions(t.equity_holdings, None, keep=["instrument_type"])
    rows = held.join(_profile(t), "ticker_region")
    at_risk = (F.col("net_income") < 0) | (F.col("growth_pct") < -10)
    shares = F.col("shares_held")
    weight = ratio(sum_if(at_risk, shares).cast("double"), exact_sum(shares).cast("double"))
    return rows.groupBy(F.col("instrument_type").alias("ticker_region")).agg(
        weight.alias("at_risk_weight"),
        exact_avg(F.col("growth_pct")).alias("mean_growth_pct"),
        exact_avg(F.col("profit_margin_pct")).alias("mean_margin_pct"),
    )


RULE_INPUTS: dict[str, Build] = {
    "coverage_status": _coverage,
    "financial_health": _profile,
    "analyst_signal": _signals,
    "investment_recommendation": _profile,
    "risk_level": _profile,
    "portfolio_health_rating": _by_instrument,
    "risk_assessment": _profile,
    "action_recommendation": _profile,
    "priority_action": _labels,
    "priority_rank": _labels,
    "risk_category": _labels,
    "recommendation_group": _labels,
    "performance_tier": _labels,
    "leverage_risk": _leverage,
    "growth_and_leverage_action": _leverage,
    "growth_recommendation": _profile,
}


def _classified(name: str) -> Build:
    def build(t: Tables) -> DataFrame:
        rules = R.RULE_SETS[name]()
        return RULE_INPUTS[name](t).select(
            F.col("ticker_region").alias("item"), rules.column().alias("label")
        )

    return build


for _name in R.RULE_SETS:
    BUILDERS[f"classify_{_name}"] = _classified(_name)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build: Build) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(Tables(spark, folder))

    return {name: runner(build) for name, build in BUILDERS.items()}
