"""Holdings enriched with fundamentals and consensus estimates.

Everything that depends on the company alone is computed once per ticker; the holdings then meet
that profile in a single join. Frames come back unsorted unless ``sort=True`` asks for the reading
order: a global sort runs the join below it a second time to sample its ranges.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import rules as R
from ..functions.numeric import half_up, millions
from ..functions.symbols import normalize_symbol
from ..operators.resolve import securities, with_ticker
from ..operators.skew import splittable
from ..operators.temporal import current_estimates, latest_per_key, next_per_key

FACT_VALUES = (
    "FF_SALES",
    "FF_NET_INCOME",
    "FF_EPS_BASIC",
    "FF_ASSETS",
    "FF_COM_EQ",
    "FF_FUNDS_OPER_GROSS",
    "FF_DEBT_ST",
    "FF_DEBT_LT",
)
ESTIMATE_VALUES = ("FE_MEAN", "FE_HIGH", "FE_LOW", "FE_NUM_EST")


def positions(
    holdings: DataFrame,
    instrument_type: str | None = "Equity",
    region: str | None = "US",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Holdings of one instrument type as ``symbol, ticker_region, shares_held`` plus ``keep``."""
    if instrument_type is not None:
        holdings = holdings.filter(F.col("instrument_type") == instrument_type)
    return with_ticker(holdings, region=region).select(
        "symbol", "ticker_region", F.col("number_of_shares").alias("shares_held"), *keep
    )


def latest_fundamentals(
    sym: DataFrame,
    sec_map: DataFrame,
    facts: DataFrame,
    *,
    min_date: dt.date | None,
    columns: Sequence[str] = FACT_VALUES,
    per: str = "ticker",
) -> DataFrame:
    """Most recent annual row, keyed by ``ticker_region``.

    The latest row is taken per company before any join, so at most one row per company travels on.
    ``per="ticker"`` then keeps one row per ticker even if the map gives it several companies;
    ``per="company"`` keeps one per company.
    """
    recent = facts.select("fsym_id", "DATE", *columns)
    if min_date is not None:
        recent = recent.filter(F.col("DATE") >= F.lit(min_date))
    newest = latest_per_key(recent, ["fsym_id"], "DATE", columns)
    newest = newest.withColumnRenamed("fsym_id", "fsym_company_id")
    keys = securities(sym, sec_map).drop("fsym_id")
    joined = keys.join(splittable(newest, "fsym_company_id"), "fsym_company_id")
    if per == "company":
        return joined
    if per != "ticker":
        raise ValueError(f"per must be 'ticker' or 'company', not {per!r}")
    return latest_per_key(joined, ["ticker_region"], "DATE", ["fsym_company_id", *columns])


def next_estimates(
    sym: DataFrame,
    sec_map: DataFrame,
    estimates: DataFrame,
    *,
    as_of: dt.date,
    item: str = "EPS",
    columns: Sequence[str] = ESTIMATE_VALUES,
) -> DataFrame:
    """Nearest future valid estimate, one row per ``ticker_region``."""
    valid = current_estimates(estimates, item, as_of).select("fsym_id", "FE_FP_END", *columns)
    nearest = next_per_key(valid, ["fsym_id"], "FE_FP_END", as_of, columns)
    nearest = nearest.withColumnRenamed("fsym_id", "fsym_company_id")
    keys = securities(sym, sec_map).drop("fsym_id")
    joined = keys.join(splittable(nearest, "fsym_company_id"), "fsym_company_id")
    return next_per_key(
        joined, ["ticker_region"], "FE_FP_END", as_of, ["fsym_company_id", *columns]
    )


def _reported() -> dict[str, Column]:
    """Fundamentals under the names that rules and output columns use."""
    sales, income, equity = F.col("FF_SALES"), F.col("FF_NET_INCOME"), F.col("FF_COM_EQ")
    cash, assets = F.col("FF_FUNDS_OPER_GROSS"), F.col("FF_ASSETS")
    short, long = F.col("FF_DEBT_ST"), F.col("FF_DEBT_LT")
    return {
        "fiscal_date": F.col("DATE"),
        "revenue": sales,
        "net_income": income,
        "operating_cash_flow": cash,
        "current_eps": F.col("FF_EPS_BASIC"),
        "revenue_mm": millions(sales),
        "net_income_mm": millions(income),
        "operating_cf_mm": millions(cash),
        "profit_margin_pct": M.profit_margin_pct(income, sales),
        "cash_flow_margin_pct": M.cash_flow_margin_pct(cash, sales),
        "equity_ratio_pct": M.equity_ratio_pct(equity, assets),
        "total_debt": M.total_debt(short, long),
        "debt_to_equity": M.debt_to_equity(short, long, equity),
        "debt_to_equity_exact": M.debt_to_equity(short, long, equity, digits=None),
    }


def ticker_profile(
    sym: DataFrame,
    ff_map: DataFrame,
    ff: DataFrame,
    fe_map: DataFrame,
    fe: DataFrame,
    *,
    as_of: dt.date,
    min_date: dt.date,
    per: str = "ticker",
) -> DataFrame:
    """Per ticker: latest fundamentals, the next estimate where there is one, ratios and growth.

    Both inputs are already partitioned by ticker, so this join moves nothing.
    """
    reported = latest_fundamentals(sym, ff_map, ff, min_date=min_date, per=per)
    reported = reported.select("ticker_region", *[c.alias(n) for n, c in _reported().items()])
    spread = M.estimate_spread(F.col("FE_HIGH"), F.col("FE_LOW"), F.col("FE_MEAN"))
    expected = next_estimates(sym, fe_map, fe, as_of=as_of).select(
        "ticker_region",
        F.col("FE_FP_END").alias("next_period"),
        F.col("FE_MEAN").alias("forward_eps"),
        F.col("FE_NUM_EST").alias("analysts"),
        M.as_pct(spread).alias("spread_pct"),
    )
    both = reported.join(expected, "ticker_region", "left")
    both = both.withColumn("growth", M.eps_growth(F.col("current_eps"), F.col("forward_eps")))
    return both.withColumn("growth_pct", M.as_pct(F.col("growth")))


def _attach(holdings: DataFrame, profile: DataFrame) -> DataFrame:
    return holdings.join(splittable(profile, "ticker_region"), "ticker_region")


def holdings_fundamentals(
    holdings: DataFrame,
    sym: DataFrame,
    ff_map: DataFrame,
    ff: DataFrame,
    *,
    min_date: dt.date,
    instrument_type: str = "Equity",
    region: str | None = "US",
    rules: R.RuleSet | None = None,
    sort: bool = False,
) -> DataFrame:
    """Each position with its company's latest annual figures and a health label."""
    reported = latest_fundamentals(sym, ff_map, ff, min_date=min_date)
    reported = reported.select("ticker_region", *[c.alias(n) for n, c in _reported().items()])
    reported = reported.withColumn(
        "financial_health", (rules or R.financial_health()).column()
    )
    held = positions(holdings, instrument_type, region)
    frame = _attach(held, reported).select(
        "symbol",
        "shares_held",
        F.col("fiscal_date").alias("latest_fiscal_date"),
        F.col("revenue_mm").alias("revenue_millions"),
        F.col("net_income_mm").alias("net_income_millions"),
        F.col("current_eps").alias("earnings_per_share"),
        M.position_earnings(F.col("shares_held"), F.col("current_eps")).alias("my_share_of_earnings"),
        "profit_margin_pct",
        "equity_ratio_pct",
        "debt_to_equity",
        F.col("operating_cf_mm").alias("operating_cf_millions"),
        "financial_health",
    )
    return frame.orderBy(F.desc("shares_held"), "symbol") if sort else frame


def holdings_estimates(
    holdings: DataFrame,
    sym: DataFrame,
    fe_map: DataFrame,
    fe: DataFrame,
    *,
    as_of: dt.date,
    horizon_days: int | None = 365,
    item: str = "EPS",
    instrument_type: str = "Equity",
    region: str | None = "US",
    rules: R.RuleSet | None = None,
    sort: bool = False,
) -> DataFrame:
    """Each position with every valid estimate whose period ends within the horizon."""
    mean, high, low = F.col("FE_MEAN"), F.col("FE_HIGH"), F.col("FE_LOW")
    valid = current_estimates(fe, item, as_of, horizon_days)
    outlook = (
        valid.withColumns(
            {
                "analysts": F.col("FE_NUM_EST"),
                "spread": M.estimate_spread(high, low, mean),
                "eps_mean": mean,
            }
        )
        .withColumn("analyst_signal", (rules or R.analyst_signal()).column())
        .select(
            F.col("fsym_id").alias("fsym_company_id"),
            F.col("FE_FP_END").alias("fiscal_period_end"),
            mean.alias("eps_consensus"),
            F.col("FE_MEDIAN").alias("eps_median"),
            high.alias("eps_high_estimate"),
            low.alias("eps_low_estimate"),
            F.col("analysts").alias("num_analysts"),
            half_up(F.col("FE_STD_DEV")).alias("eps_std_deviation"),
            M.as_pct(F.col("spread")).alias("estimate_spread_pct"),
            "analyst_signal",
        )
    )
    by_ticker = securities(sym, fe_map).drop("fsym_id").join(outlook, "fsym_company_id")
    shares = F.col("shares_held")
    frame = (
        positions(holdings, instrument_type, region)
        .join(by_ticker, "ticker_region")
        .select(
            "symbol",
            "shares_held",
            "fiscal_period_end",
            "eps_consensus",
            "eps_median",
            "eps_high_estimate",
            "eps_low_estimate",
            "num_analysts",
            M.position_earnings(shares, F.col("eps_consensus")).alias("my_projected_earnings"),
            M.position_earnings(shares, F.col("eps_high_estimate")).alias("my_best_case_earnings"),
            M.position_earnings(shares, F.col("eps_low_estimate")).alias("my_worst_case_earnings"),
            "eps_std_deviation",
            "estimate_spread_pct",
            "analyst_signal",
        )
    )
    return frame.orderBy(F.desc("shares_held"), "fiscal_period_end", "symbol") if sort else frame


def investment_analysis(
    holdings: DataFrame,
    sym: DataFrame,
    ff_map: DataFrame,
    ff: DataFrame,
    fe_map: DataFrame,
    fe: DataFrame,
    *,
    as_of: dt.date,
    min_date: dt.date,
    instrument_type: str = "Equity",
    region: str | None = "US",
    recommendation: R.RuleSet | None = None,
    risk: R.RuleSet | None = None,
    sort: bool = False,
) -> DataFrame:
    """Fundamentals and the next estimate side by side, with a recommendation and a risk level."""
    profile = ticker_profile(sym, ff_map, ff, fe_map, fe, as_of=as_of, min_date=min_date)
    profile = profile.withColumns(
        {
            "investment_recommendation": (recommendation or R.investment_recommendation()).column(),
            "risk_level": (risk or R.risk_level()).column(),
        }
    )
    shares, now, ahead = F.col("shares_held"), F.col("current_eps"), F.col("forward_eps")
    frame = _attach(positions(holdings, instrument_type, region), profile).select(
        "symbol",
        "shares_held",
        F.col("fiscal_date").alias("latest_fiscal_date"),
        "revenue_mm",
        "net_income_mm",
        "current_eps",
        "profit_margin_pct",
        "debt_to_equity",
        "operating_cf_mm",
        F.col("next_period").alias("estimate_period"),
        "forward_eps",
        F.col("analysts").alias("num_analysts"),
        M.position_earnings(shares, now).alias("my_current_earnings_share"),
        M.position_earnings(shares, ahead).alias("my_projected_earnings_share"),
        M.earnings_increase(shares, now, ahead).alias("my_expected_earnings_growth"),
        F.col("growth_pct").alias("eps_growth_pct"),
        "investment_recommendation",
        "risk_level",
    )
    return frame.orderBy(F.desc("shares_held"), "symbol") if sort else frame


def portfolio_dashboard(
    holdings: DataFrame,
    sym: DataFrame,
    ff_map: DataFrame,
    ff: DataFrame,
    fe_map: DataFrame,
    fe: DataFrame,
    *,
    as_of: dt.date,
    min_date: dt.date,
    instrument_type: str = "Equity",
    region: str | None = "US",
    rules: tuple[R.RuleSet, R.RuleSet] | None = None,
    emoji: bool = False,
    unknown_label: str | None = None,
) -> DataFrame:
    """The core view: one row per position, 21 columns, with risk and action labels.

    ``rules`` is the pair (risk, action); ``emoji`` puts the marks in front of the labels.
    """
    risk, action = rules or (R.risk_assessment(), R.action_recommendation())
    profile = ticker_profile(sym, ff_map, ff, fe_map, fe, as_of=as_of, min_date=min_date)
    profile = profile.withColumns(
        {
            "risk_assessment": risk.column(emoji, unknown_label),
            "action_recommendation": action.column(emoji, unknown_label),
        }
    )
    shares, now, ahead = F.col("shares_held"), F.col("current_eps"), F.col("forward_eps")
    return _attach(positions(holdings, instrument_type, region), profile).select(
        "symbol",
        "shares_held",
        F.col("fiscal_date").alias("latest_fiscal_date"),
        "revenue_mm",
        "net_income_mm",
        "operating_cf_mm",
        "profit_margin_pct",
        "cash_flow_margin_pct",
        F.col("debt_to_equity").alias("debt_to_equity_ratio"),
        "equity_ratio_pct",
        "current_eps",
        "forward_eps",
        F.col("next_period").alias("next_estimate_period"),
        F.col("analysts").alias("num_analysts_covering"),
        F.col("spread_pct").alias("analyst_disagreement_pct"),
        M.position_earnings(shares, now).alias("my_current_annual_earnings"),
        M.position_earnings(shares, ahead).alias("my_projected_annual_earnings"),
        M.earnings_increase(shares, now, ahead).alias("my_expected_earnings_increase"),
        F.col("growth_pct").alias("projected_eps_growth_pct"),
        "risk_assessment",
        "action_recommendation",
    )


def leverage_dashboard(
    holdings: DataFrame,
    sym: DataFrame,
    ff_map: DataFrame,
    ff: DataFrame,
    fe_map: DataFrame,
    fe: DataFrame,
    *,
    as_of: dt.date,
    latest_only: bool = False,
    estimates: str = "next",
    region: str | None = "US",
    rules: tuple[R.RuleSet, R.RuleSet] | None = None,
) -> DataFrame:
    """The article form of the dashboard: unrounded figures, long-term leverage, growth only on a
    positive base, every instrument type and every annual row (or the latest with ``latest_only``),
    each with the next estimate.

    ``estimates="all"`` gives each annual row every valid estimate of its ticker, past periods
    included: one row per year and period, which annual data keeps few.
    """
    if estimates not in ("next", "all"):
        raise ValueError(f"estimates must be 'next' or 'all', not {estimates!r}")
    risk, action = rules or (R.leverage_risk(), R.growth_and_leverage_action())
    values = ("FF_EPS_BASIC", "FF_NET_INCOME", "FF_SALES", "FF_GROSS_INC", "FF_DEBT_LT", "FF_COM_EQ")
    if latest_only:
        annual = latest_fundamentals(sym, ff_map, ff, min_date=None, columns=values)
    else:
        annual = (
            securities(sym, ff_map)
            .drop("fsym_id")
            .join(
                ff.select(F.col("fsym_id").alias("fsym_company_id"), "DATE", *values),
                "fsym_company_id",
            )
        )
    if estimates == "next":
        expected = next_estimates(sym, fe_map, fe, as_of=as_of)
    else:
        valid = current_estimates(fe, "EPS", None).withColumnRenamed("fsym_id", "fsym_company_id")
        expected = securities(sym, fe_map).drop("fsym_id").join(valid, "fsym_company_id")
    expected = expected.select("ticker_region", "FE_MEAN")
    growth = M.eps_growth(F.col("FF_EPS_BASIC"), F.col("FE_MEAN"), base_guard="positive")
    profile = (
        annual.join(splittable(expected, "ticker_region"), "ticker_region", "left")
        .withColumns(
            {
                "growth_pct": M.as_pct(growth, digits=None),
                "debt_to_equity": M.long_term_leverage(F.col("FF_DEBT_LT"), F.col("FF_COM_EQ")),
            }
        )
        .withColumns({"risk_assessment": risk.column(), "action_recommendation": action.column()})
    )
    shares = F.col("shares_held")
    held = positions(holdings, None, region, keep=["instrument_type"])
    return _attach(held, profile).select(
        "symbol",
        "shares_held",
        "instrument_type",
        F.col("FF_EPS_BASIC").alias("eps_current"),
        F.col("FF_NET_INCOME").alias("net_income"),
        F.col("FF_SALES").alias("revenue"),
        F.col("FF_GROSS_INC").alias("gross_income"),
        M.position_earnings(shares, F.col("FF_EPS_BASIC"), None).alias("my_current_annual_earnings"),
        F.col("FE_MEAN").alias("consensus_eps_estimate"),
        M.position_earnings(shares, F.col("FE_MEAN"), None).alias("my_projected_annual_earnings"),
        F.col("growth_pct").alias("projected_eps_growth_pct"),
        F.col("debt_to_equity").alias("debt_to_equity_ratio"),
        "risk_assessment",
        "action_recommendation",
    )


def deep_dive(
    holdings: DataFrame,
    sym: DataFrame,
    ff_map: DataFrame,
    ff: DataFrame,
    fe_map: DataFrame,
    fe: DataFrame,
    *,
    as_of: dt.date,
    min_date: dt.date,
    symbol: str | None = None,
    instrument_type: str = "Equity",
    region: str | None = "US",
    sort: bool = False,
) -> DataFrame:
    """Year-by-year history of a holding against each of its forward periods.

    One row per year and forward period of a ticker: annual data keeps both counts small. The match
    is an equi-join on the ticker, so ``symbol=None`` covers the whole portfolio in one job.
    """
    held = positions(holdings, instrument_type, region)
    if symbol is not None:
        held = held.filter(F.col("symbol") == symbol)
        sym = sym.filter(F.col("ticker_region") == normalize_symbol(F.lit(symbol), region))
    past = ff.filter(F.col("DATE") >= F.lit(min_date))
    past = past.select(
        F.col("fsym_id").alias("fsym_company_id"), *[c.alias(n) for n, c in _reported().items()]
    ).select(
        "fsym_company_id",
        "fiscal_date",
        F.year("fiscal_date").alias("fiscal_year"),
        "revenue_mm",
        "net_income_mm",
        F.col("current_eps").alias("historical_eps"),
        "operating_cf_mm",
        "profit_margin_pct",
        "debt_to_equity",
    )
    ahead = current_estimates(fe, "EPS", as_of).select(
        F.col("fsym_id").alias("fsym_company_id"),
        F.col("FE_FP_END").alias("estimate_period"),
        F.col("FE_MEAN").alias("forward_eps"),
        F.col("FE_HIGH").alias("forward_eps_high"),
        F.col("FE_LOW").alias("forward_eps_low"),
        F.col("FE_NUM_EST").alias("analyst_count"),
    )
    history = securities(sym, ff_map).drop("fsym_id").join(past, "fsym_company_id")
    outlook = securities(sym, fe_map).drop("fsym_id").join(ahead, "fsym_company_id")
    timeline = history.drop("fsym_company_id").join(
        outlook.drop("fsym_company_id"), "ticker_region", "left"
    )
    shares, then, later = F.col("shares_held"), F.col("historical_eps"), F.col("forward_eps")
    frame = _attach(held, timeline).select(
        "symbol",
        "shares_held",
        "fiscal_date",
        "fiscal_year",
        "revenue_mm",
        "net_income_mm",
        "historical_eps",
        "operating_cf_mm",
        "profit_margin_pct",
        "debt_to_equity",
        M.position_earnings(shares, then).alias("my_annual_earnings_this_year"),
        "estimate_period",
        "forward_eps",
        "forward_eps_high",
        "forward_eps_low",
        "analyst_count",
        M.position_earnings(shares, later).alias("my_projected_annual_earnings"),
        M.as_pct(M.eps_growth(then, later)).alias("eps_growth_pct"),
    )
    return frame.orderBy(F.desc("fiscal_year"), "estimate_period", "symbol") if sort else frame
