"""Queries on the simplified schema: coverage by ticker, annual facts by entity id and fiscal year.

The reference side (coverage with facts of one year) is put together first and narrowed to the
columns asked for; customer lots, of which one ticker may hold a large part, join it once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import rules as R
from ..operators.skew import splittable


def adapt_coverage(sym: DataFrame, sec_map: DataFrame, names: DataFrame, region: str = "US") -> DataFrame:
    """Coverage rows from the security schema; ``names`` maps ``ticker`` to ``proper_name``."""
    suffix = f"-{region.upper()}$"
    ids = sym.join(sec_map, "fsym_id").select(
        F.regexp_replace("ticker_region", suffix, "").alias("ticker"),
        F.col("fsym_company_id").alias("entity_id"),
    )
    return ids.join(names, "ticker").select(
        "ticker",
        "entity_id",
        "proper_name",
        F.lit("EQY").alias("entity_type"),
        F.lit(region.upper()).alias("iso_country"),
    )


def adapt_facts(facts: DataFrame) -> DataFrame:
    """Annual facts by entity and fiscal year from the security schema."""
    return facts.select(
        F.col("fsym_id").alias("entity_id"),
        F.year("DATE").alias("fiscal_year"),
        F.col("FF_SALES").alias("sales"),
        F.col("FF_NET_INCOME").alias("net_income"),
        F.col("FF_ASSETS").alias("total_assets"),
        F.col("FF_COM_EQ").alias("total_equity"),
        F.col("FF_EPS_BASIC").alias("eps_basic"),
    )


def adapt_eps(estimates: DataFrame) -> DataFrame:
    """Valid EPS estimates by entity and fiscal year from the security schema."""
    valid = estimates.filter((F.col("FE_ITEM") == "EPS") & F.col("CONS_END_DATE").isNull())
    return valid.select(
        F.col("fsym_id").alias("entity_id"),
        F.year("FE_FP_END").alias("fiscal_year"),
        F.col("FE_MEAN").alias("mean_estimate"),
        F.col("FE_HIGH").alias("high_estimate"),
        F.col("FE_LOW").alias("low_estimate"),
        F.col("FE_NUM_EST").alias("num_estimates"),
        F.col("FE_STD_DEV").alias("standard_deviation"),
    )


def annual_facts(facts: DataFrame, fiscal_year: int) -> DataFrame:
    return facts.filter(F.col("fiscal_year") == fiscal_year)


def annual_eps(eps: DataFrame, fiscal_year: int) -> DataFrame:
    return eps.filter(F.col("fiscal_year") == fiscal_year)


def _named(coverage: DataFrame) -> DataFrame:
    return coverage.select(F.col("ticker").alias("ticker_symbol"), "entity_id", "proper_name")


def _value() -> Column:
    return M.position_value(F.col("shares_held"), F.col("cost_basis")).alias("position_value")


def _reading_order(df: DataFrame, sort: bool, column: str) -> DataFrame:
    if not sort:
        return df
    return df.orderBy(F.col(column).desc_nulls_last(), "customer_id", "ticker_symbol")


def portfolio_fundamentals(
    holdings: DataFrame, coverage: DataFrame, facts: DataFrame, *, fiscal_year: int, sort: bool = False
) -> DataFrame:
    """Lots with company name, position value and the figures of one fiscal year."""
    year = annual_facts(facts, fiscal_year).select("entity_id", "sales", "net_income", "eps_basic")
    company = splittable(_named(coverage).join(year, "entity_id"), "ticker_symbol")
    lots = holdings.join(company, "ticker_symbol").select(
        "customer_id",
        "ticker_symbol",
        "proper_name",
        "shares_held",
        _value(),
        F.col("sales").alias("revenue"),
        "net_income",
        "eps_basic",
    )
    return _reading_order(lots, sort, "position_value")


def portfolio_estimates(
    holdings: DataFrame, coverage: DataFrame, eps: DataFrame, *, fiscal_year: int, sort: bool = False
) -> DataFrame:
    """Lots with the consensus EPS of one fiscal year and the earnings it implies."""
    year = annual_eps(eps, fiscal_year).select(
        "entity_id",
        F.col("mean_estimate").alias("consensus_eps"),
        "high_estimate",
        "low_estimate",
        F.col("num_estimates").alias("analyst_count"),
    )
    company = splittable(_named(coverage).join(year, "entity_id"), "ticker_symbol")
    lots = holdings.join(company, "ticker_symbol").select(
        "customer_id",
        "ticker_symbol",
        "proper_name",
        "shares_held",
        "consensus_eps",
        "high_estimate",
        "low_estimate",
        "analyst_count",
        (F.col("shares_held").cast("double") * F.col("consensus_eps")).alias("projected_earnings"),
    )
    return _reading_order(lots, sort, "projected_earnings")


def _company_outlook(
    coverage: DataFrame, facts: DataFrame, eps: DataFrame, facts_year: int, estimate_year: int
) -> DataFrame:
    past = annual_facts(facts, facts_year).select(
        "entity_id", "sales", "net_income", F.col("eps_basic").alias("eps_actual")
    )
    ahead = annual_eps(eps, estimate_year).select(
        "entity_id", F.col("mean_estimate").alias("eps_estimate")
    )
    return _named(coverage).join(splittable(past.join(ahead, "entity_id"), "entity_id"), "entity_id")


def portfolio_outlook(
    holdings: DataFrame,
    coverage: DataFrame,
    facts: DataFrame,
    eps: DataFrame,
    *,
    facts_year: int,
    estimate_year: int,
    rules: R.RuleSet | None = None,
    sort: bool = False,
) -> DataFrame:
    """Lots with reported and expected EPS, growth and a recommendation."""
    company = _company_outlook(coverage, facts, eps, facts_year, estimate_year)
    growth = M.eps_growth(F.col("eps_actual"), F.col("eps_estimate"))
    company = company.withColumn("growth", growth).select(
        "ticker_symbol",
        "proper_name",
        "eps_actual",
        "eps_estimate",
        M.as_pct(F.col("growth")).alias("eps_growth_pct"),
        (rules or R.growth_recommendation()).column(),
    )
    lots = holdings.join(splittable(company, "ticker_symbol"), "ticker_symbol").select(
        "customer_id",
        "ticker_symbol",
        "proper_name",
        _value(),
        "eps_actual",
        "eps_estimate",
        "eps_growth_pct",
        "recommendation",
    )
    return _reading_order(lots, sort, "position_value")


def top_positions(
    holdings: DataFrame,
    coverage: DataFrame,
    facts: DataFrame,
    eps: DataFrame,
    *,
    facts_year: int,
    estimate_year: int,
    k: int = 10,
) -> DataFrame:
    """The k largest lots by value along the four-way join."""
    company = _company_outlook(coverage, facts, eps, facts_year, estimate_year)
    lots = holdings.join(splittable(company, "ticker_symbol"), "ticker_symbol").select(
        "customer_id",
        "ticker_symbol",
        "proper_name",
        "shares_held",
        _value(),
        F.col("sales").alias("revenue"),
        "net_income",
        F.col("eps_estimate").alias("eps_est"),
    )
    order = ["customer_id", "ticker_symbol", "shares_held", "proper_name", "revenue", "eps_est"]
    return lots.orderBy(F.desc("position_value"), *order).limit(k)


def recent_holdings(holdings: DataFrame, coverage: DataFrame, *, since: dt.date) -> DataFrame:
    """Lots bought on or after a date, with their coverage row; filtered before the join."""
    recent = holdings.filter(F.col("purchase_date") >= F.lit(since))
    names = coverage.withColumn("ticker_symbol", F.col("ticker"))
    return recent.join(splittable(names, "ticker_symbol"), "ticker_symbol")


def positions_where(holdings: DataFrame, column: str, value: object) -> DataFrame:
    """Lots with one value in one column: a customer, an account type."""
    return holdings.filter(F.col(column) == value)


def ticker_shares(holdings: DataFrame) -> DataFrame:
    return holdings.select("ticker_symbol", "shares_held")


def customer_tickers(holdings: DataFrame) -> DataFrame:
    return holdings.select("customer_id", "ticker_symbol")


def positions_per_ticker(holdings: DataFrame) -> DataFrame:
    return holdings.groupBy("ticker_symbol").count()
