"""Patterns that combine live external tables with managed ones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions.numeric import exact_sum
from ..operators.skew import splittable
from ..operators.temporal import split_by_date


def _of_year(financials: DataFrame, fiscal_year: int) -> DataFrame:
    wanted = financials.filter(F.col("fiscal_year") == fiscal_year)
    return wanted.withColumnRenamed("ticker", "ticker_symbol").drop("fiscal_year")


def holdings_financials(holdings: DataFrame, financials: DataFrame, *, fiscal_year: int) -> DataFrame:
    """Lots with revenue and net income of one fiscal year."""
    companies = splittable(_of_year(financials, fiscal_year), "ticker_symbol")
    return holdings.join(companies, "ticker_symbol").select(
        "customer_id", "ticker_symbol", "shares_held", "revenue", "net_income"
    )


def top_investments(
    holdings: DataFrame, financials: DataFrame, *, fiscal_year: int, k: int = 20
) -> DataFrame:
    """The k largest lots by invested amount."""
    invested = M.position_value(F.col("shares_held"), F.col("cost_basis"))
    companies = splittable(_of_year(financials, fiscal_year), "ticker_symbol")
    lots = holdings.join(companies, "ticker_symbol").select(
        "customer_id", "ticker_symbol", invested.alias("investment"), "revenue", "net_income"
    )
    order = ["customer_id", "ticker_symbol", "revenue", "net_income"]
    return lots.orderBy(F.desc("investment"), *order).limit(k)


def customer_rollup(holdings: DataFrame, financials: DataFrame, *, fiscal_year: int) -> DataFrame:
    """Positions, value and loss-making positions per customer.

    Financials shrink to one row per ticker first, with the number of rows they stand for, so the
    join never multiplies lots; the counts give what the row-by-row join would.
    """
    companies = (
        _of_year(financials, fiscal_year)
        .groupBy("ticker_symbol")
        .agg(
            F.count("*").alias("matches"),
            F.count(F.when(F.col("net_income") < 0, 1)).alias("losses"),
        )
    )
    invested = M.position_value(F.col("shares_held"), F.col("cost_basis"))
    lots = holdings.select("customer_id", "ticker_symbol", invested.alias("invested"))
    return (
        lots.join(splittable(companies, "ticker_symbol"), "ticker_symbol")
        .groupBy("customer_id")
        .agg(
            F.sum("matches").alias("positions"),
            F.sum(F.col("invested") * F.col("matches")).alias("portfolio_value"),
            F.sum("losses").alias("risk_count"),
        )
    )


def enrich_transactions(transactions: DataFrame, countries: DataFrame) -> DataFrame:
    """Transactions with country and region names; Spark broadcasts the table if it is small."""
    names = countries.select(F.col("code").alias("country_code"), "country", "region")
    return transactions.join(names, "country_code").select(
        "transaction_id", "customer_id", "amount", "country", "region"
    )


def revenue_by_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Quantities summed per product at the source, priced, then summed per category."""
    sold = sales.groupBy("product_id").agg(F.sum("quantity").alias("total_qty"))
    priced = products.select("product_id", "category", "price").join(sold, "product_id")
    amount = F.col("total_qty").cast("double") * F.col("price")
    return priced.groupBy("category").agg(exact_sum(amount).cast("double").alias("revenue"))


def live_and_history(live: DataFrame, history: DataFrame, *, as_of: dt.date) -> DataFrame:
    """Order count and revenue of today (live source) and of all earlier days (history)."""
    today, earlier = split_by_date(live, history, "order_date", as_of)

    def totals(orders: DataFrame, label: str) -> DataFrame:
        return orders.agg(
            F.count("*").alias("order_count"),
            exact_sum(F.col("total_amount")).cast("double").alias("revenue"),
        ).select(F.lit(label).alias("source"), "order_count", "revenue")

    return totals(today, "Real-Time").unionByName(totals(earlier, "Historical"))
