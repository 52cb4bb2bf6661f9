"""Row counts along the resolution chain, without materialising the chain."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .resolve import with_ticker
from .skew import splittable

# The labels of the four steps, first to last.
STEPS = (
    "Portfolio Equities",
    "After sym_ticker_region join",
    "After ff_sec_map join",
    "After ff_basic_af join",
)


def join_trace(
    holdings: DataFrame,
    sym: DataFrame,
    sec_map: DataFrame,
    facts: DataFrame,
    *,
    min_date: dt.date | None = None,
    region: str | None = "US",
) -> DataFrame:
    """Joined rows and distinct symbols that survive each left-join step.

    A left-join chain has as many rows as the products of its match counts, so each table is counted
    per key first and only the counts are joined. One pass gives all four steps, and a key with a
    great many rows never fans out.
    """
    if min_date is not None:
        facts = facts.filter(F.col("DATE") >= F.lit(min_date))
    fact_rows = facts.groupBy(F.col("fsym_id").alias("fsym_company_id")).agg(
        F.count("*").alias("facts")
    )
    map_rows = (
        sec_map.filter(F.col("fsym_company_id").isNotNull())
        .groupBy("fsym_id", "fsym_company_id")
        .agg(F.count("*").alias("links"))
        .join(splittable(fact_rows, "fsym_company_id"), "fsym_company_id", "left")
        .groupBy("fsym_id")
        .agg(
            F.sum("links").alias("mapped"),
            F.sum(F.col("links") * F.coalesce("facts", F.lit(0))).alias("with_facts"),
        )
    )
    sym_rows = (
        sym.filter(F.col("fsym_id").isNotNull())
        .groupBy("ticker_region", "fsym_id")
        .agg(F.count("*").alias("ids"))
        .join(splittable(map_rows, "fsym_id"), "fsym_id", "left")
        .groupBy("ticker_region")
        .agg(
            F.sum("ids").alias("step2"),
            F.sum(F.col("ids") * F.coalesce("mapped", F.lit(0))).alias("step3"),
            F.sum(F.col("ids") * F.coalesce("with_facts", F.lit(0))).alias("step4"),
        )
    )
    per_symbol = (
        with_ticker(holdings.select("symbol"), region=region)
        .groupBy("symbol", "ticker_region")
        .agg(F.count("*").alias("step1"))
        .join(sym_rows, "ticker_region", "left")
    )
    lots = F.col("step1")
    totals = per_symbol.agg(
        F.sum(lots).alias("rows1"),
        F.count("symbol").alias("symbols1"),
        *[
            F.sum(lots * F.coalesce(f"step{n}", F.lit(0))).alias(f"rows{n}")
            for n in (2, 3, 4)
        ],
        *[F.count(F.when(F.col(f"step{n}") > 0, 1)).alias(f"symbols{n}") for n in (2, 3, 4)],
    )
    steps = [
        F.struct(
            F.lit(label).alias("step"),
            F.coalesce(f"rows{n}", F.lit(0)).alias("row_count"),
            F.col(f"symbols{n}").alias("symbol_count"),
        )
        for n, label in enumerate(STEPS, 1)
    ]
    return totals.select(F.inline(F.array(*steps)))
