"""The dashboard at every date: what was known about a company on the day a lot was bought, not on one day for all."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import publish
from ..functions import metrics as M
from ..functions import rules as R
from ..functions.symbols import normalize_symbol
from ..operators.asof import Cut, asof_history, asof_join, by_days, histories
from ..operators.intervals import interval_join
from ..operators.resolve import securities
from ..operators.skew import hot as hot_keys
from ..operators.skew import splittable
from ..operators.temporal import latest_per_key

CUT_DAYS = 366
FACTS = ("FF_SALES", "FF_NET_INCOME", "FF_EPS_BASIC", "FF_COM_EQ", "FF_DEBT_ST", "FF_DEBT_LT")
ESTIMATES = ("FE_MEAN", "FE_NUM_EST")


def _by_ticker(sym: DataFrame, sec_map: DataFrame, rows: DataFrame, day: str, values: tuple[str, ...]) -> DataFrame:
    """One row per ticker and day, its ties broken as in the dashboard."""
    keys = securities(sym, sec_map).drop("fsym_id")
    rows = rows.select(F.col("fsym_id").alias("fsym_company_id"), day, *values)
    # By ticker alone, so that what follows by ticker needs no further shuffle.
    joined = keys.join(rows, "fsym_company_id").repartition("ticker_region")
    return latest_per_key(joined, ["ticker_region", day], day, ["fsym_company_id", *values])


def facts_by_ticker(sym: DataFrame, ff_map: DataFrame, ff: DataFrame) -> DataFrame:
    """Every annual row of each ticker."""
    return _by_ticker(sym, ff_map, ff, "DATE", FACTS).withColumnRenamed("DATE", "fiscal_date")


def revisions_by_ticker(sym: DataFrame, fe_map: DataFrame, fe: DataFrame, item: str = "EPS") -> DataFrame:
    """Every revision of an item's estimates: ``ticker_region, next_period, in_force_until`` and its values.

    A revision that is still valid is in force for ever.
    """
    ever = F.coalesce(F.col("CONS_END_DATE"), F.lit("9999-12-31").cast("date"))
    keys = securities(sym, fe_map).drop("fsym_id")
    rows = fe.filter(F.col("FE_ITEM") == item).select(
        F.col("fsym_id").alias("fsym_company_id"), F.col("FE_FP_END").alias("next_period"), ever.alias("closed"), *ESTIMATES
    )
    joined = keys.join(rows, "fsym_company_id").repartition("ticker_region")
    joined = joined.withColumn("in_force_until", F.date_sub("closed", 1))
    once = ["ticker_region", "next_period", "in_force_until"]
    return latest_per_key(joined, once, "in_force_until", ["fsym_company_id", *ESTIMATES]).select(*once, *ESTIMATES)


def point_in_time(
    lots: DataFrame,
    sym: DataFrame,
    ff_map: DataFrame,
    ff: DataFrame,
    fe_map: DataFrame,
    fe: DataFrame,
    *,
    date_col: str = "purchase_date",
    symbol_col: str = "ticker_symbol",
    region: str | None = "US",
    rules: tuple[R.RuleSet, R.RuleSet] | None = None,
    cut: Cut | None = by_days(CUT_DAYS),
) -> DataFrame:
    """Each lot with the figures of its own day: the latest annual row up to it, the next fiscal period from it on, and the
    revision of that period's estimate that was in force.

    Lots of symbols without any annual row stay out, as in the dashboard; a lot older than all of them has no
    figures and is labelled as such rows are.
    """
    risk, action = rules or (R.risk_assessment(), R.action_recommendation())
    held = lots.filter(F.col(date_col).isNotNull())
    facts = facts_by_ticker(sym, ff_map, ff)
    # A symbol has one row per day here, however many lots: whole days need no cut, finer times do.
    days = held.select(F.col(symbol_col).alias("_symbol"), date_col).distinct()
    days = days.withColumn("ticker_region", normalize_symbol(F.col("_symbol"), region))
    known_companies = ff.select(F.col("fsym_id").alias("fsym_company_id")).distinct()
    tickers = securities(sym, ff_map).join(known_companies, "fsym_company_id", "left_semi").select("ticker_region").distinct()
    days = days.join(tickers, "ticker_region", "left_semi")
    cut = None if isinstance(lots.schema[date_col].dataType, T.DateType) else cut
    known = asof_join(
        days, facts, ["ticker_region"], date_col, "fiscal_date", ["fiscal_date", *FACTS], cut=cut, once=True
    )
    revisions = revisions_by_ticker(sym, fe_map, fe).filter(F.col("next_period").isNotNull())
    periods = revisions.select("ticker_region", "next_period").distinct()
    ahead = asof_join(
        known, periods, ["ticker_region"], date_col, "next_period", ["next_period"], forward=True, cut=cut, once=True
    )
    in_force = ["in_force_until", *ESTIMATES]
    expected = asof_join(
        ahead, revisions, ["ticker_region", "next_period"], date_col, "in_force_until", in_force, forward=True, once=True
    )
    # Days with the same rows in force follow each other: one row for the first of them stands for all.
    source = F.struct("fiscal_date", "next_period", "in_force_until")
    symbol = ["ticker_region", "_symbol"]
    before = F.lag(source).over(W.partitionBy(*symbol).orderBy(date_col))
    runs = expected.withColumn("_goes_on", source.eqNullSafe(before)).filter("NOT _goes_on")
    profile = runs.select(*symbol, date_col, *(c.alias(n) for n, c in _figures().items()))
    profile = profile.withColumn("growth", M.eps_growth(F.col("current_eps"), F.col("forward_eps")))
    profile = profile.withColumns(
        {
            "growth_pct": M.as_pct(F.col("growth")),
            "risk_assessment": risk.column(),
            "action_recommendation": action.column(),
        }
    )
    shares, now, later = F.col("shares_held"), F.col("current_eps"), F.col("forward_eps")
    figures = ("fiscal_date", "net_income", "profit_margin_pct", "debt_to_equity", "current_eps", "next_period")
    figures += ("forward_eps", "analysts", "growth_pct", "risk_assessment", "action_recommendation")
    # The lots meet one row per symbol, worked out before, so only that and the lots themselves are shuffled with them.
    profile = kept(histories(profile, symbol, date_col, figures)).select(F.col("_symbol").alias(symbol_col), "_history")
    found = asof_history(held, splittable(profile, symbol_col), [symbol_col], date_col, figures)
    return found.select(
        *lots.columns,
        *figures[:-2],
        M.position_earnings(shares.cast("double"), now).alias("current_earnings"),
        M.position_earnings(shares.cast("double"), later).alias("projected_earnings"),
        *figures[-2:],
    )


@contextlib.contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def kept(frame: DataFrame, *, in_place: bool = False) -> DataFrame:
    """The frame's rows, worked out once into the folder that all executors share, so a lost executor loses none.

    Later reads start from those files, so the shuffle files behind them go at once, not when the driver happens to collect its
    garbage. ``in_place`` lets Spark know later by which keys the rows lie together, so that what follows by them shuffles nothing;
    adaptive execution would forget that and is off for such a frame, which must therefore hold no join on a skewed key.
    """
    spark, context = frame.sparkSession, frame.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(f"{publish.working_folder(spark)}/checkpoints")
    values = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if in_place:
        values["spark.sql.adaptive.enabled"] = "false"
    with _settings(spark, **values):
        return frame.select("*").checkpoint()


def _figures() -> dict[str, Column]:
    sales, income, equity = F.col("FF_SALES"), F.col("FF_NET_INCOME"), F.col("FF_COM_EQ")
    short, long = F.col("FF_DEBT_ST"), F.col("FF_DEBT_LT")
    return {
        "fiscal_date": F.col("fiscal_date"),
        "net_income": income,
        "current_eps": F.col("FF_EPS_BASIC"),
        "profit_margin_pct": M.profit_margin_pct(income, sales),
        "debt_to_equity": M.debt_to_equity(short, long, equity),
        "debt_to_equity_exact": M.debt_to_equity(short, long, equity, digits=None),
        "next_period": F.col("next_period"),
        "forward_eps": F.col("FE_MEAN"),
        "analysts": F.col("FE_NUM_EST"),
    }


def securities_at(
    lots: DataFrame,
    symbol_history: DataFrame,
    *,
    date_col: str = "purchase_date",
    symbol_col: str = "ticker_symbol",
    region: str | None = "US",
    how: str = "inner",
    traded: DataFrame | None = None,
    **span: object,
) -> DataFrame:
    """Each lot with the security its symbol stood for on the lot's day.

    ``symbol_history``: ``ticker_region, fsym_id, valid_from, valid_to``; a symbol's intervals do not overlap, open
    ends are null, ``valid_to`` is the first day it no longer holds. Symbols that come up too often in ``traded``, the symbol column of
    the lots or of what they are made from, are joined in shorter stretches.
    """
    symbol = normalize_symbol(F.col(symbol_col), region).alias("ticker_region")
    held = lots.withColumn("ticker_region", symbol)
    keys = ["ticker_region"]
    hot = None if traded is None else hot_keys(traded.select(symbol), keys)
    return interval_join(held, symbol_history, keys, date_col, "valid_from", "valid_to", how=how, hot=hot, **span)
