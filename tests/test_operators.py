from __future__ import annotations

import datetime as dt
import random

import pytest
from tests.conftest import AS_OF, MIN_DATE, rows_by
from pyspark.sql import functions as F

from foliospark.operators import resolve as res
from foliospark.operators import temporal
from foliospark.operators.distribution import share_of_total
from foliospark.operators.trace import STEPS, join_trace
from foliospark.plans import lookup

DAY = dt.date


def test_latest_per_key_breaks_ties_and_orders_null_last(spark):
    frame = spark.createDataFrame(
        [
            ("a", DAY(2020, 1, 1), 1),
            ("a", DAY(2021, 1, 1), 3),
            ("a", DAY(2021, 1, 1), 2),
            ("a", None, 9),
            ("b", None, 5),
        ],
        "k string, d date, v int",
    )
    got = temporal.latest_per_key(frame, ["k"], "d", ["v"])
    assert {r.k: (r.d, r.v) for r in got.collect()} == {"a": (DAY(2021, 1, 1), 2), "b": (None, 5)}
    assert got.columns == ["k", "d", "v"]
    assert temporal.latest_per_key(frame, ["k"], "d", ["v"], k=2).count() == 3


def test_next_per_key_includes_the_day_itself(spark):
    frame = spark.createDataFrame(
        [("a", DAY(2024, 6, 29)), ("a", DAY(2024, 6, 30)), ("a", DAY(2024, 7, 1)), ("b", DAY(2024, 1, 1))],
        "k string, d date",
    )
    got = temporal.next_per_key(frame, ["k"], "d", AS_OF, ["d"]).collect()
    assert [tuple(r) for r in got] == [("a", AS_OF)]


def test_tie_breakers_are_required(spark):
    with pytest.raises(ValueError, match="tie_breakers"):
        temporal.latest_per_key(spark.range(1), ["id"], "id", [])


def test_latest_per_key_against_brute_force(spark):
    rng = random.Random(7)
    rows = [
        (rng.choice("abcde"), DAY(2020, 1, 1) + dt.timedelta(rng.randrange(20)), rng.randrange(1000))
        for _ in range(500)
    ]
    frame = spark.createDataFrame(rows, "k string, d date, v int").repartition(5)
    got = {r.k: (r.d, r.v) for r in temporal.latest_per_key(frame, ["k"], "d", ["v"]).collect()}
    wanted = {}
    for k, d, v in rows:
        best = wanted.get(k)
        if best is None or (d, -v) > (best[0], -best[1]):
            wanted[k] = (d, v)
    assert got == wanted


def test_current_estimates_bounds(market):
    assert temporal.current_estimates(market.fe, "EPS", None).count() == 8
    assert temporal.current_estimates(market.fe, "EPS", AS_OF).count() == 7
    periods = temporal.current_estimates(market.fe, "EPS", AS_OF, 184).select("FE_FP_END").distinct()
    assert [r[0] for r in periods.collect()] == [DAY(2024, 12, 31)]
    assert temporal.current_estimates(market.fe, "EPS", AS_OF, 183).count() == 0


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_split_by_date(spark, kind):
    times = ["2024-06-29 23:59:59", "2024-06-30 00:00:00", "2024-06-30 18:00:00", "2024-07-01 00:00:00"]
    frame = spark.createDataFrame([(t,) for t in times], "t string")
    frame = frame.select(F.col("t").cast("timestamp_ntz").cast(kind).alias("t"))
    today, earlier = temporal.split_by_date(frame, frame, "t", AS_OF)
    assert (today.count(), earlier.count()) == (2, 1)


def test_resolve_inner_and_left(market):
    found = rows_by(res.resolve(market.holdings, market.sym, market.ff_map), "symbol")
    assert found["aapl"]["fsym_company_id"] == "AAPL-C"
    assert "TSLA" not in found
    everything = res.resolve(market.holdings, market.sym, market.ff_map, how="left")
    assert everything.count() == market.holdings.count()
    assert rows_by(everything, "symbol")["TSLA"]["fsym_id"] is None


def test_left_resolve_keeps_the_security_without_company(market, table):
    no_links = table("ff_sec_map", [("MSFT-S", "MSFT-C")])
    row = rows_by(res.resolve(market.holdings, market.sym, no_links, how="left"), "symbol")["aapl"]
    assert (row["fsym_id"], row["fsym_company_id"]) == ("AAPL-S", None)


def test_coverage_check_partitions_the_holdings(market):
    status = res.coverage_check(market.holdings, market.sym)
    counts = {r["status"]: r["count"] for r in status.groupBy("status").count().collect()}
    assert counts == {"FOUND": 8, "NOT FOUND": 2}
    marked = res.coverage_check(market.holdings, market.sym, emoji=True).select("status").distinct()
    assert {r[0] for r in marked.collect()} == {"✅ FOUND", "❌ NOT FOUND"}


def test_coverage_check_after_a_limit(market):
    assert res.coverage_check(market.holdings.limit(5), market.sym).count() == 5


def test_symbology_lookup_by_list_and_by_frame(market):
    names = ["AAPL-US", "MSFT-US", "NONE-US"]
    by_list = res.symbology_lookup(market.sym, names)
    frame = market.sym.sparkSession.createDataFrame([(n,) for n in names * 3], "ticker_region string")
    by_frame = res.symbology_lookup(market.sym, frame)
    assert sorted(map(tuple, by_list.collect())) == sorted(map(tuple, by_frame.collect()))
    assert by_list.count() == 2
    assert res.symbology_lookup(market.sym, names, limit=1).count() == 1


def test_matched_symbols(market):
    assert res.matched_symbols(market.holdings, market.sym).count() == 8
    assert res.matched_symbols(market.holdings, market.sym, limit=3).count() == 3


def test_known_and_unmatched_split_the_tickers(spark, table):
    coverage = table("sym_coverage", [("A", "1", "a", "EQY", "US"), ("C", "3", "c", "EQY", "US")])
    lots = spark.createDataFrame([("A",), ("A",), ("B",)], "ticker_symbol string")
    assert [r.ticker for r in res.known_tickers(coverage, lots).collect()] == ["A"]
    assert [tuple(r) for r in res.unmatched_holdings(coverage, lots).collect()] == [("B", None, None)]
    assert sorted(r[0] for r in res.held_tickers(lots).collect()) == ["A", "B"]


def test_mapping_chain(market):
    one = lookup.mapping_chain(market.sym, market.ff_map, "MSFT-US", limit=5)
    assert [tuple(r) for r in one.collect()] == [("MSFT-US", "MSFT-S", "MSFT-C")]
    assert lookup.mapping_chain(market.sym, market.ff_map).count() == 7


def test_holdings_by_size(market):
    shares = [r.number_of_shares for r in lookup.holdings_by_size(market.holdings, sort=True).collect()]
    assert len(shares) == 9
    assert shares == sorted(shares, reverse=True)
    assert lookup.holdings_by_size(market.holdings, None).count() == 10


def test_security_history(market):
    args = (market.sym, market.ff_map, market.ff)
    one = lookup.security_history(*args, min_date=DAY(2022, 1, 1), ticker="aapl")
    assert [r.fiscal_date.year for r in one.collect()] == [2023, 2022]
    assert one.first().portfolio_ticker == "AAPL"
    assert lookup.security_history(*args, min_date=DAY(2000, 1, 1), k=1).count() == 7


def naive_trace(holdings, sym, sec_map, facts, min_date):
    """The left-join chain, row by row."""
    chain = [(s, t) for s, t in holdings]
    step2 = [(s, i) for s, t in chain for tt, i in sym if tt == t and i is not None]
    step3 = [(s, c) for s, i in step2 for ii, c in sec_map if ii == i and c is not None]
    step4 = [(s, c) for s, c in step3 for cc, d in facts if cc == c and d >= min_date]
    return [(len(step), len({s for s, _ in step})) for step in (chain, step2, step3, step4)]


def test_join_trace_with_fan_out_and_duplicates(spark, table):
    rng = random.Random(3)
    symbols = [f"T{i}" for i in range(8)]
    holdings = [rng.choice(symbols) for _ in range(60)]
    sym = [(f"{rng.choice(symbols[:6])}-US", rng.choice(["S1", "S2", "S3", None])) for _ in range(12)]
    links = [(rng.choice(["S1", "S2", "S4"]), rng.choice(["C1", "C2", None])) for _ in range(9)]
    facts = [(rng.choice(["C1", "C3"]), DAY(2020 + rng.randrange(5), 1, 1)) for _ in range(15)]
    got = join_trace(
        table("equity_holdings", [("Equity", s, 1.0) for s in holdings]),
        table("sym_ticker_region", sym),
        table("ff_sec_map", links),
        spark.createDataFrame(facts, "fsym_id string, DATE date"),
        min_date=MIN_DATE,
    )
    counts = {r.step: (r.row_count, r.symbol_count) for r in got.collect()}
    wanted = naive_trace([(s, f"{s}-US") for s in holdings], sym, links, facts, MIN_DATE)
    assert [counts[step] for step in STEPS] == wanted
    assert wanted[3][0] > 0


def test_join_trace_of_nothing(market):
    empty = market.holdings.limit(0)
    got = join_trace(empty, market.sym, market.ff_map, market.ff, min_date=MIN_DATE)
    assert [r.row_count for r in got.collect()] == [0, 0, 0, 0]


def test_counts_never_rise_along_unique_maps(market):
    got = join_trace(market.holdings, market.sym, market.ff_map, market.ff, min_date=MIN_DATE)
    counts = {r.step: r.row_count for r in got.collect()}
    assert counts[STEPS[0]] >= counts[STEPS[1]] >= counts[STEPS[2]]


def test_share_of_total_text(spark):
    frame = spark.createDataFrame([("Buy", 2), ("Sell", 1), ("Hold", 13)], "label string, n bigint")
    got = {r.label: r for r in share_of_total(frame, "n", "label", "text").collect()}
    assert got["Buy"].text == "Buy: 2 stocks (12.5%)"
    assert got["Sell"].text == "Sell: 1 stocks (6.3%)"
    assert got["Hold"].pct_of_portfolio == 81.3
    assert abs(sum(r.pct_of_portfolio for r in got.values()) - 100) < 0.3
