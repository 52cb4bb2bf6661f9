"""As-of joins, intervals, change sets and tax lots against loops over the same rows."""

from __future__ import annotations

import datetime as dt
import re
import time
from collections import Counter, defaultdict
from decimal import Decimal
from pathlib import Path
from random import Random

import pytest
from pyspark.sql import functions as F

from foliospark import publish, queries as registered
from foliospark.fixtures import Tables
from foliospark.operators import asof, skew
from foliospark.operators.asof import asof_history, asof_join, asof_join_along, by_days, by_width, histories
from foliospark.operators.changes import change_set
from foliospark.operators.intervals import interval_join
from foliospark.operators.prefix import running
from foliospark.plans import history, taxlots
from foliospark.sources import introspect
from tests.conftest import DAY

FIRST = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else FIRST + dt.timedelta(days=n)


# As-of joins.


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("cut", [None, by_days(10), by_days(1)])
def test_asof_equals_a_loop(spark, forward, cut):
    random = Random(3)
    left = [(n, random.choice(["hot", "hot", "a", "b", None]), day(random.choice([*range(60), None]))) for n in range(200)]
    right = {(key, day(random.randrange(60))): n for n, key in enumerate(["hot"] * 15 + ["a"] * 4 + ["c"] * 4)}
    rows = [(key, at, value if value % 5 else None, f"v{value}") for (key, at), value in right.items()] + [("a", None, 1, "none")]
    joined = asof_join(
        spark.createDataFrame(left, "id int, key string, at date"),
        spark.createDataFrame(rows, "key string, known date, number int, text string"),
        ["key"],
        "at",
        "known",
        ["known", "number", "text"],
        forward=forward,
        cut=cut,
    )
    wanted = []
    for n, key, at in left:
        fit = [r for r in rows if r[0] == key and at and r[1] and (r[1] >= at if forward else r[1] <= at)]
        best = (min if forward else max)(fit, key=lambda r: r[1], default=(None,) * 4)
        wanted.append((n, key, at, *best[1:]))
    assert Counter(map(tuple, joined.collect())) == Counter(wanted)
    assert sum(row[3] is not None for row in wanted) > 50


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("cut", [None, by_days(10), by_days(1)])
def test_asof_of_rows_that_ride_along_equals_a_loop(spark, forward, cut):
    random = Random(6)
    moments = [(key, day(n)) for key in ("hot", "a", "b", None) for n in [*range(60), None] if random.random() < 0.6]
    left = [(n, key, at) for n, (key, at) in enumerate(moments)]
    right = {(key, day(random.randrange(60))): n for n, key in enumerate(["hot"] * 15 + ["a"] * 4 + ["c"] * 4 + [None] * 5)}
    rows = [(key, at, value if value % 5 else None, f"v{value}") for (key, at), value in right.items()] + [("a", None, 1, "none")]
    joined = asof_join(
        spark.createDataFrame(left, "id int, key string, at date"),
        spark.createDataFrame(rows, "key string, known date, number int, text string"),
        ["key"],
        "at",
        "known",
        ["known", "number", "text"],
        forward=forward,
        cut=cut,
        once=True,
    )
    assert joined.columns == ["id", "key", "at", "known", "number", "text"]
    wanted = []
    for n, key, at in left:
        fit = [r for r in rows if r[0] == key and key and at and r[1] and (r[1] >= at if forward else r[1] <= at)]
        best = (min if forward else max)(fit, key=lambda r: r[1], default=(None,) * 4)
        wanted.append((n, key, at, *best[1:]))
    assert Counter(map(tuple, joined.collect())) == Counter(wanted)
    assert sum(row[3] is not None for row in wanted) > 40
    text = introspect.explain_text(joined, "simple")
    assert "Join" not in text


@pytest.mark.parametrize("along", [0, 40, 10_000])
@pytest.mark.parametrize("cut", [None, by_days(10)])
def test_asof_of_repeated_rows_that_ride_along_equals_a_loop(spark, monkeypatch, along, cut):
    """All keys, the hot one or none ask apart; rows may come twice, and keys and times may be null."""
    random = Random(8)
    left = [(n // 2, random.choice(["hot", "hot", "a", "b", None]), day(random.choice([*range(60), None]))) for n in range(200)]
    left += left[:20]
    moments = {(key, random.randrange(60)) for key in ["hot"] * 15 + ["a"] * 4 + ["c"] * 4 + [None] * 3}
    right = [(key, day(n), n if n % 3 else None) for key, n in moments] + [("a", None, 1)]
    monkeypatch.setattr(asof, "ROWS_ALONG", along)
    joined = asof_join_along(
        spark.createDataFrame(left, "id int, key string, at date"),
        spark.createDataFrame(right, "key string, known date, number int"),
        ["key"],
        "at",
        "known",
        ["known", "number"],
        cut=cut,
    )
    assert joined.columns == ["id", "key", "at", "known", "number"]
    wanted = []
    for n, key, at in left:
        fit = [r for r in right if r[0] == key and key and at and r[1] and r[1] <= at]
        wanted.append((n, key, at, *max(fit, key=lambda r: r[1], default=(None,) * 3)[1:]))
    assert Counter(map(tuple, joined.collect())) == Counter(wanted)
    assert sum(row[3] is not None for row in wanted) > 50
    text = introspect.explain_text(joined, "simple")
    assert ("Join" in text) == (along < 10_000) and ("Union" in text)
    nothing = joined.limit(0).drop("known", "number")
    assert asof_join_along(nothing, nothing.select("key", "at", F.lit(1).alias("v")), ["key"], "at", "at", ["v"]).collect() == []


def test_asof_in_histories_equals_a_loop(spark):
    random = Random(7)
    left = [(n, random.choice(["a", "a", "b", "c", None]), day(random.choice([*range(60), None]))) for n in range(200)]
    right = [(key, day(n), n if n % 3 else None) for key in ("a", "b", "d", None) for n in range(5, 60, 7)] + [("a", None, 1)]
    known = spark.createDataFrame(right, "key string, known date, number int")
    found = asof_history(
        spark.createDataFrame(left, "id int, key string, at date"),
        histories(known, ["key"], "known", ["known", "number"]),
        ["key"],
        "at",
        ["known", "number"],
    )
    wanted = []
    for n, key, at in left:
        fit = [r for r in right if r[0] == key and key and at and r[1] and r[1] <= at]
        wanted += [(n, key, at, *max(fit, key=lambda r: r[1])[1:])] if fit else []
    assert Counter(map(tuple, found.collect())) == Counter(wanted)
    assert 20 < len(wanted) < 150


def test_asof_on_numbers_and_empty_sides(spark):
    left = spark.createDataFrame([("a", 5.5), ("a", -3.0), ("b", 1.0)], "key string, x double")
    right = spark.createDataFrame([("a", 5.5, 1), ("a", -10.0, 2)], "key string, y double, v int")
    for cut in (None, by_width(2.5)):
        found = asof_join(left, right, ["key"], "x", "y", ["v"], cut=cut)
        assert sorted(map(tuple, found.collect())) == [("a", -3.0, 2), ("a", 5.5, 1), ("b", 1.0, None)]
        assert asof_join(left.limit(0), right, ["key"], "x", "y", ["v"], cut=cut).collect() == []
        nothing = asof_join(left, right.limit(0), ["key"], "x", "y", ["v"], cut=cut)
        assert {row.v for row in nothing.collect()} == {None}


def test_asof_asks_once_for_each_moment_and_never_by_range(spark):
    left = spark.createDataFrame([("a", day(n % 3)) for n in range(50)], "key string, at date")
    right = spark.createDataFrame([("a", day(0), 1)], "key string, known date, v int")
    text = introspect.explain_text(asof_join(left, right, ["key"], "at", "known", ["v"], cut=by_days(5)), "simple")
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "HashAggregate(keys=[key" in text  # distinct moments, summed up before the shuffle


@pytest.mark.parametrize("least", [False, True])
@pytest.mark.parametrize("before", [False, True])
@pytest.mark.parametrize("cut", [None, by_days(7)])
def test_running_equals_a_loop(spark, least, before, cut):
    random = Random(4)
    rows = [(random.choice("ab"), day(n % 40), n, random.randrange(-9, 10)) for n in range(120)]
    frame = spark.createDataFrame(rows, "key string, day date, id int, v bigint")
    found = running(frame, ["key"], ["day", "id"], {"total": "v"}, least=least, before=before, cut=cut)
    wanted = []
    for row in rows:
        earlier = [r[3] for r in rows if r[0] == row[0] and (r[1:3] < row[1:3] or (r[1:3] == row[1:3] and not before))]
        wanted.append((*row, (min if least else sum)(earlier) if earlier else None))
    assert Counter(map(tuple, found.collect())) == Counter(wanted)


# Point in time.


ONE = Decimal(1)


def test_point_in_time_takes_what_was_known_that_day(spark, market, table):
    lots = table(
        "customer_holdings",
        [
            (1, "AAPL", ONE, DAY(2024, 6, 30), ONE, "IRA"),
            (2, "AAPL", ONE, DAY(2023, 6, 30), ONE, "IRA"),
            (3, "AAPL", ONE, DAY(2019, 1, 1), ONE, "IRA"),
            (4, "TSLA", ONE, DAY(2024, 6, 30), ONE, "IRA"),
            (5, "PLAIN", ONE, None, ONE, "IRA"),
        ],
    )
    _, sym, ff_map, ff, fe_map, fe = market.core
    for cut in (None, by_days(30)):
        rows = {r.customer_id: r for r in history.point_in_time(lots, sym, ff_map, ff, fe_map, fe, cut=cut).collect()}
        assert set(rows) == {1, 2, 3}
        assert (rows[1].fiscal_date, rows[1].current_eps, rows[1].forward_eps) == (DAY(2023, 12, 31), 4.0, 5.0)
        assert (rows[2].fiscal_date, rows[2].current_eps, rows[2].next_period) == (DAY(2022, 12, 31), 3.0, DAY(2023, 12, 31))
        assert (rows[3].fiscal_date, rows[3].current_eps, rows[3].growth_pct) == (None, None, None)


def test_the_revision_in_force_that_day(spark, market, table):
    lots = table("customer_holdings", [(n, "AAPL", ONE, d, ONE, "IRA") for n, d in enumerate([DAY(2023, 12, 31), DAY(2024, 1, 1)])])
    _, sym, ff_map, ff, fe_map, fe = market.core
    fe = fe.filter("FE_FP_END = '2024-12-31'").unionByName(fe.limit(0))
    rows = {r.customer_id: r.forward_eps for r in history.point_in_time(lots, sym, ff_map, ff, fe_map, fe).collect()}
    assert rows == {0: 9.9, 1: 5.0}


def test_point_in_time_plan(spark):
    text = introspect.explain_text(registered.BUILDERS["q41_point_in_time"](Tables(spark, "/root/testdata/sf0.001")), "simple")
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_point_in_time_derives_the_lots_once(spark):
    text = introspect.explain_text(registered.BUILDERS["q41_point_in_time"](Tables(spark, "/root/testdata/sf0.001")), "simple")
    assert sum("Scan" in line and "orders" in line for line in text.splitlines()) == 1


def exchanges(frame):
    return [line for line in introspect.explain_text(frame, "simple").splitlines() if re.search(r"\bExchange \w+partitioning", line)]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in files.mkString("\n").splitlines() if "/shuffle_" in name}


def test_point_in_time_shuffles_the_lots_twice_and_the_profile_once(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    frame = registered.BUILDERS["q41_point_in_time"](Tables(spark, "/root/testdata/sf0.001"))
    # Lines and orders by order, lots and one row per symbol by symbol.
    assert len(exchanges(frame)) == 4


@pytest.mark.parametrize("cut", [None, by_days(30)])
def test_point_in_time_at_finer_times_and_odd_symbols(spark, market, table, cut):
    rows = [(n, symbol, ONE, DAY(2024, 6, 30), ONE, "IRA") for n, symbol in enumerate(["AAPL", "aapl", "AAPL-US", None, "AAPL", "NONE"])]
    lots = table("customer_holdings", rows)
    _, sym, ff_map, ff, fe_map, fe = market.core
    for moments in (lots, lots.withColumn("purchase_date", F.col("purchase_date").cast("timestamp_ntz"))):
        found = history.point_in_time(moments, sym, ff_map, ff, fe_map, fe, cut=cut)
        assert found.schema["purchase_date"].dataType == moments.schema["purchase_date"].dataType
        found = {r.customer_id: (r.ticker_symbol, r.fiscal_date, r.forward_eps) for r in found.collect()}
        assert found == {n: (rows[n][1], DAY(2023, 12, 31), 5.0) for n in (0, 1, 2, 4)}


def test_kept_rows_leave_no_shuffle_files(spark):
    before, adaptive = shuffle_files(spark), spark.conf.get("spark.sql.adaptive.enabled")
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    for in_place in (False, True):
        rows = history.kept(counts, in_place=in_place)
        assert {(row.k, row["count"]) for row in rows.collect()} == {(k, 143 if k < 6 else 142) for k in range(7)}
    for _ in range(50):  # files go a moment later
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.adaptive.enabled") == adaptive
    again = rows.groupBy("k").agg(F.sum("count"))
    assert not exchanges(again)  # kept in place by k


def test_asof_price_derives_each_side_once(spark):
    text = introspect.explain_text(registered.BUILDERS["asof_price"](Tables(spark, "/root/testdata/sf0.001")), "simple")
    assert not any("Scan" in line and ("orders" in line or "lineitem" in line) for line in text.splitlines())


def test_asof_price_shuffles_lots_and_prices_once(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    frame = registered.BUILDERS["asof_price"](Tables(spark, "/root/testdata/sf0.001"))
    assert len(exchanges(frame)) == 1


# Intervals.


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("stretch_days", [1, 30, 1000])
def test_intervals_equal_a_range_join(spark, how, stretch_days):
    random = Random(5)
    left = [(n, random.choice(["a", "b", "c", None]), day(random.choice([*range(100), None]))) for n in range(150)]
    right = [("a", "x", None, day(20)), ("a", "y", day(20), day(50)), ("a", "z", day(60), None), ("b", "w", None, None)]
    right += [("c", "u", day(5), day(5)), ("c", "v", day(9), day(3)), ("c", "t", day(-900), day(-800)), ("c", "s", day(99), day(2000))]
    found = interval_join(
        spark.createDataFrame(left, "id int, key string, at date"),
        spark.createDataFrame(right, "key string, name string, since date, until date"),
        ["key"],
        "at",
        "since",
        "until",
        how=how,
        stretch_days=stretch_days,
    )
    wanted = []
    for n, key, at in left:
        fit = [r[1:] for r in right if r[0] == key and at and (not r[2] or r[2] <= at) and (not r[3] or at < r[3])]
        wanted += [(n, key, at, *r) for r in fit] or ([(n, key, at, None, None, None)] if how == "left" else [])
    assert Counter(map(tuple, found.collect())) == Counter(wanted)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [None, "key = 'a'", "true"])
@pytest.mark.parametrize("finer", [False, True])
def test_repeated_rows_and_overlaps_equal_a_range_join(spark, how, hot, finer):
    """Every left row meets every interval that holds on its day, also where rows come twice or intervals overlap."""
    left = [(n % 4, key, day(at)) for key in ("a", "b", None) for at in (3, 3, 40, 70, None) for n in range(3)]
    right = [("a", "x", None, day(50)), ("a", "y", day(30), day(80)), ("a", "y", day(30), day(80)), ("b", "z", day(71), None)]
    right += [(None, "n", None, None)]
    asked = spark.createDataFrame(left, "id int, key string, at date")
    if finer:
        asked = asked.withColumn("at", F.expr("cast(at as timestamp_ntz) + interval 5 hours"))
    intervals = spark.createDataFrame(right, "key string, name string, since date, until date")
    hot = None if hot is None else F.expr(hot)
    found = interval_join(asked, intervals, ["key"], "at", "since", "until", how=how, stretch_days=20, hot=hot)
    assert found.columns == ["id", "key", "at", "name", "since", "until"]
    wanted = []
    for n, key, at in left:
        fit = [r[1:] for r in right if r[0] == key and key and at and (not r[2] or r[2] <= at) and (not r[3] or at < r[3])]
        wanted += [(n, key, at, *r) for r in fit] or ([(n, key, at, None, None, None)] if how == "left" else [])
    found = found.withColumn("at", F.col("at").cast("date"))
    assert Counter(map(tuple, found.collect())) == Counter(wanted)
    assert max(Counter(wanted).values()) == 2 and len(wanted) > 20


def test_security_at_date_shuffles_lots_and_history_once(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    frame = registered.BUILDERS["q42_security_at_date"](Tables(spark, "/root/testdata/sf0.001"))
    # Lines and orders by order, lots and symbols by symbol and stretch.
    assert len(exchanges(frame)) == 4


@pytest.mark.parametrize("rows", [0, 30])
def test_hot_symbols_get_shorter_stretches_and_the_same_securities(spark, monkeypatch, rows):
    build = registered.BUILDERS["q42_security_at_date"]
    tables = Tables(spark, "/root/testdata/sf0.001")
    usual = build(tables)
    assert "ELSE 366" not in introspect.explain_text(usual, "simple")  # no symbol is hot
    monkeypatch.setattr(skew, "HOT_ROWS", rows)
    shorter = build(tables)
    assert Counter(map(tuple, shorter.collect())) == Counter(map(tuple, usual.collect()))
    text = introspect.explain_text(shorter, "simple")
    assert "THEN 7 ELSE 366" in text.replace("7.0", "7").replace("366.0", "366") and len(exchanges(shorter)) <= 4


def test_a_symbol_and_day_meet_one_security(spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    frame = registered.BUILDERS["q42_security_at_date"](tables)
    assert frame.count() == tables.customer_holdings.count()
    text = introspect.explain_text(frame, "simple")
    assert "_stretch" in text and "NestedLoop" not in text and "Cartesian" not in text
    with pytest.raises(ValueError):
        interval_join(frame, frame, ["ticker_symbol"], "purchase_date", "a", "b", how="right")


def test_exploded_intervals_are_not_broadcast(spark, tmp_path):
    """A small scan explodes into many stretches: its size in the plan is no bound for the driver."""
    left = spark.createDataFrame([(1, "a", day(3))], "id int, key string, at date")
    right = spark.createDataFrame([("a", "x", None, None)], "key string, name string, since date, until date")
    right.write.parquet(str(tmp_path / "right"))
    right = spark.read.parquet(str(tmp_path / "right"))
    found = interval_join(left, right, ["key"], "at", "since", "until", span=(day(0), day(4000)))
    assert found.count() == 1
    text = found._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in text.splitlines() if "BroadcastHashJoin" in line and "_stretch" in line]


# Change sets.

TABLE = "id bigint, name string, amount double, note string"


def version(spark, rows):
    return spark.createDataFrame(rows, TABLE)


def test_changes_by_key(spark):
    old = [(1, "a", 1.0, None), (2, "b", 2.0, "x"), (3, "c", None, ""), (4, "d", 4.0, "y"), (None, "n", 1.0, None), (7, "g", 1.0, "q")]
    new = [(1, "a", 1.0, None), (2, "b", 2.5, "x"), (3, "c", None, None), (5, "e", 5.0, "z"), (None, "n", 2.0, None)]
    new += [(7, "g", 1.0, "q"), (7, "g", 1.0, "q")]
    found = {row.id: row.change for row in change_set(version(spark, old), version(spark, new), ["id"]).collect()}
    assert found == {2: "changed", 3: "changed", 4: "removed", 5: "added", None: "changed", 7: "changed"}
    assert change_set(version(spark, old), version(spark, old), ["id"]).collect() == []


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("part-*.parquet")}


def test_a_refresh_rewrites_only_parts_that_differ(spark, tmp_path):
    path, parts = str(tmp_path / "snapshot"), 64
    rows = [(n, f"n{n}", float(n), None) for n in range(1000)]
    publish.publish_parts(version(spark, rows), path, ["id"], parts)
    before = files(path)
    changed = [(n, f"n{n}", n + (0.5 if n in (3, 500) else 0.0), None) for n in range(1000) if n != 77] + [(2000, "new", 1.0, "x")]
    counts = publish.refresh_parts(version(spark, changed), path, ["id"], parts)
    assert counts == {"added": 1, "removed": 1, "changed": 2}
    after = files(path)
    moved = {p.split("part=")[1].split("/")[0] for p in before.keys() ^ after.keys()}
    assert len(moved) <= 4 and len(after) >= 60
    assert all(before[p] == after[p] for p in before.keys() & after.keys())
    read = spark.read.parquet(path).drop("part").select("id", "name", "amount", "note")
    assert Counter(map(tuple, read.collect())) == Counter(changed)
    assert publish.refresh_parts(version(spark, changed), path, ["id"], parts) == {"added": 0, "removed": 0, "changed": 0}
    assert files(path) == after


def test_a_refresh_drops_parts_without_rows(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    rows = [(n, "a", 1.0, None) for n in range(40)]
    publish.publish_parts(version(spark, rows), path, ["id"], 200)
    publish.refresh_parts(version(spark, rows[:3]), path, ["id"], 200)
    assert Counter(map(tuple, spark.read.parquet(path).drop("part").collect())) == Counter(rows[:3])
    with pytest.raises(ValueError):
        publish.refresh_parts(version(spark, rows[:3]), path, ["id"], 50)


# Tax lots.

TRADES = "ticker string, day date, id int, quantity double, price double"


def made_trades(seed, count=150):
    random = Random(seed)
    make = lambda n: (random.choice("ab"), day(random.randrange(60)), n, random.randrange(1, 400) / 4, random.randrange(100, 999) / 100)
    return [make(n) for n in range(count)], [make(1000 + n) for n in range(count)]


def loop_fifo(buys, sales):
    """Per sale: shares matched and their cost, one lot after the other."""
    found, open_lots = {}, defaultdict(list)
    both = [(key, d, 0, n, q, p) for key, d, n, q, p in buys] + [(key, d, 1, n, q, p) for key, d, n, q, p in sales]
    for key, _, is_sale, n, quantity, price in sorted(both):
        quantity, price = Decimal(str(quantity)), Decimal(str(price))
        if not is_sale:
            open_lots[key].append([quantity, price])
            continue
        matched, cost = Decimal(0), Decimal(0)
        while quantity and open_lots[key]:
            take = min(quantity, open_lots[key][0][0])
            matched, cost, quantity = matched + take, cost + take * open_lots[key][0][1], quantity - take
            open_lots[key][0][0] -= take
            if not open_lots[key][0][0]:
                open_lots[key].pop(0)
        found[n] = (matched, cost)
    return found


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("cuts", [{}, {"cut": by_days(7), "share_cut": by_width(100)}])
def test_first_in_first_out_equals_a_loop(spark, seed, cuts):
    buys, sales = made_trades(seed)
    odd = [("a", None, 1, 5.0, 1.0), ("a", day(1), 2, 0.0, 1.0), ("a", day(1), 3, None, 1.0)]
    keys = ["ticker"]
    bought, sold = spark.createDataFrame(buys + odd, TRADES), spark.createDataFrame(sales + odd, TRADES)
    segments = taxlots.first_in_first_out(bought, sold, keys, **cuts)
    found = {row.id: (row.matched, row.cost, row.gain, row.proceeds) for row in taxlots.realised(sold, segments, keys).collect()}
    wanted = loop_fifo(buys, sales)
    assert {n: value[:2] for n, value in found.items()} == wanted
    prices = {s[2]: Decimal(str(s[4])) for s in sales}
    assert all(f[2] == wanted[n][0] * prices[n] - wanted[n][1] for n, f in found.items())
    assert any(wanted[s[2]][0] < Decimal(str(s[3])) for s in sales)  # some are short
    rows = segments.collect()
    assert len(rows) <= len(buys) + len(sales)
    taken = Counter()
    for row in rows:
        taken[row.lot_id] += row.quantity
        assert row.lot_day <= row.sale_day and row.quantity > 0
    assert all(taken[n] <= Decimal(str(q)) for _, _, n, q, _ in buys)


@pytest.mark.parametrize("rows", [0, 30])
def test_hot_tickers_are_cut_and_give_the_same_gains(spark, monkeypatch, rows):
    build = registered.BUILDERS["q43_realised_gains_fifo"]
    tables = Tables(spark, "/root/testdata/sf0.001")
    usual = build(tables)
    # The sales by trade, then by the join's keys, and the sums by them: lots and sales are not shuffled between the steps.
    assert len(exchanges(usual)) <= 3
    monkeypatch.setattr(skew, "HOT_ROWS", 30)
    condition = skew.hot(tables.traded_tickers, ["ticker_symbol"])
    counts = tables.traded_tickers.withColumn("hot", condition).groupBy("ticker_symbol", "hot").count().collect()
    assert {row.hot for row in counts} == {True, False} and all(row.hot for row in counts if row["count"] > 30)
    monkeypatch.setattr(skew, "HOT_ROWS", rows)
    assert Counter(map(tuple, build(tables).collect())) == Counter(map(tuple, usual.collect()))


def test_only_hot_keys_are_hot_where_every_bucket_is_full(spark, monkeypatch):
    """Common keys that share few buckets fill them: finer buckets tell the hot key, up to a limit."""
    monkeypatch.setattr(skew, "BUCKETS", 4)
    monkeypatch.setattr(skew, "MOST_FULL", 3)
    keys = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("key"))
    hot = skew.hot(keys, ["key"], 100)
    found = {row.key for row in keys.filter(hot).collect()}
    assert 7 in found and len(found) < 50
    assert skew.hot(keys, ["key"], 2000) is None
    monkeypatch.setattr(skew, "MOST_BUCKETS", 4)
    assert keys.filter(skew.hot(keys, ["key"], 100)).count() == 3000


def test_highest_cost_first_equals_a_loop(spark):
    buys, sales = made_trades(9, 60)
    sales = [(key, d + dt.timedelta(days=100), n, q, p) for key, d, n, q, p in sales]
    keys = ["ticker"]
    bought, sold = spark.createDataFrame(buys, TRADES), spark.createDataFrame(sales, TRADES)
    for cut in (None, by_width(50)):
        segments = taxlots.highest_cost_first(bought, sold, keys, share_cut=cut)
        found = {r.id: (r.matched, r.cost) for r in taxlots.realised(sold, segments, keys).collect()}
        dearest = sorted(buys, key=lambda b: (-b[4], b[1], b[2]))
        # Put the lots in that order by giving them days of their own.
        ordered = [(key, day(-1000 + n), n, q, p) for n, (key, _, _, q, p) in enumerate(dearest)]
        assert found == loop_fifo(ordered, sales)


def test_no_trades(spark):
    none = spark.createDataFrame([], TRADES)
    assert taxlots.realised(none, taxlots.first_in_first_out(none, none, ["ticker"]), ["ticker"]).collect() == []
    sale = spark.createDataFrame([("a", day(1), 1, 2.0, 3.0)], TRADES)
    row = taxlots.realised(sale, taxlots.first_in_first_out(none, sale, ["ticker"]), ["ticker"]).first()
    assert (row.matched, row.gain) == (0, 0)
