"""Attribution against a loop over the same rows."""

from __future__ import annotations

from collections import defaultdict
from decimal import Decimal
from math import prod
from random import Random

import pytest

from foliospark import queries as registered
from foliospark.fixtures import Tables
from foliospark.plans import performance
from foliospark.sources import introspect

FIELDS = "year int, sector string, region string, start decimal(18,4), end decimal(18,4)"
DIMS = ["sector", "region"]


def attributed(spark, held, market):
    held = spark.createDataFrame(held, "account string, " + FIELDS)
    market = spark.createDataFrame(market, FIELDS)
    return performance.attribution(held, market, ["account"], "year", DIMS)


def by_loop(held, market):
    """Effects by account and leaf segment, linked, from plain dictionaries."""

    def grouped(rows):
        sums = defaultdict(lambda: [0.0, 0.0])
        for *where, start, end in rows:
            sums[tuple(where)][0] += start
            sums[tuple(where)][1] += end
        return sums

    found = defaultdict(lambda: [0.0, 0.0, 0.0])
    benchmark = grouped(market)
    for account in {row[0] for row in held}:
        own = grouped([row[1:] for row in held if row[0] == account])
        years = sorted({year for year, _, _ in own})
        whole = {
            (side, y): [sum(v[i] for k, v in rows.items() if k[0] == y) for i in (0, 1)]
            for side, rows in (("own", own), ("market", benchmark))
            for y in years
        }
        grown = {at: end / start for at, (start, end) in whole.items()}
        for y in years:
            carried = prod(grown["own", e] for e in years if e < y) * prod(grown["market", e] for e in years if e > y)
            for place in {k for k in (*own, *benchmark) if k[0] == y}:
                a, b = own.get(place, [0, 0]), benchmark.get(place, [0, 0])
                w, v = a[0] / whole["own", y][0], b[0] / whole["market", y][0]
                rb = b[1] / b[0] if b[0] else grown["market", y]
                rp = a[1] / a[0] if a[0] else rb
                parts = (w - v) * (rb - grown["market", y]), v * (rp - rb), (w - v) * (rp - rb)
                effects = found[(account, *place[1:])]
                for i, part in enumerate(parts):
                    effects[i] += part * carried
    return found


def some_rows(seed):
    random = Random(seed)
    places = [(s, r) for s in ("tech", "food", None) for r in ("north", "south")]

    def row(*front):
        return (*front, random.randrange(2015, 2019), *random.choice(places), random.randrange(1, 900), random.randrange(1, 900))

    held = [row(random.choice(["x", "y"])) for _ in range(60)]
    held += [("hot", y, "tech", "north", 7, 8) for y in (2015, 2016, 2017, 2018) for _ in range(25)]
    return held, [row() for _ in range(80)] + [(y, "oil", "south", 50, 60) for y in (2015, 2016, 2017, 2018)]


def decimals(rows):
    return [tuple(Decimal(v) if i >= len(row) - 2 and v is not None else v for i, v in enumerate(row)) for row in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_attribution_equals_a_loop(spark, seed):
    held, market = some_rows(seed)
    rows = attributed(spark, decimals(held), decimals(market)).collect()
    leaves = {(r.account, r.sector, r.region): r for r in rows if r.level == "sector,region"}
    expected = by_loop(held, market)
    assert leaves.keys() == expected.keys()
    for place, effects in expected.items():
        row = leaves[place]
        assert (row.allocation, row.selection, row.interaction) == pytest.approx(effects, abs=1e-8)


def test_a_benchmark_of_all_portfolios_together_equals_its_rows_by_themselves(spark):
    """Null and NaN accounts are no portfolio but count in the benchmark; rows may come twice and lack anything."""
    held, _ = some_rows(4)
    held = decimals([(0.5 if row[0] == "x" else 1.5, *row[1:]) for row in held + held[:10]])
    odd = [(None, 2015, "tech", "north", 7, 9), (float("nan"), 2016, "oil", "north", 7, 9), (0.5, None, "tech", "north", 5, 9)]
    odd += [(0.5, 2015, "tech", "north", None, 9), (0.5, 2016, None, None, 0, 9), (1.5, 2017, "tech", "north", 5, None)]
    fields = "account double, " + FIELDS
    rows = spark.createDataFrame(held + decimals(odd), fields)
    market = spark.createDataFrame([row[1:] for row in held + decimals(odd)], FIELDS)
    together = performance.attribution(rows, rows.drop("account"), ["account"], "year", DIMS).collect()
    apart = performance.attribution(rows, market, ["account"], "year", DIMS).collect()
    assert {row.account for row in together} == {0.5, 1.5}
    assert {row.sector for row in together} == {"tech", "food", "oil", None}
    assert sorted(map(str, together)) == sorted(map(str, apart))


def test_a_benchmark_of_other_rows_is_added_up_by_itself(spark):
    """A benchmark made from the held rows but not all of them is not taken for their sums."""
    held, _ = some_rows(5)
    rows = spark.createDataFrame(decimals(held), "account string, " + FIELDS)
    some = rows.filter("sector = 'tech'").drop("account")
    market = spark.createDataFrame([row[1:] for row in decimals(held) if row[2] == "tech"], FIELDS)
    found = performance.attribution(rows, some, ["account"], "year", DIMS).collect()
    assert sorted(map(str, found)) == sorted(map(str, performance.attribution(rows, market, ["account"], "year", DIMS).collect()))


def test_parts_add_up_at_every_level(spark):
    held, market = some_rows(3)
    rows = attributed(spark, decimals(held), decimals(market)).collect()
    assert {r.level for r in rows} == {"sector,region", "sector", "region", "total"}
    for account in ("x", "y", "hot"):
        (total,) = (r for r in rows if r.account == account and r.level == "total")
        assert total.excess == pytest.approx(total.portfolio_return - total.benchmark_return, abs=1e-7)
        for level in ("sector,region", "sector", "region"):
            parts = [r for r in rows if r.account == account and r.level == level]
            for effect in (*performance.EFFECTS, "excess"):
                assert sum(r[effect] for r in parts) == pytest.approx(total[effect], abs=1e-9)


def test_a_missing_dimension_is_a_segment_and_not_a_total(spark):
    held = [("x", 2020, None, "north", 50, 60), ("x", 2020, "tech", "north", 50, 50)]
    market = [(2020, None, "north", 80, 80), (2020, "tech", "north", 20, 30)]
    rows = attributed(spark, decimals(held), decimals(market)).collect()
    sectors = {r.sector: r for r in rows if r.level == "sector"}
    assert sectors.keys() == {None, "tech"}
    assert sectors[None].selection == pytest.approx(0.8 * 0.2)
    assert sectors["tech"].allocation == pytest.approx(0.3 * 0.4)


def test_rows_without_value_key_or_benchmark_are_left_out(spark):
    good = [("x", 2020, "tech", "north", 100, 120)]
    market = [(2020, "tech", "north", 100, 110)]
    bad = [
        (None, 2020, "tech", "north", 5, 9),
        ("x", None, "tech", "north", 5, 9),
        ("x", 2020, "tech", "north", None, 9),
        ("x", 2020, "tech", "north", 0, 9),
        ("x", 2020, "tech", "north", 5, None),
        ("x", 2021, "tech", "north", 5, 9),
    ]
    wrong = [(None, "tech", "north", 5, 9), (2020, "tech", "north", 5, None)]
    clean = attributed(spark, decimals(good), decimals(market)).collect()
    assert sorted(map(str, clean)) == sorted(map(str, attributed(spark, decimals(good + bad), decimals(market + wrong)).collect()))
    assert {r.portfolio_return for r in clean} == {0.2}


def test_empty_sides_give_no_rows(spark):
    row = decimals([("x", 2020, "tech", "north", 100, 120)])
    assert attributed(spark, row, []).collect() == []
    assert attributed(spark, [], [r[1:] for r in row]).collect() == []


def test_a_single_dimension_has_no_second_level(spark):
    rows = spark.createDataFrame(decimals([("x", 2020, "a", "n", 1, 2)]), "account string, " + FIELDS).drop("region")
    found = performance.attribution(rows, rows.drop("account"), ["account"], "year", ["sector"]).collect()
    assert sorted(r.level for r in found) == ["sector", "total"]


def test_the_registered_plan_pairs_no_rows(spark):
    frame = registered.BUILDERS["q44_attribution"](Tables(spark, "/root/testdata/sf0.001"))
    plan = introspect.explain_text(frame, "simple")
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
