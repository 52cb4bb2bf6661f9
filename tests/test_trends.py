"""Trends against a loop over the same rows."""

from __future__ import annotations

from collections import defaultdict
from decimal import Decimal
from random import Random

import pytest

from foliospark import queries as registered
from foliospark.fixtures import Tables
from foliospark.plans.trends import trends
from foliospark.sources import introspect

FIELDS = "ticker string, quarter int, sales decimal(18,2)"


def found(spark, rows, span=4):
    frame = trends(spark.createDataFrame(rows, FIELDS), ["ticker"], "quarter", "sales", span=span)
    return {(r.ticker, r.quarter): (r.sales, r.trailing, r.growth_pct, r.direction, r.streak) for r in frame.collect()}


def by_loop(rows, span):
    sums = defaultdict(Decimal)
    for key, at, value in rows:
        if at is not None and value is not None:
            sums[key, at] += value
    expected, runs = {}, {}
    for key, at in sorted(sums, key=lambda place: place[1]):
        value, before, earlier = sums[key, at], sums.get((key, at - 1)), sums.get((key, at - span))
        last = [sums.get((key, at - n)) for n in range(span)]
        way = None if before is None else (value > before) - (value < before)
        past_way, past = runs.get((key, at - 1), (None, 0))
        runs[key, at] = way, 0 if way is None else past + 1 if way == past_way else 1
        growth = None if not earlier else pytest.approx(float((value - earlier) / earlier * 100), abs=0.00501)
        expected[key, at] = (value, None if None in last else sum(last), growth, *runs[key, at])
    return expected


@pytest.mark.parametrize("span", [1, 2, 4])
def test_trends_equal_a_loop(spark, span):
    random = Random(span)
    keys = ["hot"] * 6 + ["a", "b", None]
    rows = [(random.choice(keys), random.randrange(40), Decimal(random.randrange(1, 5))) for _ in range(160)]
    rows += [("a", None, Decimal(1)), ("a", 3, None), ("gone", 7, None), ("zero", 1, Decimal(0)), ("zero", 1 + span, Decimal(2))]
    assert found(spark, rows, span) == by_loop(rows, span)


def test_a_missing_quarter_ends_a_streak(spark):
    rows = [("x", at, Decimal(value)) for at, value in [(1, 1), (2, 2), (3, 3), (5, 4), (6, 5), (7, 5), (8, 5)]]
    streaks = {at: streak for (_, at), (*_, streak) in found(spark, rows).items()}
    assert streaks == {1: 0, 2: 1, 3: 2, 5: 0, 6: 1, 7: 1, 8: 2}


def test_no_rows_no_trends(spark):
    assert found(spark, []) == {}


def test_windows_share_one_sort(spark):
    frame = registered.BUILDERS["q45_sales_trends"](Tables(spark, "/root/testdata/sf0.001"))
    plan = introspect.explain_text(frame, "simple")
    assert plan.count("Sort [") == 1
