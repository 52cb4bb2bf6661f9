from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from foliospark.schemas import SCHEMAS  # noqa: E402
from foliospark.session import configured  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("warehouse")
    session = (
        configured(SparkSession.builder.master("local[4]"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(home))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set Spark options for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def table(spark):
    """Build a frame of a logical table from tuples."""
    return lambda name, rows: spark.createDataFrame(rows, SCHEMAS[name])


DAY = dt.date
AS_OF = dt.date(2024, 6, 30)
MIN_DATE = dt.date(2022, 1, 1)


class Market:
    """A small hand-made market that holds every awkward case once.

    TSLA and AMZN have no symbology. GOOGL has two fundamentals on one date. DEBT lacks short-term
    debt, ZERO has no equity, LOSS loses money, PLAIN has no estimate.
    """

    def __init__(self, table):
        self.holdings = table(
            "equity_holdings",
            [
                ("Equity", "aapl", 100.0),
                ("Equity", "MSFT-US", 50.0),
                ("Equity", "GOOGL", 75.0),
                ("Equity", "TSLA", 25.0),
                ("Equity", "amzn-us", 60.0),
                ("Equity", "DEBT", 10.0),
                ("Equity", "ZERO", 10.0),
                ("Equity", "LOSS", 10.0),
                ("Equity", "PLAIN", 10.0),
                ("Fund", "MSFT", 7.0),
            ],
        )
        names = ["AAPL", "MSFT", "GOOGL", "DEBT", "ZERO", "LOSS", "PLAIN"]
        self.sym = table("sym_ticker_region", [(f"{n}-US", f"{n}-S") for n in names])
        self.ff_map = table("ff_sec_map", [(f"{n}-S", f"{n}-C") for n in names])
        self.fe_map = table("fe_sec_map", [(f"{n}-S", f"{n}-C") for n in names])
        new, old, ancient = DAY(2023, 12, 31), DAY(2022, 12, 31), DAY(2020, 12, 31)

        def fact(name, day, sales, income, eps, assets, equity, cash, short, long):
            return (f"{name}-C", day, sales, income, eps, assets, None, equity, cash, short, long)

        self.ff = table(
            "ff_basic_af",
            [
                fact("AAPL", new, 1000e6, 200e6, 4.0, 2000e6, 800e6, 250e6, 100e6, 300e6),
                fact("AAPL", old, 900e6, 150e6, 3.0, 1900e6, 700e6, 200e6, 100e6, 300e6),
                fact("AAPL", ancient, 100e6, 10e6, 1.0, 500e6, 100e6, 20e6, 10e6, 30e6),
                fact("MSFT", new, 500e6, 20e6, 2.0, 900e6, 100e6, 30e6, 150e6, 150e6),
                fact("GOOGL", new, 400e6, 40e6, 1.0, 900e6, 400e6, 50e6, 10e6, 20e6),
                fact("GOOGL", new, 300e6, 30e6, 2.0, 800e6, 300e6, 40e6, 10e6, 20e6),
                fact("DEBT", new, 100e6, 50e6, 1.0, 200e6, 100e6, 10e6, None, 20e6),
                fact("ZERO", new, 100e6, 50e6, 1.0, 200e6, 0.0, 10e6, 10e6, 20e6),
                fact("LOSS", new, 100e6, -50e6, -2.0, 200e6, 50e6, -10e6, 10e6, 20e6),
                fact("PLAIN", new, 100e6, 2e6, 0.5, 200e6, 100e6, 10e6, 10e6, 20e6),
            ],
        )
        end, later = DAY(2024, 12, 31), DAY(2025, 12, 31)

        def estimate(name, day, mean, high, low, count, closed=None, item="EPS"):
            return (f"{name}-C", item, day, mean, mean, high, low, 0.125, count, closed)

        self.fe = table(
            "fe_basic_conh_af",
            [
                estimate("AAPL", end, 5.0, 5.5, 4.5, 20),
                estimate("AAPL", later, 6.0, 9.0, 3.0, 2),
                estimate("AAPL", DAY(2023, 12, 31), 4.1, 4.2, 4.0, 20),
                estimate("AAPL", end, 9.9, 9.9, 9.9, 9, closed=DAY(2024, 1, 1)),
                estimate("AAPL", end, 999.0, 999.0, 999.0, 9, item="SALES"),
                estimate("MSFT", later, 2.2, 2.3, 2.1, 5),
                estimate("GOOGL", end, 1.04, 1.1, 1.0, 10),
                estimate("DEBT", end, 0.8, 0.9, 0.7, 3),
                estimate("ZERO", end, 1.21, 1.3, 1.2, 4),
                estimate("LOSS", end, -1.0, -0.5, -2.0, 4),
            ],
        )

    @property
    def core(self):
        return self.holdings, self.sym, self.ff_map, self.ff, self.fe_map, self.fe


@pytest.fixture
def market(table):
    return Market(table)


def rows_by(frame, key):
    return {row[key]: row.asDict() for row in frame.collect()}
