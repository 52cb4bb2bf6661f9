"""Logical tables derived from the TPC-H-like test tables, at any scale factor.

Aggregates run on the raw keys before joins, and year limits are ranges on the raw timestamp, so
they reach the Parquet scan. The raw schemas are declared, so opening a table runs no job.
"""

from __future__ import annotations

import datetime as dt
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.numeric import half_up, ratio
from .plans import entity

AS_OF = dt.date(2000, 6, 30)
MIN_DATE = dt.date(1998, 1, 1)

# Schemas of the raw tables.
RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string",
}


def _total(column: str) -> str:
    """SQL for the exact sum of an amount with two decimals: whole cents, then a double."""
    return f"sum(cast(round({column} * 100D) as bigint)) / 100D"


class Tables:
    """Lazy frames of every logical table over one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.raw = cache(self._raw)

    def _raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def equity_holdings(self) -> DataFrame:
        shares = self.spark.sql(
            f"""select l_partkey as p_partkey, {_total("l_quantity")} as number_of_shares
                from {{lines}} group by l_partkey""",
            lines=self.raw("lineitem"),
        )
        return self.raw("part").join(shares, "p_partkey").selectExpr(
            "if(p_type = 'ECONOMY', 'Fund', 'Equity') as instrument_type",
            "'p' || p_partkey || '-us' as symbol",
            "number_of_shares",
        )

    def lots(self, since: dt.date | None = None) -> DataFrame:
        """Customer lots; ``since`` limits the purchase date at the scan of the orders."""
        orders = self.raw("orders")
        if since is not None:
            orders = orders.where(f"o_orderdate >= timestamp_ntz'{since.isoformat()}'")
        buyers = orders.selectExpr(
            "o_orderkey as l_orderkey",
            "o_custkey as customer_id",
            "cast(o_orderdate as date) as purchase_date",
            """case when startswith(o_orderpriority, '1') then 'IRA'
                    when startswith(o_orderpriority, '2') then '401k'
                    else 'Brokerage' end as account_type""",
        )
        lines = self.raw("lineitem").selectExpr(
            "l_orderkey",
            "l_partkey",
            "cast(l_quantity as decimal(18,2)) as shares_held",
            "cast(round(cast(l_extendedprice / l_quantity as decimal(18,6)), 2) as decimal(18,2))"
            " as cost_basis",
        )
        # The ticker is made after the join: its key is what the shuffle should carry.
        return lines.join(buyers, "l_orderkey").selectExpr(
            "customer_id", "'P' || l_partkey as ticker_symbol", "shares_held", "purchase_date", "cost_basis", "account_type"
        )

    @cached_property
    def customer_holdings(self) -> DataFrame:
        return self.lots()

    @cached_property
    def sym_ticker_region(self) -> DataFrame:
        return self.raw("part").where("p_partkey % 10 != 7").selectExpr(
            "'P' || p_partkey || '-US' as ticker_region", "'S' || p_partkey || '-R' as fsym_id"
        )

    @cached_property
    def sec_map(self) -> DataFrame:
        return self.spark.sql(
            """select 'S' || p_partkey || '-R' as fsym_id,
                      'C' || (p_partkey % (select count(*) from {suppliers})) || '-E'
                          as fsym_company_id
               from {parts} where p_partkey % 10 != 3""",
            parts=self.raw("part"),
            suppliers=self.raw("supplier"),
        )

    @cached_property
    def fe_sec_map(self) -> DataFrame:
        """The map of the estimates, with gaps of its own, so that some companies have no estimate."""
        return self.sec_map.where("cast(substring_index(substr(fsym_id, 2), '-', 1) as bigint) % 9 != 4")

    def _yearly_sales(self, year: int | None = None) -> DataFrame:
        """Sales and earnings factor per supplier and year; ``year`` is a range at the scan.

        Fundamentals and estimates both start here. The keys come back as aggregates, so a later
        filter on them stays above the aggregation and both read the same shuffle: one scan, not two.
        """
        within = "true"
        if year is not None:
            within = (
                f"l_shipdate >= timestamp_ntz'{year}-01-01'"
                f" and l_shipdate < timestamp_ntz'{year + 1}-01-01'"
            )
        return self.spark.sql(
            f"""select sk, yr, sales, (sk * 7 + yr * 3) % 41 - 8 as earned
                from (select max(l_suppkey) as sk, max(year(l_shipdate)) as yr,
                             {_total("l_extendedprice")} as sales
                      from {{lines}}
                      where {within}
                      group by l_suppkey, year(l_shipdate))""",
            lines=self.raw("lineitem"),
        )

    @cached_property
    def ff_basic_af(self) -> DataFrame:
        return self.facts()

    def facts(self, year: int | None = None) -> DataFrame:
        """Fundamentals of all years, or of one."""
        return self._yearly_sales(year).selectExpr(
            "'C' || sk || '-E' as fsym_id",
            "make_date(yr, 12, 31) as DATE",
            "sales as FF_SALES",
            "sales * earned / 100D as FF_NET_INCOME",
            "sales * earned / 10000000D as FF_EPS_BASIC",
            "sales * 1.2D as FF_ASSETS",
            "sales * 0.4D as FF_GROSS_INC",
            "if(sk % 25 = 1, 0D, sales * 0.5D) as FF_COM_EQ",
            "sales * ((sk + yr) % 31 - 5) / 100D as FF_FUNDS_OPER_GROSS",
            "if(sk % 37 = 2, null, sales * (sk * 3 % 10) / 20D) as FF_DEBT_ST",
            "sales * ((sk * 5 + yr) % 21) / 20D as FF_DEBT_LT",
        )

    @cached_property
    def fe_basic_conh_af(self) -> DataFrame:
        return self.estimates()

    def estimates(self, year: int | None = None) -> DataFrame:
        """Estimates for all fiscal years, or for one; each starts from the year before."""
        variants = ", ".join(
            f"struct('{item}' as item, {scale}D as k, {revision} as rev)"
            for item, scale in (("EPS", 1), ("SALES", 1000))
            for revision in (1, 2)
        )
        return (
            self._yearly_sales(None if year is None else year - 1)
            .selectExpr(
                "sk", "yr + 1 as fy", "sales * earned / 10000000D as eps", f"inline(array({variants}))"
            )
            .selectExpr("*", "eps * (1D + ((sk * 11 + fy) % 61 - 25) / 100D) * k as mean")
            .selectExpr(
                "'C' || sk || '-E' as fsym_id",
                "item as FE_ITEM",
                "make_date(fy, 12, 31) as FE_FP_END",
                "mean as FE_MEAN",
                "mean * 0.99D as FE_MEDIAN",
                "mean * (1D + (sk % 8) / 20D) as FE_HIGH",
                "mean * (1D - (sk % 8) / 20D) as FE_LOW",
                "abs(eps) * (sk % 8) / 40D as FE_STD_DEV",
                "cast(sk * 13 % 25 as int) as FE_NUM_EST",
                "if(rev = 1, date'1999-12-15', null) as CONS_END_DATE",
            )
        )

    @property
    def core(self) -> tuple[DataFrame, ...]:
        """Holdings, symbology, and map and facts of fundamentals and of estimates."""
        return (
            self.equity_holdings,
            self.sym_ticker_region,
            self.sec_map,
            self.ff_basic_af,
            self.fe_sec_map,
            self.fe_basic_conh_af,
        )

    @cached_property
    def sym_coverage(self) -> DataFrame:
        names = self.raw("part").selectExpr("'P' || p_partkey as ticker", "p_name as proper_name")
        return entity.adapt_coverage(self.sym_ticker_region, self.sec_map, names)

    def entity_facts(self, year: int | None = None) -> DataFrame:
        return entity.adapt_facts(self.facts(year))

    def entity_eps(self, year: int | None = None) -> DataFrame:
        return entity.adapt_eps(self.estimates(year))

    def annual_financials(self, year: int | None = None) -> DataFrame:
        facts = self.entity_facts(year).selectExpr(
            "entity_id", "fiscal_year", "sales as revenue", "net_income"
        )
        ids = self.sym_coverage.select("ticker", "entity_id")
        return ids.join(facts, "entity_id").select("ticker", "fiscal_year", "revenue", "net_income")

    @cached_property
    def transactions(self) -> DataFrame:
        customers = self.raw("customer").selectExpr(
            "c_custkey as o_custkey", "c_nationkey as country_code"
        )
        return self.raw("orders").join(customers, "o_custkey").selectExpr(
            "o_orderkey as transaction_id",
            "o_custkey as customer_id",
            "o_totalprice as amount",
            "country_code",
        )

    @cached_property
    def countries(self) -> DataFrame:
        regions = self.raw("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return self.raw("nation").join(regions, "n_regionkey").selectExpr(
            "n_nationkey as code", "n_name as country", "r_name as region"
        )

    @cached_property
    def sales(self) -> DataFrame:
        return self.raw("lineitem").selectExpr("l_partkey as product_id", "l_quantity as quantity")

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey as product_id", "p_type as category", "p_retailprice as price"
        )

    def shares_traded(self, year: int) -> DataFrame:
        """Shares and trades per ticker in one year, the limits at the scan."""
        return self.spark.sql(
            f"""select 'P' || l_partkey as ticker_symbol, {_total("l_quantity")} as shares, count(*) as trades
                from {{lines}}
                where l_shipdate >= timestamp_ntz'{year}-01-01' and l_shipdate < timestamp_ntz'{year + 1}-01-01'
                group by l_partkey""",
            lines=self.raw("lineitem"),
        )

    @cached_property
    def symbol_history(self) -> DataFrame:
        """Symbols that stood for two securities one after the other, and every eleventh for none in between."""
        return self.raw("part").where("p_partkey % 10 != 7").selectExpr(
            "'P' || p_partkey || '-US' as ticker_region",
            "date_add(date'1995-06-01', cast(p_partkey * 37 % 2000 as int)) as changed",
            "p_partkey",
        ).selectExpr(
            "ticker_region",
            """inline(array(
                struct('S' || p_partkey || '-R' as fsym_id, cast(null as date) as valid_from, changed as valid_to),
                struct('S' || p_partkey || '-N' as fsym_id,
                       if(p_partkey % 11 = 0, date_add(changed, 90), changed) as valid_from,
                       cast(null as date) as valid_to)))""",
        )

    def trades(self, sold: bool, together: bool = False) -> DataFrame:
        """Returned lines as sales on the day they were shipped, all others as lots bought with their order.

        Trades of one ticker, day and price are one trade; the price is its id. ``together`` puts a ticker's trades into one
        partition, for what follows by ticker.
        """
        if sold:
            lines = self.raw("lineitem").where("l_returnflag = 'R'").withColumn("day", F.col("l_shipdate").cast("date"))
        else:
            days = self.raw("orders").selectExpr("o_orderkey as l_orderkey", "cast(o_orderdate as date) as day")
            lines = self.raw("lineitem").where("l_returnflag != 'R'").join(days, "l_orderkey")
        priced = lines.selectExpr(
            "'P' || l_partkey as ticker_symbol",
            "day",
            "cast(l_quantity as decimal(18,2)) as quantity",
            "cast(round(cast(l_extendedprice / l_quantity as decimal(18,6)), 2) as decimal(18,2)) as price",
        )
        if together:
            priced = priced.repartition("ticker_symbol")
        summed = priced.groupBy("ticker_symbol", "day", "price").agg(F.sum("quantity").alias("quantity"))
        return summed.withColumn("id", (F.col("price") * 100).cast("long"))

    @property
    def traded_tickers(self) -> DataFrame:
        """The ticker of each line."""
        return self.raw("lineitem").selectExpr("'P' || l_partkey as ticker_symbol")

    @cached_property
    def yearly_positions(self) -> DataFrame:
        """What each kind of account bought of a ticker in a year, at that year's mean price and at the next year's."""
        bought = self.customer_holdings.groupBy(
            "ticker_symbol", "account_type", F.year("purchase_date").alias("year")
        ).agg(F.sum("shares_held").alias("shares"), F.sum(F.col("shares_held") * F.col("cost_basis")).alias("cost"))
        # Prices by windows over the one aggregate, so that the lots (lineitem joined with orders) are read once.
        bought = bought.dropna(subset=["ticker_symbol", "year"])
        year = Window.partitionBy("ticker_symbol", "year")
        price = half_up(ratio(F.sum("cost").over(year).cast("double"), F.sum("shares").over(year).cast("double")))
        bought = bought.withColumn("price", price.cast("decimal(18,2)"))
        following = Window.partitionBy("ticker_symbol").orderBy("year").rangeBetween(1, 1)
        bought = bought.withColumns(
            {"next_year": F.max("year").over(following), "next_price": F.max("price").over(following)}
        ).filter(F.col("next_year").isNotNull())
        parts = self.raw("part").selectExpr("'P' || p_partkey as ticker_symbol", "p_type as category", "p_brand as brand")
        shares = F.col("shares").cast("decimal(18,2)")
        return bought.join(parts, "ticker_symbol").select(
            "account_type", "year", "category", "brand", (shares * F.col("price")).alias("start"), (shares * F.col("next_price")).alias("end")
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderdate as order_date", "o_totalprice as total_amount"
        )
