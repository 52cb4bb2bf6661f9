from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from tests.conftest import AS_OF, MIN_DATE
from pyspark.sql import functions as F

from foliospark import publish, schemas
from foliospark.plans import enrich
from foliospark.sources import federated, introspect, managed

DATES = {"as_of": AS_OF, "min_date": MIN_DATE}


# Schemas.


def test_validate_schema_names_every_problem(spark):
    frame = spark.createDataFrame([("x", "y")], "symbol string, number_of_shares string")
    with pytest.raises(schemas.SchemaError) as error:
        schemas.validate_schema(frame, "equity_holdings")
    assert "instrument_type is missing" in str(error.value)
    assert "number_of_shares is string, expected double" in str(error.value)


def test_validate_schema_allows_other_widths_and_extra_columns(spark):
    frame = spark.createDataFrame(
        [("Equity", "X", Decimal(1), 1)],
        "INSTRUMENT_TYPE string, symbol string, number_of_shares decimal(9,4), extra int",
    )
    assert schemas.validate_schema(frame, "equity_holdings") is frame


def test_conform_renames_aliases_and_casts(spark):
    frame = spark.sql(
        """select 'a' as fsym_id, 'EPS' as fe_item, timestamp'2024-12-31' as fe_fp_end,
                  1 as fe_cons_mean, 2 as fe_cons_median, 3 as fe_cons_high, 4 as fe_cons_low,
                  5 as fe_std_dev, 6L as fe_cons_est_cnt, cast(null as date) as cons_end_date"""
    )
    got = schemas.conform(frame, "fe_basic_conh_af")
    assert got.schema.simpleString() == schemas.SCHEMAS["fe_basic_conh_af"].simpleString()
    assert got.first().FE_MEAN == 1.0


def test_conform_takes_vendor_names(spark):
    frame = spark.sql("select 'A' t, 'e' as vendor_id, 'n' proper_name, 'EQY' entity_type, 'US' iso_country")
    got = schemas.conform(frame, "sym_coverage", {"t": "ticker", "vendor_id": "entity_id"})
    assert tuple(got.first()) == ("A", "e", "n", "EQY", "US")


# Federated sources: options only, nothing is contacted.


def test_connection_options(spark):
    options = federated.connection_options(
        "postgresql", "db.example.org", "books", user="reader", password=federated.Secret(env="X")
    )
    assert options["url"] == "jdbc:postgresql://db.example.org:5432/books"
    assert options["driver"] == "org.postgresql.Driver"
    with pytest.raises(ValueError, match="unknown source kind"):
        federated.connection_options("oracle9", "h", "d")
    with pytest.raises(TypeError, match="Secret"):
        federated.connection_options("mysql", "h", "d", password="plain")


@pytest.mark.parametrize("kind", list(federated.KINDS))
def test_every_kind_has_a_url_and_a_port(kind):
    url = federated.connection_options(kind, "host", "base")["url"]
    assert url.startswith("jdbc:") and "host" in url and "base" in url
    assert str(federated.PORTS[kind]) in url


def test_secrets_resolve_late(spark, settings, monkeypatch):
    secret = federated.Secret(env="FOLIOSPARK_TEST_PASSWORD", conf="foliospark.test.password")
    with pytest.raises(LookupError):
        secret.resolve(spark)
    settings(foliospark__test__password="from-conf")
    assert secret.resolve(spark) == "from-conf"
    monkeypatch.setenv("FOLIOSPARK_TEST_PASSWORD", "from-env")
    assert secret.resolve(spark) == "from-env"
    assert "from-env" not in repr(secret)


def test_register_and_describe_hide_credentials(spark, settings, monkeypatch):
    monkeypatch.setenv("FOLIOSPARK_TEST_PASSWORD", "hush")
    secret = federated.Secret(env="FOLIOSPARK_TEST_PASSWORD")
    prefix = "spark.sql.catalog.ledger"
    keys = ["", ".url", ".driver", ".user", ".password", ".pushDownAggregate", ".pushDownLimit"]
    settings(**{(prefix + key).replace(".", "__"): "" for key in keys})
    options = federated.jdbc_options(
        "jdbc:custom://me:pw@host/db;password=pw", "org.example.Driver", "me", secret
    )
    assert federated.register_federated(spark, "ledger", options) == "ledger"
    assert spark.conf.get(prefix) == federated.JDBC_CATALOG
    assert spark.conf.get(prefix + ".password") == "hush"
    shown = {
        r.option: r.value
        for r in federated.describe_sources(spark).filter("source = 'ledger'").collect()
    }
    assert shown["password"] == shown["user"] == federated.MASK
    assert "pw" not in shown["url"] and "host" in shown["url"]
    assert shown["pushDownAggregate"] == "true"
    assert not any("hush" in value for value in shown.values())


def test_partitioning_options():
    options = federated.Partitioning("customer_id", 1, 1000, 8).options()
    assert options == {
        "partitionColumn": "customer_id",
        "lowerBound": "1",
        "upperBound": "1000",
        "numPartitions": "8",
    }
    with pytest.raises(ValueError, match="at least one"):
        federated.Partitioning("x", 0, 1, 0).options()


def test_read_federated_by_name_filters_and_projects(spark, market):
    market.holdings.createOrReplaceTempView("federated_holdings")
    got = federated.read_federated(
        spark, "federated_holdings", ["symbol"], "instrument_type = 'Fund'"
    )
    assert [tuple(r) for r in got.collect()] == [("MSFT",)]
    spark.sql(
        """create or replace temp view upper_holdings as
           select instrument_type as INSTRUMENT_TYPE, symbol as SYMBOL,
                  cast(number_of_shares as decimal(12,2)) as NUMBER_OF_SHARES, 1 as EXTRA
           from federated_holdings"""
    )
    got = federated.read_federated(spark, "upper_holdings", logical="equity_holdings")
    assert got.schema.simpleString() == schemas.SCHEMAS["equity_holdings"].simpleString()



# Managed tables, ingestion, introspection.


def test_ingest_appends_checked_rows(spark, tmp_path, table):
    path = str(tmp_path / "lots")
    row = (1008, "AAA", Decimal("100.00"), dt.date(2024, 1, 15), Decimal("150.00"), "Brokerage")
    managed.ingest_positions(table("customer_holdings", [row]), path)
    typed = spark.sql(
        """select 1009 as customer_id, 'BBB' as ticker_symbol, 10.0000 as shares_held,
                  150.0000 as cost_basis, '2024-01-15' as purchase_date, 'IRA' as account_type"""
    ).withColumn("purchase_date", F.col("purchase_date").cast("date"))
    managed.ingest_positions(typed, path)
    got = managed.read_managed(spark, path, "customer_holdings")
    assert sorted(r.customer_id for r in got.collect()) == [1008, 1009]
    with pytest.raises(schemas.SchemaError):
        managed.ingest_positions(typed.drop("cost_basis"), path)


def test_ingest_keeps_extra_columns_in_a_table(spark, table):
    row = (1, "AAA", Decimal(1), dt.date(2024, 1, 15), Decimal(1), "IRA")
    rows = table("customer_holdings", [row]).withColumn("account_number", F.lit("IRA-1"))
    managed.ingest_positions(rows, "ingested_lots", keep_extra=True)
    managed.ingest_positions(rows, "ingested_lots", keep_extra=True)
    got = managed.read_managed(spark, "ingested_lots")
    assert got.count() == 2 and got.first().account_number == "IRA-1"
    spark.sql("drop table ingested_lots")


def test_query_preview_and_connection_test(spark, market):
    market.holdings.createOrReplaceTempView("some_holdings")
    big = managed.query(spark, "select * from some_holdings where number_of_shares > :n", {"n": 50})
    assert big.count() == 3
    assert managed.preview(market.holdings, 4).count() == 4
    assert [tuple(r) for r in managed.connection_test(market.holdings).collect()] == [(1,)]
    assert managed.connection_test(market.holdings.limit(0)).count() == 0


def test_introspection(spark):
    spark.sql("create table noted (a int comment 'how many', b string) using parquet")
    assert "default" in [r[0] for r in introspect.list_schemas(spark).collect()]
    assert "default" in [r[0] for r in introspect.list_schemas(spark, "spark_catalog").collect()]
    assert "noted" in [r.tableName for r in introspect.list_tables(spark, "default").collect()]
    comments = {r.col_name: r.comment for r in introspect.column_metadata(spark, "noted").collect()}
    assert comments["a"] == "how many"
    assert [r[0] for r in introspect.list_columns(spark, "noted").collect()] == ["a", "b"]
    spark.sql("drop table noted")


def test_try_action(spark):
    result, failure = introspect.try_action(lambda: spark.range(3).count())
    assert (result, failure) == (3, None)
    result, failure = introspect.try_action(lambda: spark.table("no_such_table").count())
    assert result is None
    assert failure.condition == "TABLE_OR_VIEW_NOT_FOUND"
    assert failure.sql_state == "42P01"
    assert "no_such_table" in failure.message


# Publication.


def test_views_are_lazy_and_replaceable(spark):
    publish.publish_view(spark.range(3), "numbers_view")
    publish.publish_view(spark.range(5), "numbers_view")
    publish.refresh(spark, "numbers_view")
    assert spark.table("numbers_view").count() == 5


def test_sql_view_lives_in_the_catalog(spark):
    publish.publish_table(spark.range(3).toDF("n"), "numbers_table")
    publish.publish_sql_view(spark, "numbers_sql_view", "select n + 1 as n from numbers_table")
    assert spark.sql("select max(n) from numbers_sql_view").first()[0] == 3
    spark.sql("drop view numbers_sql_view")
    spark.sql("drop table numbers_table")


def test_snapshot_with_load_time(spark, tmp_path):
    moment = dt.datetime(2024, 6, 30, 12)
    path = str(tmp_path / "snap")
    got = publish.publish_table(spark.range(2), "unused", moment, stamp=True, path=path)
    assert {r.last_updated for r in got.collect()} == {moment}
    later = publish.publish_table(spark.range(3), "unused", stamp=True, path=path)
    assert later.count() == 3
    assert "last_updated" not in publish.publish_table(spark.range(1), "u", path=path).columns


def test_partitioned_facts_prune_by_year(spark, tmp_path, market):
    path = publish.share_snapshot(
        market.ff.withColumn("fiscal_year", F.year("DATE")), str(tmp_path / "facts"), ["fiscal_year"]
    )
    one_year = managed.read_managed(spark, path).filter("fiscal_year = 2023")
    pushed = introspect.explain_pushdown(one_year)
    assert any("fiscal_year" in text for text in pushed.partition_filters)
    assert one_year.count() == 8


def test_partitioned_writes_split_a_hot_value(spark, settings, tmp_path):
    """Two thirds of the rows fall in one year: several tasks write it, other years have one file.

    Years that share the hot year's shuffle partition are split along with it.
    """
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__optimizeSkewsInRebalancePartitions__enabled="true",
    )
    rows = spark.range(0, 90_000, 1, 9).select(
        F.when(F.col("id") % 3 > 0, 2023).otherwise(F.col("id") % 7).cast("int").alias("year"),
        F.xxhash64("id").alias("a"),
    )
    path = publish.share_snapshot(rows, str(tmp_path / "hot"), ["year"])
    files = {part.name: len(list(part.glob("*.parquet"))) for part in Path(path).glob("year=*")}
    assert files["year=2023"] > 3
    assert sorted(files.values())[0] == 1
    assert sum(files.values()) < 9 * len(files), "fewer than one file per task and year"
    assert spark.read.parquet(path).count() == 90_000


def test_publish_portfolio(spark, market):
    frame = enrich.portfolio_dashboard(*market.core, **DATES)
    moment = dt.datetime(2024, 6, 30, 12)
    names = publish.publish_portfolio(frame, "daily_", moment)
    assert spark.table(names["portfolio_dashboard"]).count() == 7
    summary = spark.table(names["portfolio_summary"]).first()
    assert (summary.total_holdings, summary.last_updated) == (7, moment)
    assert spark.table(names["action_items"]).count() == 6
    assert spark.table(names["stock_rankings"]).count() == 7
    assert spark.table(names["risk_distribution"]).count() == 3
    assert spark.table(names["stock_performance"]).count() == 7
    publish.refresh(spark, *names.values())
    text = introspect.explain_text(spark.table(names["portfolio_overview"]), "extended")
    assert "Window" not in text, "views read the snapshot and do not recompute the dashboard"
    assert publish.publish_portfolio(frame, "daily_", moment) == names, "the job can run again"
    for table in names.values():
        spark.sql(f"drop table {table}")


def test_portfolios_of_two_schemas_stand_side_by_side(spark, market):
    frame = enrich.portfolio_dashboard(*market.core, **DATES)
    for schema in ("book_a", "book_b"):
        spark.sql(f"create schema {schema}")
    first = publish.publish_portfolio(frame, "book_a.my_")
    second = publish.publish_portfolio(frame.limit(5), "book_b.my_")
    other = spark.newSession()
    assert other.table(first["portfolio_overview"]).first().total_stocks == 7
    assert other.table(second["portfolio_overview"]).first().total_stocks == 5
    for schema in ("book_a", "book_b"):
        spark.sql(f"drop schema {schema} cascade")


def test_a_failed_publication_leaves_the_table(spark):
    publish.publish_table(spark.range(3), "kept_table")
    with pytest.raises(Exception, match="no luck"):
        publish.publish_table(spark.range(5).select(F.raise_error(F.lit("no luck")).alias("id")), "kept_table")
    assert spark.table("kept_table").count() == 3
    publish.publish_table(spark.table("kept_table").filter("id > 0"), "kept_table")
    assert spark.table("kept_table").count() == 2
    spark.sql("drop table kept_table")


def test_amounts_are_refused_rather_than_rounded(spark):
    def lots(shares):
        columns = "customer_id bigint, ticker_symbol string, shares_held {}, purchase_date date, cost_basis double, account_type string"
        kind = "double" if isinstance(shares, float) else "decimal(20,6)"
        return schemas.conform(spark.createDataFrame([(1, "A", shares, None, 1.25, "x")], columns.format(kind)), "customer_holdings")

    assert lots(Decimal("0.1234")).first().shares_held == Decimal("0.1234")
    assert lots(0.1234).first().shares_held == Decimal("0.1234")
    for shares in (Decimal("0.123456"), 0.123456):
        with pytest.raises(Exception, match="shares_held has a value"):
            lots(shares).collect()

def test_cached_releases_its_frames(spark):
    frame = spark.range(10)
    with publish.cached(frame) as (held,):
        assert held.storageLevel.useMemory
        assert held.count() == 10
    assert not frame.storageLevel.useMemory


def test_shared_folder_prefers_the_cluster_setting():
    def session(folder):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder or default))

    assert publish.shared_folder(session("s3://bucket/shared/")) == "s3://bucket/shared"
    with pytest.raises(LookupError, match="checkpoint"):
        publish.shared_folder(session(None))


def test_snapshot_reads_back_from_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "shared_folder", lambda session: str(tmp_path))
    publish.snapshot(spark.range(4), "a")
    again = publish.snapshot(spark.range(2), "a")
    assert again.count() == 2
    assert "Range" not in introspect.explain_text(again)


def test_partition_options_reach_the_reader_of_a_catalog_table():
    seen = {}

    class Reader:
        def options(self, **options):
            seen.update(options)
            return self

        def table(self, name):
            return name

    ranges = federated.Partitioning("id", 0, 1000, 8)
    session = SimpleNamespace(read=Reader())
    assert federated.read_federated(session, "books.trading.lots", partition=ranges) == "books.trading.lots"
    assert seen == ranges.options()


def test_credentials_of_any_name_are_masked(spark):
    shown = {"accessToken": "a1", "pem_private_key": "b2", "passphrase": "c3", "awsCredential": "d4", "fetchsize": "7"}
    federated.register_federated(spark, "masked_source", {"url": "jdbc:x://h/db?apiToken=e5", **shown})
    rows = {r.option: r.value for r in federated.describe_sources(spark).collect() if r.source == "masked_source"}
    assert all(rows[name] == federated.MASK for name in shown if name != "fetchsize")
    assert "e5" not in rows["url"] and rows["fetchsize"] == "7"
