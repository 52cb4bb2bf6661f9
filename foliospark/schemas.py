"""Logical tables: declared schemas, alternative column names and checks at the boundary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


KINDS: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "money": T.DecimalType(18, 4),  # holdings come with two or four decimals
}


def _schema(columns: str) -> T.StructType:
    """A schema from ``name kind`` pairs, without needing a session."""
    pairs = [pair.split() for pair in columns.split(",")]
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in pairs])


# The column names and types of the logical tables.
SCHEMAS: dict[str, T.StructType] = {
    "equity_holdings": _schema("instrument_type string, symbol string, number_of_shares double"),
    "customer_holdings": _schema(
        "customer_id bigint, ticker_symbol string, shares_held money, purchase_date date,"
        " cost_basis money, account_type string"
    ),
    "sym_ticker_region": _schema("ticker_region string, fsym_id string"),
    "sym_coverage": _schema(
        "ticker string, entity_id string, proper_name string, entity_type string, iso_country string"
    ),
    "ff_sec_map": _schema("fsym_id string, fsym_company_id string"),
    "fe_sec_map": _schema("fsym_id string, fsym_company_id string"),
    "ff_basic_af": _schema(
        "fsym_id string, DATE date, FF_SALES double, FF_NET_INCOME double, FF_EPS_BASIC double,"
        " FF_ASSETS double, FF_GROSS_INC double, FF_COM_EQ double, FF_FUNDS_OPER_GROSS double,"
        " FF_DEBT_ST double, FF_DEBT_LT double"
    ),
    "fe_basic_conh_af": _schema(
        "fsym_id string, FE_ITEM string, FE_FP_END date, FE_MEAN double, FE_MEDIAN double,"
        " FE_HIGH double, FE_LOW double, FE_STD_DEV double, FE_NUM_EST int, CONS_END_DATE date"
    ),
    "entity_facts": _schema(
        "entity_id string, fiscal_year int, sales double, net_income double, total_assets double,"
        " total_equity double, eps_basic double"
    ),
    "entity_eps": _schema(
        "entity_id string, fiscal_year int, mean_estimate double, high_estimate double,"
        " low_estimate double, num_estimates int, standard_deviation double"
    ),
    "annual_financials": _schema(
        "ticker string, fiscal_year int, revenue double, net_income double"
    ),
    "transactions": _schema(
        "transaction_id bigint, customer_id bigint, amount double, country_code int"
    ),
    "countries": _schema("code int, country string, region string"),
    "sales": _schema("product_id bigint, quantity double"),
    "products": _schema("product_id bigint, category string, price double"),
    "orders": _schema("order_date date, total_amount double"),
}

# Other names in use for the columns above.
ALIASES: dict[str, str] = {
    "ff_date": "DATE",
    "ff_net_inc": "FF_NET_INCOME",
    "ff_oper_cf": "FF_FUNDS_OPER_GROSS",
    "fe_cons_mean": "FE_MEAN",
    "fe_cons_median": "FE_MEDIAN",
    "fe_cons_high": "FE_HIGH",
    "fe_cons_low": "FE_LOW",
    "fe_cons_est_cnt": "FE_NUM_EST",
}


class SchemaError(ValueError):
    """A table lacks a column or has one of the wrong kind."""


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "number"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    return kind.simpleString()


def validate_schema(df: DataFrame, table: str) -> DataFrame:
    """The frame itself, or SchemaError if a declared column is missing or of another family.

    External databases differ in exact widths, so any number passes for a number and any date or
    timestamp for a time. Extra columns are allowed.
    """
    found = {field.name.lower(): field.dataType for field in df.schema.fields}
    problems = []
    for field in SCHEMAS[table].fields:
        actual = found.get(field.name.lower())
        if actual is None:
            problems.append(f"{field.name} is missing")
        elif _family(actual) != _family(field.dataType):
            wanted = field.dataType.simpleString()
            problems.append(f"{field.name} is {actual.simpleString()}, expected {wanted}")
    if problems:
        raise SchemaError(f"{table}: " + "; ".join(problems))
    return df


def conform(df: DataFrame, table: str, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """The declared columns only, renamed from known aliases and cast to the declared types.

    An amount with more decimals than its declared type keeps is refused when it is read, not rounded.
    """
    names = {name.lower(): target for name, target in {**ALIASES, **(aliases or {})}.items()}
    have = {name.lower() for name in df.columns}
    for column in df.columns:
        target = names.get(column.lower())
        if target is not None and target.lower() not in have:
            df = df.withColumnRenamed(column, target)
    validate_schema(df, table)
    return df.select(*[_cast(df, field) for field in SCHEMAS[table].fields])


def _cast(df: DataFrame, field: T.StructField) -> Column:
    source = F.col(field.name)
    value = source.cast(field.dataType)
    wanted, actual = field.dataType, df.select(source).schema.fields[0].dataType
    if isinstance(wanted, T.DecimalType) and not _fits(actual, wanted):
        lossless = source.isNull() | (value.cast(actual) == source)
        message = f"{field.name} has a value that {wanted.simpleString()} cannot keep"
        value = F.when(lossless, value).otherwise(F.raise_error(F.lit(message)))
    return value.alias(field.name)


def _fits(actual: T.DataType, wanted: T.DecimalType) -> bool:
    if isinstance(actual, T.DecimalType):
        return actual.scale <= wanted.scale and actual.precision - actual.scale <= wanted.precision - wanted.scale
    return isinstance(actual, (T.ByteType, T.ShortType, T.IntegerType))
