"""What the catalog and the planner say: tables, columns, pushed filters, errors."""

from __future__ import annotations

import contextlib
import io
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_schemas(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    return spark.sql("SHOW SCHEMAS" + (f" IN {catalog}" if catalog else ""))


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}")


def column_metadata(spark: SparkSession, table: str) -> DataFrame:
    """Name, type and comment of each column."""
    described = spark.sql(f"DESCRIBE TABLE {table}")
    return described.filter(~F.col("col_name").startswith("#") & (F.col("col_name") != ""))


def list_columns(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW COLUMNS IN {table}")


@dataclass(frozen=True)
class Pushdown:
    """What reached the sources: one entry per scan of the plan."""

    filters: list[str]
    partition_filters: list[str]
    read_schemas: list[str]
    external_queries: list[str]
    text: str


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def explain_pushdown(df: DataFrame) -> Pushdown:
    text = explain_text(df)

    def lines(label: str) -> list[str]:
        return re.findall(rf"^{label}: (.*)$", text, flags=re.MULTILINE)

    queries = re.findall(r"External engine query: (.*?)(?:\n\n|$)", text, flags=re.DOTALL)
    return Pushdown(
        filters=lines("PushedFilters"),
        partition_filters=lines("PartitionFilters"),
        read_schemas=lines("ReadSchema"),
        external_queries=[q.strip() for q in queries],
        text=text,
    )


@dataclass(frozen=True)
class Failure:
    condition: str | None
    sql_state: str | None
    message: str


def try_action(action: Callable[[], object]) -> tuple[object | None, Failure | None]:
    """Run an action; a Spark error comes back as its condition, SQL state and message."""
    try:
        return action(), None
    except PySparkException as error:
        return None, Failure(error.getCondition(), error.getSqlState(), str(error))
