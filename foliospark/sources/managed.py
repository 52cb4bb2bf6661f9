"""Tables Spark stores itself."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import conform


def read_managed(spark: SparkSession, table_or_path: str, table: str | None = None) -> DataFrame:
    """A catalog table, or a Parquet folder when the name contains a slash.

    With ``table`` the frame is brought to the declared schema of that logical table.
    """
    if "/" in table_or_path:
        rows = spark.read.parquet(table_or_path)
    else:
        rows = spark.table(table_or_path)
    return rows if table is None else conform(rows, table)


def query(spark: SparkSession, text: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """SQL text with named parameter markers."""
    return spark.sql(text, args=dict(args) if args else None)


def ingest_positions(
    rows: DataFrame, target: str, table: str = "customer_holdings", keep_extra: bool = False
) -> None:
    """Append positions to a holdings table (catalog name or Parquet folder), checked first."""
    checked = conform(rows, table)
    if keep_extra:
        declared = {name.lower() for name in checked.columns}
        extra = [name for name in rows.columns if name.lower() not in declared]
        checked = rows.select(*checked.columns, *extra)
    writer = checked.write.mode("append")
    if "/" in target:
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def connection_test(df: DataFrame) -> DataFrame:
    """One row if the source answers and has rows."""
    return df.select(F.lit(1).alias("test")).limit(1)
