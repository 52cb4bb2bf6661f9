"""External databases read in place through Spark's JDBC source.

Filters, columns, limits and aggregates that Spark can translate run in the database. Credentials
never appear in code: ``Secret`` names an environment variable or a Spark setting that is read when
the options are built.
"""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from ..schemas import conform

JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"
MASK = "*****"

# URL pattern and driver class per kind of database.
KINDS: dict[str, tuple[str, str]] = {
    "sqlserver": (
        "jdbc:sqlserver://{host}:{port};databaseName={database}",
        "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    ),
    "mysql": ("jdbc:mysql://{host}:{port}/{database}", "com.mysql.cj.jdbc.Driver"),
    "postgresql": ("jdbc:postgresql://{host}:{port}/{database}", "org.postgresql.Driver"),
    "snowflake": (
        "jdbc:snowflake://{host}:{port}/?db={database}",
        "net.snowflake.client.jdbc.SnowflakeDriver",
    ),
}
PORTS = {"sqlserver": 1433, "mysql": 3306, "postgresql": 5432, "snowflake": 443}


@dataclass(frozen=True)
class Secret:
    """Where a credential lives: an environment variable or a Spark setting."""

    env: str | None = None
    conf: str | None = None

    def resolve(self, spark: SparkSession) -> str:
        if self.env is not None and self.env in os.environ:
            return os.environ[self.env]
        if self.conf is not None:
            value = spark.conf.get(self.conf, None)
            if value is not None:
                return value
        raise LookupError(f"no credential under environment {self.env!r} or setting {self.conf!r}")


@dataclass(frozen=True)
class Partitioning:
    """Parallel read: ``count`` tasks, each with its own range of a numeric, date or time column."""

    column: str
    lower: object
    upper: object
    count: int

    def options(self) -> dict[str, str]:
        if self.count < 1:
            raise ValueError("a partitioned read needs at least one partition")
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


def connection_options(
    kind: str,
    host: str,
    database: str,
    port: int | None = None,
    user: str | Secret | None = None,
    password: Secret | None = None,
) -> dict[str, object]:
    """Options for a database of a known kind; secrets stay unresolved."""
    if kind not in KINDS:
        raise ValueError(f"unknown source kind {kind!r}; known: {', '.join(KINDS)}")
    url, driver = KINDS[kind]
    filled = url.format(host=host, port=port or PORTS[kind], database=database)
    return jdbc_options(filled, driver, user, password)


def jdbc_options(
    url: str, driver: str, user: str | Secret | None = None, password: Secret | None = None
) -> dict[str, object]:
    """Options for any other source with a JDBC driver, such as a SQL endpoint of a workspace."""
    if password is not None and not isinstance(password, Secret):
        raise TypeError("password must be a Secret, not a literal")
    options: dict[str, object] = {"url": url, "driver": driver}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def resolve_options(spark: SparkSession, options: Mapping[str, object]) -> dict[str, str]:
    return {
        key: value.resolve(spark) if isinstance(value, Secret) else str(value)
        for key, value in options.items()
    }


# Option names whose values are never shown.
CREDENTIAL = re.compile(r"(?i)password|passphrase|secret|token|key|credential|pwd")


def register_federated(
    spark: SparkSession,
    name: str,
    options: Mapping[str, object],
    push_aggregates: bool = True,
    fetch_size: int = 10_000,
) -> str:
    """Make a database readable as catalog ``name``: ``spark.table("name.schema.table")``.

    Settings take effect on the first use of the catalog, so register before reading.
    """
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, JDBC_CATALOG)
    settings = {"pushDownAggregate": str(push_aggregates).lower(), "pushDownLimit": "true"}
    settings["fetchsize"] = str(fetch_size)
    for key, value in {**settings, **resolve_options(spark, options)}.items():
        spark.conf.set(f"{prefix}.{key}", value)
    return name


def read_federated(
    spark: SparkSession,
    table: str,
    columns: Sequence[str] | None = None,
    predicate: str | Column | None = None,
    *,
    options: Mapping[str, object] | None = None,
    partition: Partitioning | None = None,
    fetch_size: int = 10_000,
    logical: str | None = None,
) -> DataFrame:
    """Scan an external table, with the columns and the filter sent to the database.

    ``table`` is a catalog name unless ``options`` give a connection. Without ``partition`` the
    whole scan is one task: give a range for any table beyond a few million rows. ``logical`` brings
    the rows to the declared schema of that table, whatever the letter case at the source.
    """
    if options is None:
        ranges = {} if partition is None else partition.options()
        rows = spark.read.options(**ranges).table(table)
    else:
        reader = spark.read.format("jdbc").options(**resolve_options(spark, options))
        reader = reader.option("dbtable", table).option("fetchsize", fetch_size)
        if partition is not None:
            reader = reader.options(**partition.options())
        rows = reader.load()
    if predicate is not None:
        rows = rows.filter(predicate)
    if logical is not None:
        rows = conform(rows, logical)
    return rows if columns is None else rows.select(*columns)


def describe_sources(spark: SparkSession) -> DataFrame:
    """Registered catalogs and their settings, one row each, with credentials masked."""
    prefix = "spark.sql.catalog."
    rows = []
    for key, value in sorted(spark.conf.getAll.items()):
        if not key.startswith(prefix):
            continue
        name, _, option = key[len(prefix):].partition(".")
        hidden = option.lower() == "user" or CREDENTIAL.search(option)
        shown = MASK if hidden else _without_credentials(value)
        rows.append((name, option or "implementation", shown))
    return spark.createDataFrame(rows, "source string, option string, value string")


def _without_credentials(text: str) -> str:
    """Masks user and password given inside a URL."""
    text = re.sub(r"(?i)((?:user|uid|[a-z_]*(?:password|passphrase|secret|token|key|credential|pwd)[a-z_]*)=)[^;&]*", rf"\g<1>{MASK}", text)
    return re.sub(r"//[^/@\s]+@", f"//{MASK}@", text)
