"""Publishing results: views, table snapshots with a load time, refresh and caching."""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from .operators.changes import change_set
from .plans import ranking, rollup


def publish_view(df: DataFrame, name: str) -> str:
    """Session view, replaced if it exists; nothing runs until someone reads it."""
    df.createOrReplaceTempView(name)
    return name


def publish_sql_view(spark: SparkSession, name: str, text: str) -> str:
    """Catalog view from SQL text, for results that must outlive the session."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
    return name


def _partitioned(df: DataFrame, columns: Sequence[str]) -> DataFrameWriter:
    """Overwriting Parquet writer.

    With partition columns, rows are gathered by them first, so each value gets few files; adaptive
    execution splits a value that holds too much for one task.
    """
    if not columns:
        return df.write.mode("overwrite").format("parquet")
    gathered = df.hint("rebalance", *columns)
    return gathered.write.mode("overwrite").format("parquet").partitionBy(*columns)


def publish_table(
    df: DataFrame,
    name: str,
    loaded_at: dt.datetime | None = None,
    *,
    stamp: bool = False,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Write a snapshot and return it as read back.

    ``stamp`` adds ``last_updated``: ``loaded_at``, or the time of the query if that is not given.
    Readers of the returned frame start from files, so a lost executor costs no recomputation of
    what came before.
    """
    spark = df.sparkSession
    if stamp:
        moment = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
        df = df.withColumn("last_updated", moment)
    writer = _partitioned(df, partition_by)
    if path is not None:
        writer.save(path)
        return spark.read.parquet(path)
    _replace_table(spark, writer, name)
    return spark.table(name)


def _replace_table(spark: SparkSession, writer: DataFrameWriter, name: str) -> None:
    """Write beside the table and take its place only when all is written, so a failed run leaves it as it was."""
    staged = f"{name}__new"
    writer.saveAsTable(staged)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by the cluster in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise LookupError("spark.checkpoint.dir is not set")
    return folder.rstrip("/")


def working_folder(spark: SparkSession) -> str:
    """The shared folder, or where none is named a folder in the warehouse, which all executors reach too."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/work"


def snapshot(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so that later jobs start from files."""
    folder = shared_folder(df.sparkSession)
    return publish_table(df, name, path=f"{folder}/{name}")


def refresh(spark: SparkSession, *names: str) -> None:
    """Forget cached files and metadata of tables or views that others have rewritten."""
    for name in names:
        spark.catalog.refreshTable(name)


PART = "part"


def publish_parts(df: DataFrame, path: str, keys: Sequence[str], parts: int) -> DataFrame:
    """Write a snapshot in parts by a hash of its keys, for ``refresh_parts`` to keep up to date."""
    _partitioned(df.withColumn(PART, _part_of(keys, parts)), [PART]).save(path)
    return df.sparkSession.read.parquet(path).drop(PART)


def _part_of(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def refresh_parts(df: DataFrame, path: str, keys: Sequence[str], parts: int) -> dict[str, int]:
    """Bring a snapshot of ``publish_parts`` up to date and return how many keys were added, removed and changed.

    The snapshot is compared with ``df`` by digests of the rows, and only parts that hold a difference are written anew;
    files of all others stay as they are. Each part is replaced as a whole. A refresh that fails leaves parts of both
    versions; the next one finds what still differs. ``parts`` must be the number the snapshot was published with.
    """
    spark = df.sparkSession
    spark.catalog.refreshByPath(path)
    stored = spark.read.parquet(path)
    old = stored.select(*df.columns, _part_of(keys, parts).alias(PART))
    new = df.withColumn(PART, _part_of(keys, parts))
    if not stored.filter(F.col(PART) != _part_of(keys, parts)).isEmpty():
        raise ValueError(f"{path} was not published in {parts} parts")
    changes = change_set(old, new, [PART, *keys]).groupBy(PART, "change").agg(F.count("*").alias("n"))
    counts = changes.collect()  # three rows for each part at most
    touched = sorted({row[PART] for row in counts})
    if touched:
        rows = new.filter(F.col(PART).isin(touched))
        left = {row[PART] for row in rows.select(PART).distinct().collect()}
        _partitioned(rows, [PART]).option("partitionOverwriteMode", "dynamic").save(path)
        _drop_parts(spark, path, [part for part in touched if part not in left])
    spark.catalog.refreshByPath(path)
    totals = {"added": 0, "removed": 0, "changed": 0}
    for row in counts:
        totals[row["change"]] += row["n"]
    return totals


def _drop_parts(spark: SparkSession, path: str, parts: Sequence[int]) -> None:
    """Parts that have no rows any more: an overwrite by parts does not touch them."""
    for part in parts:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PART}={part}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def publish_portfolio(
    dashboard: DataFrame, prefix: str, loaded_at: dt.datetime | None = None, emoji: bool = False
) -> dict[str, str]:
    """The daily job: the dashboard is computed once and everything else reads its snapshot.

    All results are tables under the full prefix, catalog and schema included, so that other sessions
    read them and portfolios with unlike prefixes stand side by side.
    """

    def name(part: str) -> str:
        return f"{prefix}{part}"

    snapshot = publish_table(dashboard, name("portfolio_dashboard"))
    publish_table(
        rollup.portfolio_summary(snapshot), name("portfolio_summary"), loaded_at, stamp=True
    )
    items = ranking.action_items(snapshot, emoji=emoji, with_rank=True)
    publish_table(items, name("action_items"), loaded_at, stamp=True)
    publish_table(ranking.stock_rankings(snapshot), name("stock_rankings"))
    derived: Mapping[str, Callable[[DataFrame], DataFrame]] = {
        "portfolio_overview": rollup.portfolio_overview,
        "risk_distribution": rollup.risk_distribution,
        "action_distribution": rollup.action_distribution,
        "stock_performance": lambda df: ranking.stock_performance(df, emoji=emoji),
    }
    for part, build in derived.items():
        publish_table(build(snapshot), name(part))
    tables = ("portfolio_dashboard", "portfolio_summary", "action_items", "stock_rankings")
    return {part: name(part) for part in (*tables, *derived)}


@contextlib.contextmanager
def cached(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep reference frames in memory (spilling to disk) inside a ``with`` block."""
    held = tuple(df.persist(StorageLevel.MEMORY_AND_DISK) for df in frames)
    try:
        yield held
    finally:
        for df in held:
            df.unpersist()


def share_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write a Parquet snapshot for another workspace to read by path."""
    _partitioned(df, partition_by).save(path)
    return path
