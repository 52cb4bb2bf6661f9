"""The live side of "today plus history", kept up to date by a stream.

Windowed totals are held in Spark's state store; a watermark closes a window once no row for it is accepted any more. Each
micro-batch publishes the windows it changed under its own number. A batch that is run again after a failure overwrites
its own folder, so readers, who take the newest row of each window, never count anything twice.

Rows that come later than the watermark allows are left out by the stream and reported by ``dropped_late``; they are not
lost, as a day that is over is read from the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.numeric import exact_sum

BATCH = "batch"


def read_files(
    spark: SparkSession, path: str, schema: StructType | str, *, files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files under a path as a stream, the oldest first."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def windowed_totals(
    events: DataFrame,
    *,
    time: str,
    value: str,
    keys: Sequence[str] = (),
    window: str = "1 hour",
    lateness: str = "1 hour",
) -> DataFrame:
    """Rows and total of each window of event time, per key. Works on a stream and on a table alike.

    Rows without a time belong to no window. Sums are exact, so the order in which rows arrive does not change them.
    """
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark(time, lateness)
    grouped = timed.groupBy(F.window(time, window).alias("window"), *keys)
    totals = grouped.agg(F.count("*").alias("events"), exact_sum(F.col(value)).alias("total"))
    start = F.col("window")["start"].cast("timestamp_ntz").alias("window_start")
    return totals.select(start, *keys, "events", "total")


def publish_windows(totals: DataFrame, path: str, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    """Start publishing; without ``every`` the query ends when all that is there has been read.

    Started again with the same checkpoint, it goes on where it stopped.
    """

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")

    writer = totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(write)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def published(spark: SparkSession, path: str, schema: StructType | str, keys: Sequence[str] = ()) -> DataFrame:
    """The newest row of every window. ``schema`` is that of the totals."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = declared.fieldNames()
    rows = spark.read.schema(StructType([*declared.fields]).add(BATCH, "long")).parquet(path)
    values = [name for name in columns if name not in ("window_start", *keys)]
    newest = F.max_by(F.struct(*values), F.col(BATCH)).alias("newest")
    return rows.groupBy("window_start", *keys).agg(newest).select("window_start", *keys, "newest.*")


def dropped_late(query: StreamingQuery) -> int:
    """Rows the query has left out so far because they came after their window was closed."""
    operators = (operator for progress in query.recentProgress for operator in progress["stateOperators"])
    return sum(operator["numRowsDroppedByWatermark"] for operator in operators)


def live_windows_and_history(
    windows: DataFrame,
    history: DataFrame,
    *,
    time: str,
    value: str,
    keys: Sequence[str] = (),
    as_of: dt.date,
) -> DataFrame:
    """The published windows from ``as_of`` on, and one row per key with the totals of all earlier days."""
    moment = F.lit(dt.datetime.combine(as_of, dt.time())).cast("timestamp_ntz")
    live = windows.filter(F.col("window_start") >= moment)
    live = live.select(F.lit("Real-Time").alias("source"), *keys, "window_start", "events", "total")
    earlier = history.filter(F.col(time) < moment).groupBy(*keys)
    totals = earlier.agg(F.count("*").alias("events"), exact_sum(F.col(value)).alias("total"))
    nothing = F.lit(None).cast("timestamp_ntz").alias("window_start")
    return live.unionByName(totals.select(F.lit("Historical").alias("source"), *keys, nothing, "events", "total"))
