"""Random sharding by a two-pass external shuffle.

Pass one scatters whole records by a seeded hash into buckets that fit into memory. Pass two takes one bucket at a
time, shuffles it (Fisher-Yates, seeded by the bucket) and writes it; the buckets one after the other are a uniform
permutation of all records. Shards are equal stretches of that permutation: their counts differ by one at most, and a
bucket writes into one or two of them as a rule.

The hash covers key and text, so copies of a text and rows without a key scatter too; a bucket holds about
``bucket_bytes`` whatever repeats. Only rows that are equal in both stay together. A bucket's rows are put into an
order of their own before they are shuffled, so a task that runs again on another executor writes the same result.

Null texts count as empty. An empty table gives no rows. All columns of the input are written; an input column named
``shard``, ``slot`` or ``bucket`` is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from foliospark.llm.common import new_path, unused_name

SHARDS = 16
SEED = 42
BUCKET_BYTES = 32 * 1024**2
OWN = ("bucket", "shard", "slot")


def byte_size(text: str) -> Column:
    """UTF-8 bytes of the text, and one for its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def scattered(docs: DataFrame, buckets: int, key: str, text: str, seed: int) -> DataFrame:
    spread = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    return docs.withColumn("bucket", F.pmod(spread, F.lit(buckets)).cast("int"))


def first_places(rows: DataFrame) -> DataFrame:
    """Rows before each bucket: one row for each bucket, so few against the records."""
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("bucket")) - F.col("n")
    return counts.select("bucket", before.alias("before"))


def shuffled_bucket(key: str, text: str, seed: int, shards: int, rows: int, schema: StructType, start_of: str):
    small, larger = divmod(rows, shards)  # the first `larger` shards hold one row more

    def shuffle(bucket: pa.Table) -> pa.Table:
        table = bucket.sort_by([(name, "ascending") for name in (key, text)])
        number, before = table["bucket"][0].as_py(), table[start_of][0].as_py()
        order = np.arange(len(table))
        np.random.default_rng([seed, number]).shuffle(order)  # Fisher-Yates
        place = before + np.arange(len(table), dtype=np.int64)
        edge = larger * (small + 1)
        shard = np.where(
            place < edge, place // (small + 1), larger + (place - edge) // max(small, 1)
        )
        start = np.where(place < edge, shard * (small + 1), edge + (shard - larger) * small)
        table = table.take(pa.array(order)).drop_columns(["bucket", start_of])
        table = table.append_column("shard", pa.array(shard, pa.int32()))
        return table.append_column("slot", pa.array(place - start, pa.int64())).select(schema.names)

    return shuffle


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = SHARDS,
    key: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Write the records, shuffled, to ``path`` as Parquet with a folder for each shard, and read them back.

    ``shard`` and ``slot`` (from 0, without gaps) give the place of a record.
    """
    docs = docs.drop(*OWN)
    total = docs.agg(F.sum(byte_size(text)), F.count(F.lit(1))).first()
    size, rows = total[0] or 0, total[1]
    schema = StructType(docs.schema.fields).add("shard", IntegerType()).add("slot", LongType())
    if not rows:
        return docs.sparkSession.createDataFrame([], schema)
    buckets = max(1, -(-size // bucket_bytes))
    scatter = scattered(docs, buckets, key, text, seed)
    before = unused_name(docs, "_before")
    placed = scatter.join(first_places(scatter).withColumnRenamed("before", before), "bucket")
    shuffle = shuffled_bucket(key, text, seed, shards, rows, schema, before)
    placed.groupBy("bucket").applyInArrow(shuffle, schema).write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def shard(docs: DataFrame, **options) -> DataFrame:
    """``write_shards`` into a new folder beside the cluster's checkpoints."""
    return write_shards(docs, new_path(docs.sparkSession, "shards"), **options)
