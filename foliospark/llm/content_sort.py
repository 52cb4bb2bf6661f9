"""Exact duplicates by sorting contents.

The normalised texts are dealt to ranges whose splitters Spark samples, and each range is sorted (externally, on disk where
it does not fit), so equal texts lie next to each other. A window compares each whole text with its neighbours: a
run of equals is a group, its first row the one to stay.

Ranges are cut by the start of the text and, among texts with one start, by a hash of the whole text; splitters are drawn from
these, so what the driver gets for them is short however long the texts are. Equal texts always fall into one range. Only texts
that a bounded sample of the rows shows to be hot are dealt to several ranges by a salt from the row's key, one for about ``RANGE_ROWS``
of their rows. The runs of a hot text, a row for each, are then put together by its digest; the digest decides nothing else.

Of equal texts the row with the most code points in its original text stays, then the smallest key; a null key comes
after all others. Of rows equal in both, one stays. Null counts as empty, and empty texts are equal to one another. An empty
table gives no rows. Columns other than key and text are not read, so they cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import checkpointed, chosen, identified

WHITE = " \t\n\x0b\x0c\r"
RANGE_ROWS = 20_000
START_CHARS = 64
SAMPLE_ROWS = 100_000
SAMPLE_LEAST = 10


def normalised(text: str | Column) -> Column:
    column = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    for character in WHITE:
        column = F.replace(column, F.lit(character), F.lit(""))
    return column


def hot_texts(docs: DataFrame, text: str, rows: int) -> DataFrame:
    """``tail, parts``: hashes of texts with more rows than a range should have, by a sample; SAMPLE_ROWS / SAMPLE_LEAST at most."""
    share = min(1.0, SAMPLE_ROWS / max(1, rows))
    least = max(SAMPLE_LEAST, share * RANGE_ROWS / 2)
    sample = docs.sample(share, seed=42).select(F.xxhash64(normalised(text)).alias("tail"))
    counts = sample.groupBy("tail").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return counts.select("tail", F.ceil(F.col("n") / F.lit(share * RANGE_ROWS)).cast("int").alias("parts"))


def runs(docs: DataFrame, key: str, text: str, rows: int, carried: list[str]) -> DataFrame:
    """Each row with its place in the run of equal texts beside it, that run's size and first key, and the digest of the text.

    ``salt`` is null but for hot texts.
    """
    ranges = max(docs.sparkSession.sparkContext.defaultParallelism, -(-rows // RANGE_ROWS))
    texts = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.length(text), F.lit(0)).alias("chars"),
        normalised(text).alias("content"),
        *carried,
    )
    texts = texts.withColumns({"start": F.substring("content", 1, START_CHARS), "tail": F.xxhash64("content")})
    known = texts.join(F.broadcast(hot_texts(docs, text, rows)), "tail", "left")
    salted = known.withColumn("salt", F.pmod(F.xxhash64(F.lit(1), F.col("key")), F.col("parts")).cast("int"))
    ranged = salted.drop("parts").repartitionByRange(ranges, "start", "tail", "salt")
    run = Window.partitionBy("start", "tail", "salt", "content").orderBy(F.desc("chars"), F.asc_nulls_last("key"))
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return ranged.select(
        "key",
        "chars",
        "salt",
        F.row_number().over(run).alias("place"),
        F.count(F.lit(1)).over(whole).alias("size"),
        F.first("key").over(whole).alias("first"),
        F.sha2("content", 256).alias("digest"),
        *carried,
    )


def groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", carried: list[str] | None = None
) -> DataFrame:
    """``key, keep_id, group_size, kept, text_sha256`` for each row, and the ``carried`` columns."""
    carried = carried or []
    rows = checkpointed(runs(docs, key, text, docs.count(), carried))

    def result(df: DataFrame, keep: Column, size: Column, kept: Column) -> DataFrame:
        return df.select(
            F.col("key").alias(key),
            keep.alias("keep_id"),
            size.alias("group_size"),
            kept.alias("kept"),
            F.col("digest").alias("text_sha256"),
            *carried,
        )

    first_of_run = F.col("place") == 1
    alone = result(rows.filter("salt IS NULL"), F.col("first"), F.col("size"), first_of_run)

    hot = rows.filter("salt IS NOT NULL")
    better = F.struct(-F.col("chars"), F.col("key").isNull(), F.col("key"), F.col("salt"))
    heads = hot.filter(first_of_run)  # a row for each run
    best = heads.groupBy("digest").agg(F.sum("size").alias("whole_size"), F.min(better).alias("best"))
    joined = hot.join(best, "digest")
    kept = first_of_run & (F.col("best")["salt"] == F.col("salt"))
    return alone.unionByName(result(joined, F.col("best")["key"], F.col("whole_size"), kept))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of each group that stays, with the columns it came with."""
    rows, names = identified(docs)
    return chosen(rows, groups(rows, key, text, names).filter("kept").select(*names), names)
