"""A corpus pipeline: quality rules, exact and near duplicates, mixing, tokenizing.

Each stage takes (spark, docs, folder) and works on all that the one before kept. Between stages the rows are written as
Parquet and read again, so a lost executor costs a stage at most and no plan spans two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliospark.llm import content_sort, mixing, pieces, repetition, simhash
from foliospark.llm.common import documents, new_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return repetition.kept_rows(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return content_sort.one_of_each(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (three-word shingles) link within three bits."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: a row for each copy."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each row, as digests."""
    return pieces.encode(docs, digests=True)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("source mix", mix),
    ("sentencepiece", tokens),
]

#: SQL has no fingerprints, random rounding or tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir)
    for _, stage in STAGES:
        path = new_path(spark, "stage")
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
