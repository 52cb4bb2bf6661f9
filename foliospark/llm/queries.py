"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import (
    content_sort,
    decontaminate,
    licenses,
    mixing,
    phrases,
    pieces,
    repetition,
    secret_scan,
    sharding,
    simhash,
    toxicity,
    url_rules,
    whitening,
)
from foliospark.llm.common import documents

HELD_OUT = 2  # remainder of the id's checksum modulo 4
TOXIC_SCORE = 0.3

Query = Callable[[SparkSession, str], DataFrame]


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder)).withColumn("n_blocks", F.size("blocks").cast("long")).drop("blocks")


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    limit = repetition.Limits().longest_words
    rules = repetition.rules(documents(spark, folder))
    return rules.withColumn("long_repeat", F.col("longest_repeat") > limit).drop("longest_repeat")


def sharding_two_pass(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(documents(spark, folder)).select(
        "doc_id",
        sharding.byte_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def sentencepiece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(documents(spark, folder), digests=True)


def toxicity_machine(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False))
    score = toxicity.score(toxicity.learn(docs.filter(~held_out), labels.filter(~held_out)))
    scored = docs.select("doc_id", held_out.alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_SCORE).cast("int"))


def secrets_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(documents(spark, folder))


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.copies(documents(spark, folder))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mix.select("doc_id", "size", "source_size", "target", taken)


def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(spark.read.parquet(f"{folder}/pages.parquet"))


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return content_sort.groups(documents(spark, folder))


def simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(documents(spark, folder))
    return found.select("doc_id", simhash.as_hex("bits").alias("fingerprint"), "component_id")


def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(documents(spark, folder))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontaminate.hits(documents(spark, folder), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.components(spark.read.parquet(f"{folder}/embeddings.parquet"))


def registry() -> dict[str, Query]:
    return {
        "op1_license_scan": license_scan,
        "op2_quality_rules": quality_rules,
        "op3_sharding": sharding_two_pass,
        "op4_sentencepiece": sentencepiece_encoding,
        "op5_toxicity": toxicity_machine,
        "op6_secret_scan": secrets_scan,
        "op7_source_mix": source_mix,
        "op8_url_filter": url_filter,
        "op9_exact_dedup": exact_dedup,
        "op10_simhash": simhash_groups,
        "op11_phrases": phrase_collocations,
        "op12_decontamination": decontamination,
        "op13_whitening": embedding_whitening,
    }
