"""The registered query of each operator, with production parameters, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    dartminhash, importance, line_dedup, merkle, mixing, nearest, pii, quality_rules, sentencepiece, substring_dedup, target_sampling, toxicity, url_filters)

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = sentencepiece.model_content(spark, sentencepiece.model_path(spark))
    return sentencepiece.encode(read(spark, sf_dir, "documents"), content).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.label_weights(docs, read(spark, sf_dir, "labels"))) \
        .select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(read(spark, sf_dir, "documents"), pii.DEMO_KEY)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_verdicts(read(spark, sf_dir, "documents")) \
        .select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join("removed", ",").alias("removed_lines"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(read(spark, sf_dir, "documents"), digest=True)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(read(spark, sf_dir, "documents")).drop("s1", "s2")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))[0]


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return url_filters.judge(pages, url_filters.page_labels(pages, read(spark, sf_dir, "labels")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(read(spark, sf_dir, "documents"))


def op13_target_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_sampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_nearest, op2_sentencepiece, op3_mix_sources, op4_toxicity, op5_pii, op6_quality_rules, op7_line_dedup, op8_substring_dedup,
    op9_near_duplicates, op10_quality_classifier, op11_url_filters, op12_merkle_manifest, op13_target_sampling)}
