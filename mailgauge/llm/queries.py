"""The operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgauge.llm import (
    bilinear,
    decontaminate,
    language,
    lines,
    merkle,
    mixing,
    neighbours,
    quality,
    resampling,
    sharding,
    simhash,
    urls,
    vector_dedup,
)
from mailgauge.llm.common import in_fold, outside_fold, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, by item."""
    return decontaminate.find_contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = quality.classify_quality(docs, labels, outside_fold("doc_id", 3, 1))
    return scored.select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "score", "predicted")


def op3_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_assignments(read_table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = bilinear.score_texts(read_table(spark, sf_dir, "documents"), outside_fold("doc_id", 7, 2))
    return scored.withColumn("held_out", in_fold("doc_id", 7, 2))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_verdicts(read_table(spark, sf_dir, "pages"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read_table(spark, sf_dir, "documents"))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup_digest(read_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train_language_model(docs.filter(outside_fold("doc_id", 5, 0)))
    found = language.detect_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.vector_components(read_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit_manifest(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination,
        op2_quality_classifier,
        op3_sampled_splitters,
        op4_lm_scoring,
        op5_source_mixing,
        op6_url_filter,
        op7_simhash_near_dedup,
        op8_permutation_index,
        op9_line_dedup,
        op10_language_id,
        op11_importance_resampling,
        op12_embedding_near_dedup,
        op13_merkle_manifest,
    )
}
