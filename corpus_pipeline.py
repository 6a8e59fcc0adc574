"""From documents to a sharded corpus: each stage calls one operator and keeps what it decides to keep."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgauge.llm import decontaminate, language, mixing, sharding, simhash
from mailgauge.llm.common import numbered, position, read_table
from mailgauge.sources.scratch import land, remove

# A text whose likeliest language is less probable than this is rejected.
LANGUAGE_SCORE = 0.5
SHINGLE = 4
MAX_DISTANCE = 4
SHARDS = 16


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus names; texts that are null, empty, without letters or undecided go.

    Equally likely languages share their probability, so such a text goes.  Repeated rows go the same way, long texts are
    read whole, and a corpus that names no language keeps nothing.
    """
    model = language.train_language_model(docs)
    found = language.detect_language(numbered(docs), model, position(docs, "text"))
    kept = found.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LANGUAGE_SCORE))
    return kept.select(numbered(docs).columns).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the smallest doc_id, one without only if all are; of rows equal in it one.

    Null, empty and blank texts have one fingerprint and are a group.  Long texts count whole; no documents give none.
    """
    return simhash.drop_near_duplicates(docs, shingle=SHINGLE, max_distance=MAX_DISTANCE)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, rows as they are.

    A null or empty text holds none and stays, as all do where the benchmark has no rows; repeated rows go the same way.
    """
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with flatter marginals of source, language and topic.

    Null is a source or language like others; documents without a word, null texts too, are never drawn.  Rows of equal id and
    cell go the same way.  No documents give none.
    """
    return mixing.sample_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document left.

    A null text is a text of its own, of size 1; copies lie side by side, and are divided where they fill more than a range.
    """
    return sharding.shard_assignments(docs, SHARDS)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The stages learn, hash and sample in ways that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result stored and read again."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir))
        # What a stage has read is not read again once its own result is stored.
        if before is not None:
            remove(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
