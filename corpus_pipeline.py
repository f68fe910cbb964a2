"""A corpus from raw documents: filters, near-duplicates, decontamination and token ids, one stage after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fairreach.llm import decontaminate, language, sentencepiece, simhash, toxicity
from fairreach.llm.common import table
from fairreach.llm.registry import QUERIES
from fairreach.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the network learns from the labelled rows of ``docs``."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which one learnt language holds at least half of the letters and explains them better than none."""
    return language.drop_unidentified(docs, language.train(language.split_learned(docs)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.keep_one(docs, shingle=4, most=4)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    return sentencepiece.round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_identified),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("sentencepiece", to_pieces),
]

#: Training and segmentation are beyond SQL; the tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each one's rows written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES["pipeline"] = run
