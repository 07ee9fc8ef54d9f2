"""Documents to a cleaned, encoded corpus, one written stage after another.

Every stage but the last returns the columns of the documents it was given. Each works on
all rows that the stage before it kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loglake.llm import decontaminate, lang_id, line_dedup, near_dup, segment_sampling
from loglake.session import fresh_path, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier rejects go. It learns from the labelled rows it is given."""
    return lang_id.accepted(docs, lang_id.fit(docs.select("doc_id", "lang", "text")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them only; n_chars follows the text."""
    cleaned = line_dedup.dedup_lines(docs, fresh_path(spark, "line-index"))
    return line_dedup.with_length(cleaned).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8."""
    return near_dup.keep_one(docs).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, items).select(*docs.columns)


def segments(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document, with their scores."""
    return segment_sampling.encode(docs, keep=["doc_id"])


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("segments", segments),
]

# SQL has no word for the classifier or the sampled segmentations; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
