"""A corpus pipeline over ``documents``: five stages, each one of the document operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from workdays.llm.common import staged
from workdays.llm.decontaminate import without_leaks
from workdays.llm.language import accepted, train
from workdays.llm.mixing import mix
from workdays.llm.near_dedup import one_of_each
from workdays.llm.token_files import tokenize_documents


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by the labelled ones; those that are rejected go."""
    return accepted(docs, train(docs))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return one_of_each(docs, shingle=5, threshold_pct=80)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def blend(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a document is there as often as it is drawn."""
    return mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files, and what is read back from them."""
    return tokenize_documents(docs)


STAGES = [
    ("language", known_language),
    ("near_dedup", distinct),
    ("decontamination", uncontaminated),
    ("mixing", blend),
    ("token_files", token_output),
]

# Compressed sizes, edit distances and token ids are beyond SQL: tests/llm compares with plain forms.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; each stage's rows are written as Parquet and reread by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
