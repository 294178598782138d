"""The corpus pipeline: five of the library's operators, one after another.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept;
between stages the rows are written as Parquet in the shared scratch folder and read again.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import decontam, mixing, quality, queries, simhash
from corpusmill.session import scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules, the likelihood-ratio and the toxicity threshold."""
    trusted = queries.trusted_documents(spark, sf_dir)
    return quality.keep_quality(docs, trusted, labels=queries.toxic_labels(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each SimHash class."""
    return simhash.keep_one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontam.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for every copy that is taken."""
    return mixing.mixed(docs, emphasis=queries.mix_emphasis())


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in ascending doc_id order; a row per document, read back from them."""
    return queries.token_table(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
    ("token_output", token_output),
]

#: Hashed n-grams, XXH64 and the tokenizer have no counterpart in SQL; tests/llm compares
#: the pipeline with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
