"""The corpus pipeline: documents in, packed sequences out.

Every stage takes (session, documents, folder of the tables), works on all the
stage before it kept, and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beatmetrics.llm import jaccard_join, langid, packing, pii, toxicity
from beatmetrics.llm.common import written
from beatmetrics.llm.queries import tokenizer_path


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is known; those without a letter go."""
    return langid.keep_identified(docs, langid.fit(docs))


def detoxify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score at or above the toxicity threshold of their language."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five words, 0.8)."""
    return jaccard_join.keep_first(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return pii.redact(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the stream of all documents' tokens into sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language ID", identify),
    ("toxicity", detoxify),
    ("n-gram Jaccard join", deduplicate),
    ("PII", redact),
    ("packing", pack),
]

# The stages' models and hashes cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, name.replace(" ", "-"))
    return docs
