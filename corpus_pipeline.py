"""From raw documents to packed training sequences, in five stages.

Each stage takes all that its predecessor kept; what it decides takes effect.  All but the
last return rows of ``documents`` with their columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratingloom.checkpoints import stage
from ratingloom.llm.contamination import drop_contaminated
from ratingloom.llm.exact import drop_copies
from ratingloom.llm.jaccard import drop_similar
from ratingloom.llm.packing import pack_documents
from ratingloom.llm.quality import fit_quality, keep_good

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from ``labels``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, fit_quality(docs, labels))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return drop_copies(docs)


def distinct_shingles(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity connect, the one with the smallest id stays."""
    return drop_similar(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of ``benchmark`` occurs go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenised pieces of all that is left, with their sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_lines),
    ("exact_dedup", distinct_texts),
    ("jaccard_join", distinct_shingles),
    ("decontamination", clean_of_benchmark),
    ("packing", packed),
]

# Neither the classifier nor the tokeniser can be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
