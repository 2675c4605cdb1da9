"""The training-data pipeline: documents to packed sequences.

``STAGES`` in order; each takes (spark, docs, sf_dir) and works on all rows its
predecessor kept. ``run`` applies them to ``documents``, writing each stage's
result as Parquet to the shared checkpoint folder and reading it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from packlift.llm import packing, pii, quality, simhash, toxicity
from packlift.llm.common import stored, table
from packlift.llm.queries import tokenizer_text

# Trained classifiers and minimum-covariance estimates are outside SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5 by the toxicity operator."""
    return toxicity.keep_clean(docs, toxicity.fit_model(docs, table(spark, sf_dir, "labels")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.keep_first(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by tags."""
    return pii.mask(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, tokenizer_text())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("simhash_dedup", drop_near_duplicates),
    ("pii", mask_pii),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
