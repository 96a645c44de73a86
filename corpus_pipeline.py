"""From raw documents to packed sequences, a written table after each stage."""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cestero.llm import near_dup, packing, quality, suffix_dedup, toxicity  # noqa: E402
from cestero.llm.text import staged, table  # noqa: E402

#: No SQL can express the learnt stages.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is less likely toxic than the threshold. The model is learnt
    from ``documents`` and ``labels`` in ``sf_dir``."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity(F.col("text"), model) < toxicity.THRESHOLD)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text reaches the quality threshold."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(quality.quality(F.col("text"), model) >= quality.THRESHOLD)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates."""
    return near_dup.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts without the passages that an earlier row has."""
    return suffix_dedup.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of tokens in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("quality", of_quality),
    ("near_duplicates", without_near_duplicates),
    ("repeats", without_repeats),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
