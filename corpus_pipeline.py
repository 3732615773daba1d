"""A training corpus from `documents`: rules, exact and near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and its result is written and read again as the docs of
the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.llm import bpe, exact_dedup, packing, pii, quality, simhash
from commerce_lake.llm.common import documents, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.cascade(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest id."""
    return exact_dedup.drop_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (three-word SimHash, at most 2 of 64 bits apart), that with the smallest id."""
    return simhash.drop_near_duplicates(docs, budget=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data and telling terms replaced; `n_chars` follows the text."""
    return pii.sanitise(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents with their places in sequences."""
    return packing.pack(docs, bpe.public_vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("personal data", personal_data),
    ("packing", best_fit_packing),
]

#: The packing, the fingerprints and the disclosure of terms have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
