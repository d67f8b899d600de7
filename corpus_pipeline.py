"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns the
columns of documents; the last one returns the packed pieces. `run` writes every stage's
rows as Parquet to the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenderlake.llm import jaccard, language, mixing, packing, toxicity
from tenderlake.llm.common import prepare, stored, table
from tenderlake.llm.queries import vocabulary


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold; the others go."""
    return toxicity.keep_harmless(docs, table(prepare(spark), sf_dir, "labels"))


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language is told; the others go."""
    prepare(spark)
    return language.keep_identified(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return jaccard.keep_one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat_taken(docs, table(prepare(spark), sf_dir, "labels"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their sequences."""
    prepare(spark)
    return packing.pack_documents(docs, vocabulary(), remember=False)


STAGES = [
    ("toxicity", harmless),
    ("language", identified),
    ("near_duplicates", distinct),
    ("mixing", mixed),
    ("packing", packed),
]

# Learned scores, similarity joins and packing: no stage but the mix can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the corpus made from the documents in `sf_dir`."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
