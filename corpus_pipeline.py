"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), calls one operator of the library, and returns
the rows it keeps; between stages the rows are written as Parquet and read again.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoreline.llm import exact_dedup, mixing, packing, quality, simhash_dedup
from shoreline.llm.common import materialise, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.  It learns from the labelled
    rows of the table of documents as it was given, so the model does not depend on
    what reaches the stage."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return simhash_dedup.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their fitted rate says, which brings the expected
    token totals of the domains to the target weights.  The posterior is learnt from the
    table of documents as it was given: of low quality hardly any are left here."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"), train=table(spark, sf_dir, "documents"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a packed sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_duplicates),
    ("simhash_dedup", near_duplicates),
    ("mixing", mixture),
    ("packing", sequences),
]

#: Classifiers, fingerprints and packing are beyond SQL; tests hold the rows against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
