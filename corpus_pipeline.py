"""From raw documents to packed token sequences, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written and read again as the next one's
``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattspark.llm import catalog, exact_dedup, mixing, quality, simhash
from wattspark.llm.common import materialize, read_table
from wattspark.session import ship_package

#: SQL can state neither the trained labelling nor the fingerprints.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the base rules or the line field reject."""
    ship_package(spark)
    field = quality.train_field(docs, read_table(spark, sf_dir, "labels"))
    return quality.label_quality(docs, field).filter("kept").select(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the document with the smallest id."""
    ship_package(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group within two bits over 3-word shingles."""
    ship_package(spark)
    return simhash.drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources to their targets: a document appears once per pass that takes it."""
    ship_package(spark)
    return mixing.mix_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 1024 tokens, ids included."""
    ship_package(spark)
    return catalog.packed_ids(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("SimHash near-dedup", near_duplicates),
    ("source mixing", source_mix),
    ("best-fit packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on what its predecessor kept."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, "pipeline-stage")
    return docs
