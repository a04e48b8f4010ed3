"""From raw documents to packed training sequences, stage by stage.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows of ``docs`` and
returns a DataFrame, which is written and read again for the next stage. All
but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableloom.llm.byte_cnn import fit, keep_good
from tableloom.llm.fertility import keep_by_rules
from tableloom.llm.queries import PIECES, mixed_documents, packed_documents
from tableloom.llm.tables import load
from tableloom.llm.weighted_minhash import near_duplicates, one_of_each
from tableloom.session import scratch_path


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled ones, takes for good."""
    return keep_good(docs, fit(docs, load(spark, sf_dir, "labels")))


def ruled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_by_rules(docs, PIECES)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates, that of the smallest ``doc_id``."""
    return one_of_each(docs, near_duplicates(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in training sequences."""
    return packed_documents(docs)


STAGES = [
    ("quality classifier", classified),
    ("quality rules", ruled),
    ("MinHash near-dedup", deduplicated),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

#: A trained network and a vocabulary have no SQL form; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
