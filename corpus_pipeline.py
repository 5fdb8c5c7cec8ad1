"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread by the next.

toxic documents go; of each group of near copies one document stays; documents that hold a
benchmark item go; secrets are replaced by their kind; what is left is packed into sequences.
"""
from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from microlake.llm import decontam, packing, secrets, simhash, toxicity  # noqa: E402
from microlake.llm.common import stored, table  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored non-toxic; the network learns from labelled rows among ``docs``."""
    return toxicity.drop_toxic(spark, docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least doc_id, of each component of the SimHash operator."""
    return simhash.keep_one(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return decontam.drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: A trained network, edit distances and a tokenizer decide: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
