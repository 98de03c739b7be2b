"""Corpus pipeline over ``documents``: toxic documents go, one document of each near-duplicate group stays,
secrets are masked, and what is left is packed into sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but the last
return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.packing import pack_documents
from geoloom.llm.queries import vocabulary
from geoloom.llm.secrets import fit_forest, labelled_findings, redact
from geoloom.llm.simhash import one_of_each
from geoloom.llm.toxicity import fit, keep_clean
from geoloom.operators.checkpoints import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not found toxic by a model fitted to the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return keep_clean(docs, fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (smallest id) of each component of near duplicates: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more are linked."""
    return one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by a mask."""
    return redact(docs, fit_forest(labelled_findings(spark)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their places in sequences."""
    return pack_documents(docs, vocabulary())


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates), ("secret_scan", mask_secrets), ("best_fit_packing", pack)]

#: A fitted model, fingerprint components and tokenizer ids are beyond SQL; tests/llm hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
