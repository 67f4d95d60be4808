"""A training corpus from raw documents: rules, near copies, secrets, mix, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of ``documents``. ``run`` writes each stage's rows under ``spark.checkpoint.dir``
and reads them back for the next, so a lost executor repeats at most part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.llm import mixing, ngram_join, quality_rules, queries, secrets
from barlab.llm.shared import read_table
from barlab.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the risk-controlled rules keep."""
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, similarity 0.8): the smallest id."""
    return ngram_join.keep_one(docs, percent=80, n=5)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the secrets in their texts replaced by their kind."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return queries.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("secret_scan", secret_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

# Randomness tests, shingle components and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
