"""Pipeline over ``documents``: rules, near duplicates, secrets, mixing, packing.

Each stage takes all rows its predecessor kept and returns the columns of ``documents``; the
last returns pieces of sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logtide.llm.common import read_table, written
from logtide.llm.mixing import mixed
from logtide.llm.packing import pack
from logtide.llm.quality_rules import keep_good
from logtide.llm.secret_scan import redact, samples, train
from logtide.llm.simhash import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a placeholder."""
    return redact(docs, train(samples(docs)))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix draws it; one drawn in part keeps its first words."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return pack(docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

# The token ids of the packing stage are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what one returns is written and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"stage-{number}")
    return docs
