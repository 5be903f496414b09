"""From raw documents to token ids: the stages of the training-data pipeline.

Each stage works on all that its predecessor kept and returns the columns of documents, the last one
the token ids. A document leaves by the first stage that drops it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm import bpe_automaton
from wardlens.llm.cotraining import drop_low_quality
from wardlens.llm.exact_dedup import drop_copies
from wardlens.llm.simhash import drop_near_copies
from wardlens.llm.staging import staged, table
from wardlens.llm.tiling import drop_contaminated


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest doc_id."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids and their number."""
    return bpe_automaton.encode(docs).withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("BPE encoding", encode),
]

#: The classifier, the fingerprints, the tiling and the merges are beyond SQL; tests/llm compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return docs
