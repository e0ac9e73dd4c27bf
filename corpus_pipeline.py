"""A training corpus from ``documents``: five stages, each an operator of ledgerleaf.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerleaf.llm import lines, mixing, neardup, packing, quality
from ledgerleaf.llm.tools import table
from ledgerleaf.session import written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by ``labels``, scores at 0.5 or more."""
    return quality.good_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds."""
    return lines.deduplicated_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.distinct_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("packing", pack),
]

# SQL can express neither the classifier nor the packing; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
