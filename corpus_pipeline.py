"""The corpus pipeline: documents to a training mix, in five stages.

Every stage works on all rows that the one before kept, written as Parquet in
between. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from payguard.llm import decontaminate, mixing, quality, secrets, simhash
from payguard.llm.common import materialise, table
from payguard.llm.queries import DOCUMENTS
from payguard.session import prepare


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go."""
    return quality.filtered(docs, table(prepare(spark), sf_dir, "labels", "doc_id", "quality"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (three-word shingles, three bits)."""
    prepare(spark)
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.clean(docs, table(prepare(spark), sf_dir, "benchmark", "item_id", "text"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked, live-looking and widely copied ones apart; the documents stay."""
    prepare(spark)
    return secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to the shares of the square roots of their sizes; also ``copy_no`` and ``shuffle_key``."""
    prepare(spark)
    return mixing.mix(docs)


STAGES = [("quality", quality_filter), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("secrets", secret_masking), ("mixing", mixture)]

#: SimHash, the compression classifier and the string kernels have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *DOCUMENTS)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
