"""From raw documents to packed training sequences.

Each stage works on what the one before has kept: low quality goes, one document of each group of
near-duplicates stays, documents that hold a benchmark item go, secrets are masked, and the rest is
packed. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.llm import decontaminate, packing, quality, secrets, simhash
from stockledger.llm.queries import documents
from stockledger.llm.store import staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the rule ensemble, fitted on their labels, rejects."""
    model = quality.fit(docs, documents(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least id of each group that links of the SimHash operator reach: three-word shingles, at most 3 bits."""
    documents(spark, sf_dir)
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    return decontaminate.drop_leaks(docs, documents(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; ``n_chars`` follows the text."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in masked.columns else masked


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of full sequences."""
    documents(spark, sf_dir)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Fitted models, hashes and token ids are beyond SQL; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each result written before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
