"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns the
documents that go on. All but the last return exactly the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corate.llm import decontam, mixing, neardup, pii, toxicity
from corate.llm.common import table, write_stage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go; the classifiers learn from the labels of the documents given."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that with the smallest id."""
    return neardup.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced; no document goes."""
    return pii.sanitise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document taken and epoch, in serving order."""
    return mixing.mix(docs)


STAGES = [("toxicity", reject_toxic), ("near_duplicates", deduplicate), ("decontamination", decontaminate),
          ("personal_data", sanitise), ("mixing", mix)]

# The classifier and the sampled signatures cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table through all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
