"""The corpus pipeline: five stages, each on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet to the shared folder and
the next stage reads it back. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnwise.llm import decontaminate, minhash, mix, pii, toxicity
from churnwise.llm.common import cut, free, written
from churnwise.llm.tables import table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more go. Training reads labels of docs only, as it does in the operator."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id stays."""
    return minhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in place; every document stays."""
    return pii.mask(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: a row for each epoch of each document that the mix takes."""
    return mix.materialize(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("mixing", source_mixing),
]

#: SQL cannot express the toxicity model; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept: list[str] = []
    for name, stage in STAGES:
        before = written()
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
        # the stage is written: what it wrote on the way, and its input, are read no more
        *passing, last = [path for path in written() if path not in before]
        free(spark, passing + kept)
        kept = [last]
    return docs
