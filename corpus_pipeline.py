"""A training corpus from raw documents, one operator after another."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import stages
from orderloom.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.drop_toxic),
    ("line_dedup", stages.drop_lines),
    ("simhash_near_dedup", stages.drop_near_copies),
    ("benchmark_decontamination", stages.drop_leaks),
    ("mixing", stages.mix),
]

# Trained classifiers and fingerprints are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that the stage before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_dir(spark, "corpus")
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
