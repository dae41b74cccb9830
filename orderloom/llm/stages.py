"""Operators as stages: documents in, documents out, with the same columns.

Every stage works on all rows it is given and takes any further columns along. Rows without
text are empty documents; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..session import scratch_dir
from . import mixing, toxicity
from .batches import documents, fresh
from .decontaminate import decontaminate
from .line_dedup import drop_boilerplate
from .simhash import fingerprints, groups

# Weights of the domains that ``domains`` tells apart.
TARGETS = {"good": 0.95, "poor": 0.05}


def held_out(folds: int, fold: int) -> Column:
    """Rows of one fold by doc_id, and rows without it: never learned from."""
    own = F.crc32(F.col("doc_id").cast("string")) % folds == fold
    return F.coalesce(own, F.lit(True))


def domains(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", F.when(F.col("quality") == 1, "good").when(
        F.col("quality") == 0, "poor").alias("domain"))


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, brought in line with the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold."""
    model = toxicity.train(docs, documents(spark, sf_dir, "labels"), ~held_out(4, 2))
    return docs.where(toxicity.toxicity(model, F.col("text")) < toxicity.THRESHOLD)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    return _with_length(drop_boilerplate(spark, docs, "source"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: that of the smallest doc_id (NULL last) and then of
    the smallest digest of id and text. Of rows that repeat both, one stays."""
    key = fresh(docs, "key")
    own = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"),
                         F.coalesce("text", F.lit(""))))
    path = scratch_dir(spark, "near-copies")
    fingerprints(docs.select("doc_id", own.alias(key), "text")).write.parquet(path)
    rows = spark.read.parquet(path)
    stays = rows.join(groups(spark, rows), "fp").groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("last"), "doc_id", key)).alias("least")).select(
        F.col(f"least.{key}").alias(key))
    # The limit on ranks is applied before the shuffle too, so a hot row is sent once a task.
    sortable = [f.name for f in docs.schema.fields if not isinstance(
        f.dataType, (MapType, StructType, ArrayType)) and f.name not in ("doc_id", "text")]
    place = fresh(docs, "place")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*sortable or [F.lit(0)]))
    first = docs.withColumn(key, own).withColumn(place, rank).where(F.col(place) == 1)
    return first.join(stays, key, "left_semi").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark, and not those that are mostly such."""
    return _with_length(decontaminate(spark, docs, documents(spark, sf_dir, "benchmark")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mixture takes, with rate and n_copies."""
    model = mixing.train(spark, docs, domains(documents(spark, sf_dir, "labels")), list(TARGETS))
    return mixing.resample(spark, docs, model, TARGETS)
