"""Each operator over its whole table, with the parameters it is used with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (BooleanType, DoubleType, StringType, StructField, StructType)

from ..session import scratch_dir
from . import language, licenses, mixing, toxicity, vector_codes
from .batches import documents, map_texts
from .chat import perspectives
from .decontaminate import contamination
from .jaccard import jaccard_groups
from .line_dedup import drop_boilerplate
from .simhash import simhash_groups
from .stages import TARGETS, domains, held_out
from .token_counts import count_tokens
from .vector_search import top_k
from .whitening import whiten


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark, documents(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, other = documents(spark, sf_dir), held_out(4, 2)
    model = toxicity.train(docs, documents(spark, sf_dir, "labels"), ~other)
    return docs.select("doc_id", other.alias("held_out"),
                       toxicity.toxicity(model, F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, other = documents(spark, sf_dir), held_out(3, 1)
    model = language.train(docs, ~other)
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType),
                         StructField("held_out", BooleanType()),
                         StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])
    return map_texts(docs.select("doc_id", other.alias("held_out"), "text"), schema,
                     model.predict)


def op5_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives(documents(spark, sf_dir, "conversations"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(spark, documents(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(spark, documents(spark, sf_dir), "source", n_lines="n_lines",
                            n_dropped="n_dropped").select(
        "doc_id", "source", "n_lines", "n_dropped", "text")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = mixing.train(spark, docs, domains(documents(spark, sf_dir, "labels")), list(TARGETS))
    return mixing.mix(spark, docs, model, TARGETS)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark, documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return licenses.scan(docs, licenses.train(spark, docs))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = documents(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    codes, books = vector_codes.compress(spark, vectors)
    path = f"{scratch_dir(spark, 'vector-codes')}/codes"
    codes.write.parquet(path)
    codes = spark.read.parquet(path)
    labels = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    return codes.join(labels.withColumnRenamed("label", "same"),
                      F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "code", "error", "label_error",
        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark, documents(spark, sf_dir, "embeddings"))


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(spark, documents(spark, sf_dir))


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in (
    op1_token_counts, op2_exact_top_k, op3_toxicity, op4_language_id,
    op5_chat_perspectives, op6_simhash_near_dedup, op7_line_dedup, op8_mixing,
    op9_benchmark_decontamination, op10_license_scan, op11_vector_codes,
    op12_embedding_whitening, op13_ngram_jaccard_join,
)}
