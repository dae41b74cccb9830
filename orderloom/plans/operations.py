"""What operators of the raw layer do with batches and the audit log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.incremental import upsert


def pending_files(files: DataFrame, log: DataFrame) -> DataFrame:
    """Files without a SUCCESS row; failed ones come up again."""
    done = log.where(F.col("status") == "SUCCESS").select("source_file").distinct()
    return files.join(done, "source_file", "left_anti")


def ingestion_stats(rows: DataFrame, business: Sequence[str]) -> DataFrame:
    """Rows read, loaded and rejected (all business columns NULL) per file."""
    blank = reduce(and_, [F.col(c).isNull() for c in business])
    return rows.groupBy(F.col("_source_file").alias("source_file")).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~blank).alias("rows_loaded"),
        F.count_if(blank).alias("rows_rejected"))


def batch_history(rows: DataFrame, *extra: Column) -> DataFrame:
    """What each batch and file brought in."""
    return rows.groupBy(F.col("_batch_id").alias("batch_id"),
                        F.col("_source_file").alias("source_file")).agg(
        F.count(F.lit(1)).alias("n_rows"), *extra)


def without_batch(rows: DataFrame, batch: Column) -> DataFrame:
    """The table as it was before a batch. Rows of no known batch stay."""
    return rows.where(~F.col("_batch_id").eqNullSafe(batch))


def reprocess_batch(rows: DataFrame, batch: Column, key: str,
                    rebuild: Callable[[DataFrame], DataFrame],
                    order: Sequence[Column]) -> DataFrame:
    """Rebuild one batch's rows and put them back by key."""
    return upsert(rows, rebuild(rows.where(F.col("_batch_id") == batch)), key, order)
