"""Operators that work per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK, _ROW = "__rank", "__row"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    The filter on the rank lets Spark keep one row per key in every map task
    before the shuffle, so a hot key sends one row per task, not all its rows.
    State the null order and end with a unique column: ties are otherwise open.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_known_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order, and every row without a key.

    As `latest_per_key`; rows without a key are told apart by reading task and place in it, which
    a repeated scan repeats, and so are spread too.
    """
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return latest_per_key(df.withColumn(_ROW, alone), [key, _ROW], order).drop(_ROW)


def row_digest(df: DataFrame) -> Column:
    """One 256-bit digest per row; equal rows, and only those, share it."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns]),
                            {"ignoreNullFields": "false"}), 256)


def duplicate_rows(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct rows and surplus copies, in total or per group of ``by``.

    Copies collapse on a digest before the shuffle: whole texts never travel,
    and a group of many copies arrives as one row per map task.
    """
    body = df.select(*[c for c in df.columns if c not in by])
    per_row = (df.select(*by, row_digest(body).alias("__digest"))
               .groupBy(*by, "__digest").agg(F.count(F.lit(1)).alias("__copies")))
    return per_row.groupBy(*by).agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"),
    )
