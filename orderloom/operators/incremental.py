"""Watermarked reads and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from .keys import latest_per_known_key


def high_water_mark(df: DataFrame, column: str) -> datetime | None:
    """Largest value of a column, one cell on the driver; None for an empty table."""
    return df.agg(F.max(column)).first()[0]


def newer_than(df: DataFrame, column: str, mark: datetime | None) -> DataFrame:
    """Rows past the mark, as a literal the Parquet scan can prune by; all without a mark."""
    if mark is None:
        return df
    literal = F.lit(mark.isoformat(sep=" ")).cast(df.schema[column].dataType)
    return df.where(F.col(column) > literal)


def upsert(target: DataFrame, batch: DataFrame, key: str, order: Sequence[Column] = (),
           keys: DataFrame | None = None) -> DataFrame:
    """Target without the batch's keys, plus the batch's latest row per key.

    Rows without a key replace none and are all kept, in the target and in the batch. Without an
    order, the batch's keys do not repeat. ``keys`` may name them, or more of them, where that
    is cheaper to read than the batch.
    """
    known = batch if keys is None else keys
    newest = latest_per_known_key(batch, key, order) if order else batch
    return (target.join(known.select(key).distinct(), key, "left_anti").select(*target.columns)
            .unionByName(newest, allowMissingColumns=True))
