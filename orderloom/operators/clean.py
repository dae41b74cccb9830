"""Row and column cleaning of text tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import col
from ..functions.values import TYPE_ORDER, null_if_token, parse_date, type_class
from ..sources.local import local_table
from .evidence import DATE_TEXT, Evidence


def drop_all_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which every (named) column is NULL."""
    return df.where(reduce(or_, [col(c).isNotNull() for c in columns or df.columns]))


def apply_null_tokens(df: DataFrame, columns: Iterable[str],
                      keep: Iterable[str] = ()) -> DataFrame:
    """Turn missing-value tokens into NULL, except in the ``keep`` columns."""
    keep = set(keep)
    return df.withColumns({c: null_if_token(col(c)) for c in columns if c not in keep})


def select_not_null(df: DataFrame, key: str, renames: dict[str, str]) -> DataFrame:
    """Keep rows with a key, and the mapped columns under their new names."""
    return df.where(F.col(key).isNotNull()).select(
        *[F.col(old).alias(new) for old, new in renames.items()])


def type_classes(columns: Sequence[str], date_columns: Sequence[str] = ()) -> list[Column]:
    """Each text column as the class of its cells, so that every cell is tested once.

    Columns named as dates also say whether a cell reads as any form of date.
    """
    dates = [parse_date(col(c)).isNotNull().alias(f"{c}::dated") for c in date_columns]
    return [type_class(col(c)).alias(c) for c in columns] + dates


def type_counts(columns: Sequence[str], date_columns: Sequence[str] = ()) -> list[Column]:
    """Aggregates over `type_classes`: values per column, and those fitting each type."""
    out = []
    for c in columns:
        cell = col(c)
        out += [F.count(cell).alias(f"{c}::n_values"),
                F.count_if(cell == 0).alias(f"{c}::bigint"),
                F.count_if(cell <= 1).alias(f"{c}::double"),
                F.count_if(cell == 2).alias(f"{c}::boolean"),
                F.count_if(cell == 3).alias(f"{c}::timestamp_ntz")]
    return out + [F.count_if(col(f"{c}::dated")).alias(f"{c}::{DATE_TEXT}") for c in date_columns]


def date_counts(columns: Sequence[str]) -> list[Column]:
    """Aggregates over text columns: values per column, and those that read as a date."""
    return [count for c in columns for count in (
        F.count(col(c)).alias(f"{c}::n_values"),
        F.count(parse_date(col(c))).alias(f"{c}::{DATE_TEXT}"))]


def infer_types(df: DataFrame) -> DataFrame:
    """One row per text column with its counts and inferred type, from one aggregation.

    Types are decided as for a load, from counts that reach the driver as one row.
    """
    counts = df.select(*type_classes(df.columns)).agg(*type_counts(df.columns)).first()
    said = {c: Evidence.of(counts, c) for c in df.columns}
    return local_table(df.sparkSession, [
        (c, e.n_values, *[e.fits[t] for t in TYPE_ORDER], e.narrowest("string"))
        for c, e in said.items()], ", ".join([
            "column_name string", "n_values bigint", *[f"n_{t} bigint" for t in TYPE_ORDER],
            "inferred_type string"]))


def promote_dates(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Turn text columns into timestamps, each only if all its values parse.

    One aggregation decides for every candidate, as for a load; only its counts reach the driver.
    """
    if not candidates:
        return df
    counts = df.agg(*date_counts(candidates)).first()
    dates = [c for c in candidates if Evidence.of(counts, c).narrowest(DATE_TEXT) == DATE_TEXT]
    return df.withColumns({c: parse_date(col(c)) for c in dates})
