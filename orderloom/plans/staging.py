"""Staging: one function per source, from raw to renamed rows with a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import SOURCES, STAGED_LINEAGE
from ..operators.clean import select_not_null
from ..operators.keys import latest_per_key


def stage(name: str, raw: DataFrame) -> DataFrame:
    source = SOURCES[name]
    return select_not_null(raw, source.key, {**source.columns, **STAGED_LINEAGE})


def stg_customers(raw: DataFrame) -> DataFrame:
    return stage("customers", raw)


def stg_orders(raw: DataFrame) -> DataFrame:
    return stage("orders", raw)


def stg_order_items(raw: DataFrame) -> DataFrame:
    return stage("order_items", raw)


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return stage("order_payments", raw)


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    """Latest answer per review. An unanswered copy wins, as NULL sorts first.

    The remaining columns follow in the order, so copies that still tie are equal.
    """
    staged = stage("order_reviews", raw)
    order = [F.desc_nulls_first("answered_at"), F.asc_nulls_last("order_id"),
             F.desc_nulls_last("_ingested_at"), F.asc_nulls_last("_source_file")]
    named = {"review_id", "answered_at", "order_id", "_ingested_at", "_source_file"}
    rest = [F.asc_nulls_last(c) for c in staged.columns if c not in named]
    return latest_per_key(staged, ["review_id"], order + rest)


def stg_products(raw: DataFrame) -> DataFrame:
    return stage("products", raw)


def stg_sellers(raw: DataFrame) -> DataFrame:
    return stage("sellers", raw)


def stg_geolocation(raw: DataFrame) -> DataFrame:
    return stage("geolocation", raw)


def stg_category_translation(raw: DataFrame) -> DataFrame:
    return stage("category_translation", raw)
