"""Intermediate models: per-order rollups and translated products."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import PAYMENT_COLUMNS
from ..operators.rollups import pivot_sum, sum_amounts


def order_items_aggregated(items: DataFrame) -> DataFrame:
    lines = items.select("order_id", "order_item_id", "price", "freight", "shipping_limit_at")
    return sum_amounts(
        lines, "order_id", {"price": "total_price", "freight": "total_freight"},
        F.count("order_item_id").alias("total_items"),
        F.min("shipping_limit_at").alias("earliest_shipping_limit"),
        F.max("shipping_limit_at").alias("latest_shipping_limit"),
    ).select("order_id", "total_items", "total_price", "total_freight",
             "earliest_shipping_limit", "latest_shipping_limit")


def order_payments_pivoted(payments: DataFrame) -> DataFrame:
    return pivot_sum(payments, "order_id", "payment_type", "payment_value",
                     PAYMENT_COLUMNS, "total_payment_value")


def products_translated(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category where there is one.

    The translation is broadcast only where Spark measures it below its limit;
    past that, a sort-merge join whose skewed categories AQE splits.
    """
    english = translation.select("category_name", "category_name_english")
    return products.join(english, "category_name", "left").select(
        "product_id",
        F.coalesce("category_name_english", "category_name").alias("category_name"),
        "name_length", "description_length", "photos_qty",
        "weight_g", "length_cm", "height_cm", "width_cm",
    )
