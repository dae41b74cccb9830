"""Marts: two dimensions and the order fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..config import PAYMENT_COLUMNS
from ..operators.incremental import high_water_mark, newer_than, upsert
from ..operators.joins import hot_values, lookup, lookup_known
from ..operators.keys import latest_per_known_key
from .intermediate import order_items_aggregated, order_payments_pivoted

ORDER_COLUMNS = ["order_id", "customer_id", "customer_unique_id", "order_status",
                 "purchased_at", "approved_at", "delivered_carrier_at",
                 "delivered_customer_at", "estimated_delivery_at"]
# Measure in the fact -> column of the rollup it comes from.
MEASURES = {
    "total_items": "total_items",
    "total_item_price": "total_price",
    "total_freight": "total_freight",
    **{name: name for name in PAYMENT_COLUMNS.values()},
    "total_payment_value": "total_payment_value",
}

# Columns an order's copies are ranked by, newest first; used as `latest_load()`.
_RECENCY = ("_ingested_at", "purchased_at", "approved_at", "delivered_carrier_at",
            "delivered_customer_at", "estimated_delivery_at", "order_status", "customer_id")


def latest_load() -> list[Column]:
    return [F.desc_nulls_last(c) for c in _RECENCY]


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_unique_id", "zip_code", "city", "state")


def dim_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "category_name", "weight_g",
                           "length_cm", "height_cm", "width_cm")


def fct_orders(orders: DataFrame, customers: DataFrame, items: DataFrame,
               payments: DataFrame) -> DataFrame:
    """One row per order, its latest, with its customer and its item and payment sums.

    Every order without an id is kept, with sums of 0. Of a repeated order the tasks send one row
    each, and orders without an id are dealt out, so none is hot. The join with the customers is the
    last, so that Spark can split the orders of a hot one as it runs.
    """
    latest = latest_per_known_key(orders, "order_id", latest_load()).drop("_source_file")
    measured = lookup_known(latest, [items.drop("earliest_shipping_limit", "latest_shipping_limit"),
                               payments], "order_id")
    measured = lookup(measured, [customers.select("customer_id", "customer_unique_id")],
                      "customer_id")
    zeroed = [F.coalesce(F.col(source), F.lit(0).cast(measured.schema[source].dataType))
              .alias(name) for name, source in MEASURES.items()]
    return measured.select(*ORDER_COLUMNS, *zeroed, "_ingested_at")


def fct_orders_for(orders: DataFrame, customers: DataFrame, item_lines: DataFrame,
                   payment_lines: DataFrame) -> DataFrame:
    """Fact rows for some orders, from all their item and payment lines."""
    wanted = orders.select("order_id").distinct()
    items, payments = (lines.join(wanted, "order_id", "left_semi").select(*lines.columns)
                       for lines in (item_lines, payment_lines))
    return fct_orders(orders, customers, order_items_aggregated(items),
                      order_payments_pivoted(payments))


def new_orders(target: DataFrame, orders: DataFrame) -> DataFrame:
    """Staged orders loaded after the newest one in the target."""
    return newer_than(orders, "_ingested_at", high_water_mark(target, "_ingested_at"))


def fct_orders_incremental(target: DataFrame, orders: DataFrame, customers: DataFrame,
                           item_lines: DataFrame, payment_lines: DataFrame) -> DataFrame:
    """The whole fact after an incremental run."""
    new = new_orders(target, orders)
    batch = fct_orders_for(new, customers, item_lines, payment_lines)
    # The batch has a row for each of the new orders, and one only.
    return upsert(target, batch, "order_id", keys=new)


def late_orders(mark: datetime | None, orders: DataFrame, customers: DataFrame,
                raw_items: DataFrame, raw_payments: DataFrame) -> DataFrame:
    """Staged orders that any input loaded after the mark touches. Of the other inputs only what
    was loaded since is needed.

    Covers what the order watermark alone misses: items, payments or customers
    that arrive after their order.
    """
    arrived = (newer_than(customers, "_ingested_at", mark).select("customer_id").distinct()
               .withColumn("arrived", F.lit(True)))
    hot = hot_values(orders, ["customer_id"])["customer_id"]
    of_arrived = lookup(orders.select("order_id", "customer_id"), [arrived], "customer_id",
                        hot).where("arrived")
    touched = (newer_than(orders, "_ingested_at", mark).select("order_id")
               .unionByName(newer_than(raw_items, "_ingested_at", mark).select("order_id"))
               .unionByName(newer_than(raw_payments, "_ingested_at", mark).select("order_id"))
               .unionByName(of_arrived.select("order_id")))
    return orders.join(touched.distinct(), "order_id", "left_semi").select(*orders.columns)
