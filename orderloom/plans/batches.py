"""Taking a loaded batch back, and building again what it touched."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.audit import Audit
from ..sources.raw import MissingTable, clear_files
from ..sources.tables import month_of
from . import marts, staging
from .daily import Models


def history(spark: SparkSession, root: str) -> DataFrame:
    """Every load of every batch and file, with what it brought and how it ended."""
    return Audit(spark, root).read("ingestion_log").groupBy(
        "batch_id", "source_file", "table_name").agg(
        F.count(F.lit(1)).alias("loads"), F.count_if(F.col("status") == "FAILED").alias("failures"),
        F.sum("rows_loaded").alias("rows_loaded"), F.min("ingested_at").alias("first_load"),
        F.max("ingested_at").alias("last_load"))


def roll_back(spark: SparkSession, root: str, table: str, batch: str, at: datetime,
              reload: bool = False, files: Sequence[str] = ()) -> list[str]:
    """Remove a batch's rows from a raw table; returns its files.

    The log names the files, and says that they are taken back before that is done: a run that
    dies in between is repeated. Ids are short, so several files may share one; then ``files``
    says which are meant. With ``reload`` the next run loads the files again if they are still there; a full refresh
    takes the rows out of the models.
    """
    audit = Audit(spark, root)
    columns = audit.table_columns(table)
    if columns is None:
        raise MissingTable(f"no raw table {table!r}")
    logged = audit.read("ingestion_log").where(
        (F.col("table_name") == table) & (F.col("batch_id") == batch)
        & (F.col("status") == "SUCCESS")).select("source_file").distinct().collect()
    found = sorted(r["source_file"] for r in logged if not files or r["source_file"] in files)
    if len(found) > 1 and not files:
        raise ValueError(f"batch {batch} is of several files, name those meant: {found}")
    if not found:
        return []
    status = "REOPENED" if reload else "ROLLED_BACK"
    audit.append("ingestion_log", [
        (table, batch, None, f, None, 0, 0, 0, None, None, status, "", at) for f in found])
    clear_files(spark, root, table, columns, found)
    return found


def reprocess(models: Models, batch: str) -> None:
    """Stage the orders a batch touches, built again from all raw rows, and the dimensions.

    A batch of customers touches their orders; one of a source the fact does not use, none.
    """
    orders = models.raw("orders")
    customers = models.raw("customers").where(F.col("_batch_id") == batch).select("customer_id")
    keys = (orders.where(F.col("_batch_id") == batch).select("order_id")
            .unionByName(models.raw("order_items").where(F.col("_batch_id") == batch)
                         .select("order_id"))
            .unionByName(models.raw("order_payments").where(F.col("_batch_id") == batch)
                         .select("order_id"))
            .unionByName(orders.join(customers, "customer_id", "left_semi").select("order_id"))
            .distinct())
    again = staging.stg_orders(orders.join(keys, "order_id", "left_semi"))
    by_month = month_of("purchased_at")
    models.tables.merge("stg_orders", again, "order_id", marts.latest_load(), by_month)
    staged = models.tables.read("stg_orders", staged=True).join(keys, "order_id", "left_semi")
    fact = marts.fct_orders_for(staged, models("stg_customers"), models("stg_order_items"),
                                models("stg_order_payments"))
    models.tables.merge("fct_orders", fact, "order_id", marts.latest_load(), by_month)
    models.tables.build("dim_customers", marts.dim_customers(models("stg_customers")))
    models.tables.build("dim_products", marts.dim_products(models("int_products_translated")))
