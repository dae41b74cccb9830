"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.names import batch_id, normalise_name, target_table
from ..operators import checks, clean, evolve, incremental, keys, rollups
from ..plans import ingest, intermediate, marts, operations, staging
from ..session import scratch_dir
from ..sources.raw import read_raw
from . import bindings as raw

Query = Callable[[SparkSession, str], DataFrame]

# Loads up to here are in the target; the batch reaches back before it, so it both
# replaces and adds.
TARGET_END = "2000-01-01 00:00:00"
BATCH_START = "1999-07-01 00:00:00"
AS_OF = "2024-01-31 12:00:00"


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


# --- staging ----------------------------------------------------------------

def stg_customers(spark, sf):
    return staging.stg_customers(raw.customers(spark, sf))


def stg_orders(spark, sf):
    return staging.stg_orders(raw.orders(spark, sf))


def stg_order_items(spark, sf):
    return staging.stg_order_items(raw.order_items(spark, sf))


def stg_order_payments(spark, sf):
    return staging.stg_order_payments(raw.order_payments(spark, sf))


def stg_order_reviews(spark, sf):
    return staging.stg_order_reviews(raw.order_reviews(spark, sf))


def stg_products(spark, sf):
    return staging.stg_products(raw.products(spark, sf))


def stg_sellers(spark, sf):
    return staging.stg_sellers(raw.sellers(spark, sf))


def stg_geolocation(spark, sf):
    return staging.stg_geolocation(raw.geolocation(spark, sf))


def stg_category_translation(spark, sf):
    return staging.stg_category_translation(raw.category_translation(spark, sf))


# --- intermediate and marts -------------------------------------------------

def order_items_aggregated(spark, sf):
    return intermediate.order_items_aggregated(stg_order_items(spark, sf))


def order_payments_pivoted(spark, sf):
    return intermediate.order_payments_pivoted(stg_order_payments(spark, sf))


def products_translated(spark, sf):
    return intermediate.products_translated(stg_products(spark, sf),
                                            stg_category_translation(spark, sf))


def dim_customers(spark, sf):
    return marts.dim_customers(stg_customers(spark, sf))


def dim_products(spark, sf):
    return marts.dim_products(products_translated(spark, sf))


def _fact(spark, sf, orders):
    return marts.fct_orders(orders, stg_customers(spark, sf), order_items_aggregated(spark, sf),
                            order_payments_pivoted(spark, sf))


def fct_orders(spark, sf):
    return _fact(spark, sf, stg_orders(spark, sf))


# --- incremental ------------------------------------------------------------

def _target_orders(spark, sf):
    return stg_orders(spark, sf).where(F.col("_ingested_at") < _ntz(TARGET_END))


def incremental_watermark(spark, sf):
    mark = incremental.high_water_mark(_target_orders(spark, sf), "_ingested_at")
    return incremental.newer_than(stg_orders(spark, sf), "_ingested_at", mark)


def incremental_upsert(spark, sf):
    batch = (stg_orders(spark, sf).where(F.col("_ingested_at") >= _ntz(BATCH_START))
             .withColumn("order_status", F.lit("X")))
    return incremental.upsert(_target_orders(spark, sf), batch, "order_id", marts.latest_load())


def fct_orders_incremental(spark, sf):
    return marts.fct_orders_incremental(
        _fact(spark, sf, _target_orders(spark, sf)), stg_orders(spark, sf),
        stg_customers(spark, sf), stg_order_items(spark, sf), stg_order_payments(spark, sf))


# --- ingestion --------------------------------------------------------------

def evolve_union(spark, sf):
    """The first half of the month lacks ``props``; the rest has it."""
    events = raw.table(spark, sf, "events")
    cut = _ntz("2024-01-16 00:00:00")
    return evolve.evolve_union(events.where(F.col("ts") < cut).drop("props"),
                               events.where(F.col("ts") >= cut))


def drop_all_null(spark, sf):
    events = raw.table(spark, sf, "events")
    blank = F.col("event_type") == "error"
    return clean.drop_all_null(
        events.select(*[F.when(~blank, F.col(c)).alias(c) for c in events.columns]))


def promote_dates(spark, sf):
    """``seen_at`` mixes two forms and is promoted; one bad cell keeps ``noted_at`` text."""
    full = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    short = F.date_format("ts", "MM/dd/yyyy")
    events = raw.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type").isin("view", "signup"), short).otherwise(full).alias("seen_at"),
        F.when(F.col("event_id") == 0, "unknown").otherwise(full).alias("noted_at"))
    return clean.promote_dates(events, ["seen_at", "noted_at"])


def infer_types(spark, sf):
    customer = raw.table(spark, sf, "customer")
    return clean.infer_types(
        customer.select(*[F.col(c).cast("string").alias(c) for c in customer.columns]))


def null_tokens(spark, sf):
    turns = raw.table(spark, sf, "conversations").select(
        "conv_id", F.when(F.col("role") == "system", "NA").otherwise(F.col("role")).alias("role"))
    return clean.apply_null_tokens(turns, ["role"]).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.count_if(F.col("role").isNull()).alias("n_missing"))


def _file_name():
    """An invented file name per document; some carry a date and an underscore."""
    return F.concat(F.initcap("source"),
                    F.when(F.col("lang") == "en", F.lit("_export_")).otherwise(F.lit("-")),
                    F.col("doc_id").cast("string"), F.lit(".v1.CSV"))


def target_table_name(spark, sf):
    return raw.table(spark, sf, "documents").select(
        "doc_id", target_table(_file_name()).alias("table_name"))


def normalise_names(spark, sf):
    messy = F.concat(F.lit("  "), F.upper("source"), F.lit(" Doc "),
                     F.col("doc_id").cast("string"), F.lit(" "), F.initcap("lang"), F.lit(" "))
    return raw.table(spark, sf, "documents").select("doc_id", normalise_name(messy).alias("name"))


def batch_id_hash(spark, sf):
    return raw.table(spark, sf, "documents").select(
        "doc_id", batch_id(_file_name()).alias("batch_id"))


def skip_processed(spark, sf):
    """Files with more than 12 % German rows failed before; those are due again."""
    docs = raw.documents(spark, sf)
    files = docs.select(F.col("_source_file").alias("source_file")).distinct()
    failed = F.count_if(F.col("lang") == "de") * 100 > F.count(F.lit(1)) * 12
    log = docs.groupBy(F.col("_source_file").alias("source_file")).agg(
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"))
    return operations.pending_files(files, log)


def ingestion_stats(spark, sf):
    """German rows count as blank."""
    docs = raw.documents(spark, sf)
    business = ["doc_id", "text", "lang", "n_chars"]
    german = F.col("lang") == "de"
    blanked = docs.select("_source_file", *[F.when(~german, F.col(c)).alias(c) for c in business])
    return operations.ingestion_stats(blanked, business)


def batch_history(spark, sf):
    return operations.batch_history(
        raw.documents(spark, sf),
        F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last_doc_id"))


def _src6():
    return batch_id(F.lit("src6"))


def _loaded_documents(spark, sf):
    return raw.documents(spark, sf).select("doc_id", "text", "lang", "n_chars", "_source_file",
                                           "_batch_id")


def batch_rollback(spark, sf):
    return operations.without_batch(_loaded_documents(spark, sf), _src6())


def batch_reprocess(spark, sf):
    return operations.reprocess_batch(
        _loaded_documents(spark, sf), _src6(), "doc_id",
        lambda batch: batch.withColumn("lang", F.upper("lang")), [F.asc("lang")])


def latest_by_ingest(spark, sf):
    return keys.latest_per_key(raw.table(spark, sf, "orders"), ["o_custkey"],
                               [F.desc_nulls_last("o_orderdate"), F.desc_nulls_last("o_orderkey")])


def duplicate_rows(spark, sf):
    return keys.duplicate_rows(raw.table(spark, sf, "documents").select("text"))


def ingest_csv_roundtrip(spark, sf):
    """Write a table as CSV drops, ingest them, and read the raw table back, typed."""
    customer = raw.table(spark, sf, "customer")
    base = scratch_dir(spark, "round-trip")
    customer.write.option("header", True).option("escape", '"').csv(f"{base}/landing")
    ingest.ingest(spark, f"{base}/landing", f"{base}/warehouse", datetime(2024, 1, 1),
                  ingest.IngestOptions(tables={"part-": "customer"}))
    return read_raw(spark, f"{base}/warehouse", "customer").select(*customer.columns)


# --- quality ----------------------------------------------------------------

def _only_building(column):
    """The column, NULL for most customers, so that the checks have something to find."""
    return F.when(F.col("city") == "BUILDING", F.col(column)).alias(column)


def _building_customers(spark, sf):
    return stg_customers(spark, sf).select(_only_building("customer_id"))


def dq_unique(spark, sf):
    return checks.unique(raw.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _orders_with_building_names(spark, sf):
    names = stg_customers(spark, sf).select("customer_id", _only_building("customer_unique_id"))
    return stg_orders(spark, sf).join(names, "customer_id", "left")


def dq_not_null(spark, sf):
    return checks.not_null(_orders_with_building_names(spark, sf),
                           ["order_id", "customer_id", "customer_unique_id"])


def dq_relationships(spark, sf):
    orders = stg_orders(spark, sf)

    def against(name, parent):
        return checks.relationships(orders, "customer_id", parent, "customer_id").withColumn(
            "parent", F.lit(name))

    return against("building", _building_customers(spark, sf)).unionByName(
        against("all", stg_customers(spark, sf)))


def dq_freshness(spark, sf):
    return checks.freshness(raw.table(spark, sf, "events"), "ts", _ntz(AS_OF), ["user_id"])


def dq_summary(spark, sf):
    orders = stg_orders(spark, sf)
    nulls = checks.not_null(_orders_with_building_names(spark, sf), ["customer_unique_id"])
    missing = checks.relationships(orders, "customer_id", _building_customers(spark, sf),
                                   "customer_id")
    return checks.summary([
        checks.result("unique_lineitem", dq_unique(spark, sf)),
        checks.result("unique_orders", checks.unique(orders, ["order_id"])),
        checks.result("not_null_customer_name", nulls, F.sum("failing_rows")),
        checks.result("relationships_customer", missing, F.sum("n_records")),
        checks.result("freshness_events",
                      dq_freshness(spark, sf).where(F.col("status") == "error")),
    ])


ALL: dict[str, Query] = {q.__name__: q for q in (
    stg_customers, stg_orders, stg_order_items, stg_order_payments, stg_order_reviews,
    stg_products, stg_sellers, stg_geolocation, stg_category_translation,
    order_items_aggregated, order_payments_pivoted, products_translated,
    dim_customers, dim_products, fct_orders,
    incremental_watermark, incremental_upsert, fct_orders_incremental,
    evolve_union, drop_all_null, promote_dates, infer_types, null_tokens,
    target_table_name, normalise_names, batch_id_hash,
    skip_processed, ingestion_stats, batch_history, batch_rollback, batch_reprocess,
    latest_by_ingest, duplicate_rows, ingest_csv_roundtrip,
    dq_unique, dq_not_null, dq_relationships, dq_freshness, dq_summary,
)}
