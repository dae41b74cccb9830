"""The test tables under the raw names the models read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

LOADED = "2024-01-01 00:00:00"


# Schemas of tables already opened, as a catalog would keep them.
_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _raw(df: DataFrame, name: str, columns: dict[str, Column],
         loaded: Column | None = None) -> DataFrame:
    loaded = F.lit(LOADED).cast("timestamp_ntz") if loaded is None else loaded
    file = F.lit(f"{name}.parquet")
    return df.select(*[c.alias(n) for n, c in columns.items()],
                     loaded.alias("_ingested_at"), file.alias("_source_file"),
                     F.substring(F.md5(file.cast("binary")), 1, 8).alias("_batch_id"))


def _no(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(table(spark, sf_dir, "customer"), "customer", {
        "customer_id": F.col("c_custkey"),
        "customer_unique_id": F.col("c_name"),
        "customer_zip_code_prefix": F.col("c_nationkey"),
        "customer_city": F.col("c_mktsegment"),
        "customer_state": F.col("c_mktsegment"),
    })


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(table(spark, sf_dir, "orders"), "orders", {
        "order_id": F.col("o_orderkey"),
        "customer_id": F.col("o_custkey"),
        "order_status": F.col("o_orderstatus"),
        "order_purchase_timestamp": F.col("o_orderdate"),
        "order_approved_at": _no("timestamp_ntz"),
        "order_delivered_carrier_date": _no("timestamp_ntz"),
        "order_delivered_customer_date": _no("timestamp_ntz"),
        "order_estimated_delivery_date": _no("timestamp_ntz"),
    }, loaded=F.col("o_orderdate"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(table(spark, sf_dir, "lineitem"), "lineitem", {
        "order_id": F.col("l_orderkey"),
        "order_item_id": F.col("l_linenumber"),
        "product_id": F.col("l_partkey"),
        "seller_id": F.col("l_suppkey"),
        "shipping_limit_date": F.col("l_shipdate"),
        "price": F.col("l_extendedprice"),
        "freight_value": F.col("l_tax") + F.lit(0.0),
    })


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (F.when(F.col("l_returnflag") == "A", "credit_card")
            .when(F.col("l_returnflag") == "N", "boleto").otherwise("other"))
    return _raw(table(spark, sf_dir, "lineitem"), "lineitem", {
        "order_id": F.col("l_orderkey"),
        "payment_sequential": F.col("l_linenumber"),
        "payment_type": kind,
        "payment_installments": F.col("l_quantity").cast("bigint"),
        "payment_value": F.col("l_extendedprice"),
    })


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(table(spark, sf_dir, "events"), "events", {
        "review_id": F.col("user_id"),
        "order_id": F.col("event_id"),
        "review_score": F.col("value"),
        "review_comment_title": F.col("event_type"),
        "review_comment_message": F.col("props"),
        "review_creation_date": F.col("ts"),
        "review_answer_timestamp": F.col("ts"),
    })


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(table(spark, sf_dir, "part"), "part", {
        "product_id": F.col("p_partkey"),
        "product_category_name": F.col("p_brand"),
        "product_name_lenght": F.length("p_name").cast("bigint"),
        "product_description_lenght": F.length("p_type").cast("bigint"),
        "product_photos_qty": _no("bigint"),
        "product_weight_g": F.col("p_size"),
        "product_length_cm": F.col("p_retailprice"),
        "product_height_cm": _no("double"),
        "product_width_cm": _no("double"),
    })


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One English name per brand but ``Brand#1``, which keeps its own."""
    brands = (table(spark, sf_dir, "part").where(F.col("p_brand") != "Brand#1")
              .select("p_brand").distinct())
    return _raw(brands, "part", {
        "product_category_name": F.col("p_brand"),
        "product_category_name_english": F.upper("p_brand"),
    })


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(table(spark, sf_dir, "supplier"), "supplier", {
        "seller_id": F.col("s_suppkey"),
        "seller_zip_code_prefix": F.col("s_nationkey"),
        "seller_city": F.col("s_name"),
        "seller_state": _no("string"),
    })


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(table(spark, sf_dir, "nation"), "nation", {
        "geolocation_zip_code_prefix": F.col("n_nationkey"),
        "geolocation_lat": _no("double"),
        "geolocation_lng": _no("double"),
        "geolocation_city": F.col("n_name"),
        "geolocation_state": _no("string"),
    })


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a raw table: the source is the file a row came from."""
    docs = table(spark, sf_dir, "documents")
    return docs.withColumnsRenamed({"source": "_source_file"}).withColumn(
        "_batch_id", F.substring(F.md5(F.col("_source_file").cast("binary")), 1, 8))
