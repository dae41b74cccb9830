"""One key with a third of the rows: same results, and no task gets the whole key."""

import pytest
from pyspark.sql import functions as F

from orderloom.operators import checks
from orderloom.operators.incremental import upsert
from orderloom.operators.joins import SALTS, hot_values, lookup, lookup_known
from orderloom.operators.keys import duplicate_rows, latest_per_key
from orderloom.plans import marts
from orderloom.session import settings

ROWS = 30_000


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _skewed(spark):
    """A third under key 7, a third under NULL, the rest spread."""
    key = (F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None))
           .otherwise(F.col("id") + 100)).cast("bigint")
    return spark.range(0, ROWS, 1, 16).select(key.alias("k"), F.col("id").alias("row"))


def _bag(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_values(spark):
    df = _skewed(spark)
    assert set(hot_values(df, ["k"])["k"]) == {7, None}
    assert hot_values(df, ["row"])["row"] == []
    assert hot_values(df.limit(0), ["k"])["k"] == []


@pytest.mark.parametrize("hot", [[], [7], [None], [7, None], [7, None, 999_999]])
def test_lookup_keeps_every_row(spark, no_broadcast, hot):
    left = _skewed(spark)
    names = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    twice = names.unionByName(names).select("k", F.col("v").alias("w"))
    want = _bag(left.join(names, "k", "left").join(twice, "k", "left"))
    assert _bag(lookup(left, [names, twice], "k", hot)) == want


def test_a_hot_key_is_spread_over_tasks(spark, no_broadcast):
    left = _skewed(spark)
    names = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))

    def largest(df):
        return (df.where("k = 7 or k is null").groupBy(F.spark_partition_id().alias("task"))
                .count().agg(F.max("count")).first()[0])

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(SALTS))
    try:
        assert largest(left.join(names, "k", "left")) >= ROWS // 3
        assert largest(lookup(left, [names], "k", [7, None])) < ROWS // 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def _fact_inputs(spark):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    orders = spark.range(0, 6000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).cast("bigint").alias("order_id"),
        F.when(F.col("id") % 3 == 1, 9).otherwise(F.col("id") % 500).cast("bigint")
        .alias("customer_id"),
        *[F.lit("x").alias("order_status")],
        *[at.alias(c) for c in ("purchased_at", "approved_at", "delivered_carrier_at",
                                "delivered_customer_at", "estimated_delivery_at",
                                "_ingested_at")],
        F.col("id").cast("string").alias("_source_file"))
    customers = spark.range(0, 400).select(F.col("id").alias("customer_id"),
                                           F.concat(F.lit("u"), "id").alias("customer_unique_id"))
    items = spark.range(0, 3000).select(
        F.col("id").alias("order_id"), F.lit(2).cast("bigint").alias("total_items"),
        (F.col("id") / 4).alias("total_price"), F.lit(1.0).alias("total_freight"),
        at.alias("earliest_shipping_limit"), at.alias("latest_shipping_limit"))
    names = ("credit_card_amount", "boleto_amount", "voucher_amount", "debit_card_amount",
             "total_payment_value")
    payments = spark.range(1000, 4000).select(
        F.col("id").alias("order_id"), *[(F.col("id") / 2).alias(n) for n in names])
    return orders, customers, items, payments


def test_fact_with_hot_orders_and_customers(spark, no_broadcast, monkeypatch):
    inputs = _fact_inputs(spark)
    found = hot_values(inputs[0], ["customer_id", "order_id"])
    assert found == {"customer_id": [9], "order_id": [5]}
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup())
    fact = marts.fct_orders(*inputs)
    assert len(jobs.getJobIdsForGroup()) == before, "the plan is made without running anything"
    assert fact.count() == inputs[0].select("order_id").distinct().count()
    shape = plan(fact)
    assert shape.count("Exchange ") <= 6 and shape.count("Range (") == 4


def test_orders_of_a_hot_customer_are_split_as_the_fact_runs(spark, no_broadcast):
    orders, *others = _fact_inputs(spark)
    hot = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
           "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with settings(spark, hot):
        fact = marts.fct_orders(orders.withColumn("order_id", F.col("_source_file").cast("long")),
                                *others)
        rows = fact.collect()
        assert "skew=true" in plan(fact)
    assert len(rows) == 6000
    assert sum(r["customer_unique_id"] == "u9" for r in rows) > 2000


def test_fact_keeps_every_order_without_an_id(spark, no_broadcast):
    orders, *others = _fact_inputs(spark)
    lacking = orders.withColumn("order_id", F.when(F.col("_source_file").cast("long") % 3 != 0,
                                                   F.col("order_id")))
    twice = lacking.unionByName(lacking.where("order_id is null"))
    for ids in ("bigint", "string", "int"):
        fact = marts.fct_orders(twice.withColumn("order_id", F.col("order_id").cast(ids)),
                                others[0], *[o.withColumn("order_id", F.col("order_id").cast(ids))
                                             for o in others[1:]])
        got = fact.agg(F.count_if(F.col("order_id").isNull()),
                       F.count_distinct("order_id"), F.count("order_id")).first()
        assert tuple(got) == (4000, 4000, 4000)
        assert fact.where("order_id is null and total_payment_value > 0").count() == 0
        want = (lacking.where("order_id is not null").join(others[2], "order_id")
                .agg(F.sum("total_payment_value")).first()[0])
        assert fact.agg(F.sum("total_payment_value")).first()[0] == want


def test_orders_without_an_id_are_spread(spark, no_broadcast):
    left = _skewed(spark)
    names = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = lookup_known(left, [names], "k")
        parts = joined.where("k is null").groupBy(F.spark_partition_id()).count().collect()
        assert _bag(joined) == _bag(left.join(names, "k", "left"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert max(r["count"] for r in parts) < ROWS // 6


def test_upsert_keeps_every_row_without_a_key(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), (None, 2), (3, 4), (3, 5)], "k long, v long")
    old = spark.createDataFrame([(None, 9), (3, 9), (4, 9)], "k long, v long")
    assert _bag(upsert(old, rows, "k", [F.desc("v")])) == _bag(spark.createDataFrame(
        [(None, 1), (None, 2), (None, 2), (None, 9), (3, 5), (4, 9)], "k long, v long"))


def test_upsert_with_keys_of_its_own_source(spark):
    old = spark.createDataFrame([(None, 9), (3, 9), (4, 9)], "k long, v long")
    batch = spark.createDataFrame([(None, 1), (3, 4)], "k long, v long")
    keys = spark.createDataFrame([(None,), (3,), (3,)], "k long")
    assert _bag(upsert(old, batch, "k", keys=keys)) == _bag(upsert(old, batch, "k", [F.desc("v")]))


def test_latest_per_key_keeps_one_row_per_key_before_the_shuffle(spark):
    df = _skewed(spark).where("k is not null")
    latest = latest_per_key(df, ["k"], [F.desc("row")])
    assert plan(latest).count("WindowGroupLimit") >= 2
    got = {r["k"]: r["row"] for r in latest.collect()}
    assert got[7] == ROWS - 3 and len(got) == ROWS // 3 + 1


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.range(0, 9000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("same " * 50)).otherwise(F.col("id").cast("string"))
        .alias("text"), F.lit(None).cast("string").alias("other"))
    row = duplicate_rows(df).first()
    assert (row["n_rows"], row["n_distinct"], row["n_duplicates"]) == (9000, 6001, 2999)
    empty = duplicate_rows(df.limit(0)).first()
    assert tuple(empty) == (0, 0, 0)


def test_digest_tells_null_from_text_and_columns_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("null", "a"), ("a", "null")],
                               "x string, y string")
    assert duplicate_rows(df).first()["n_duplicates"] == 0


def test_relationship_check_counts_hot_orphans(spark):
    child = _skewed(spark)
    parent = spark.range(100, 200_000).select(F.col("id").alias("p"))
    rows = checks.relationships(child, "k", parent, "p").collect()
    assert [(r["k"], r["n_records"]) for r in rows] == [(7, ROWS // 3)]
