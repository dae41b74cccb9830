"""Operators on rows written out by hand."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderloom.operators import checks, clean, evolve, incremental, keys
from orderloom.plans import intermediate, operations


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_watermark_of_an_empty_target_takes_all(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))],
                               "id int, at timestamp_ntz")
    none = incremental.high_water_mark(df.limit(0), "at")
    assert none is None and incremental.newer_than(df, "at", none).count() == 2
    mark = incremental.high_water_mark(df.where("id = 1"), "at")
    newer = incremental.newer_than(df, "at", mark)
    assert [r["id"] for r in newer.collect()] == [2]


def test_upsert_replaces_adds_and_takes_a_batchs_latest(spark):
    target = spark.createDataFrame([(1, "old", 1), (2, "old", 1), (None, "kept", 1)],
                                   "k int, v string, at int")
    batch = spark.createDataFrame([(2, "new", 2), (2, "newer", 3), (3, "added", 2)],
                                  "k int, v string, at int")
    merged = incremental.upsert(target, batch, "k", [F.desc("at")])
    assert _rows(merged) == sorted([(1, "old", 1), (2, "newer", 3), (3, "added", 2),
                                    (None, "kept", 1)], key=repr)


def test_latest_per_key_orders_nulls_as_told(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, None, "b"), (2, 1, "c"), (2, 1, "d")],
                               "k int, at int, id string")
    first = keys.latest_per_key(df, ["k"], [F.desc_nulls_first("at"), F.asc("id")])
    last = keys.latest_per_key(df, ["k"], [F.desc_nulls_last("at"), F.desc("id")])
    assert _rows(first) == [(1, None, "b"), (2, 1, "c")]
    assert _rows(last) == [(1, 5, "a"), (2, 1, "d")]


def test_payments_count_unknown_and_missing_kinds_in_the_total_only(spark):
    df = spark.createDataFrame(
        [("a", "credit_card", 1.1), ("a", "barter", 2.2), ("a", None, 3.3),
         ("b", "voucher", None), ("c", "boleto", 0.1), ("c", "boleto", 0.2)],
        "order_id string, payment_type string, payment_value double")
    got = {r["order_id"]: tuple(r)[1:] for r in
           intermediate.order_payments_pivoted(df).collect()}
    assert got == {"a": (1.1, 0.0, 0.0, 0.0, 6.6), "b": (0.0, 0.0, None, 0.0, None),
                   "c": (0.0, 0.3, 0.0, 0.0, 0.3)}


def test_items_count_only_numbered_ones(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 0.5), ("a", None, 2.0, None)],
                               "order_id string, order_item_id int, price double, freight double")
    df = df.withColumn("shipping_limit_at", F.lit(None).cast("timestamp_ntz"))
    row = intermediate.order_items_aggregated(df).first()
    assert tuple(row) == ("a", 1, 3.0, 0.5, None, None)


def test_translation_falls_back_to_the_original(spark):
    columns = ("product_id", "name_length", "description_length", "photos_qty", "weight_g",
               "length_cm", "height_cm", "width_cm")
    products = spark.createDataFrame([("p1", "x"), ("p2", "y"), ("p3", None)],
                                     "product_id string, category_name string")
    products = products.withColumns({c: F.lit(1) for c in columns[1:]})
    names = spark.createDataFrame([("x", "ex"), ("y", None)],
                                  "category_name string, category_name_english string")
    got = intermediate.products_translated(products, names).select("product_id", "category_name")
    assert _rows(got) == [("p1", "ex"), ("p2", "y"), ("p3", None)]


def test_checks_fail_on_bad_rows_and_pass_on_good(spark):
    good = spark.createDataFrame([(1, 1), (2, 1)], "id int, parent int")
    bad = spark.createDataFrame([(1, 1), (1, 7), (None, 7), (None, None)], "id int, parent int")
    parent = good.select(F.col("parent").alias("p"))
    assert _rows(checks.unique(good, ["id"])) == []
    assert _rows(checks.unique(bad, ["id"])) == [(1, 2)]
    assert _rows(checks.not_null(good, ["id", "parent"])) == [("id", 0), ("parent", 0)]
    assert _rows(checks.not_null(bad, ["id", "parent"])) == [("id", 2), ("parent", 1)]
    assert _rows(checks.relationships(good, "parent", parent, "p")) == []
    assert _rows(checks.relationships(bad, "parent", parent, "p")) == [(7, 2)]
    result = checks.result("r", checks.relationships(bad, "parent", parent, "p"),
                           F.sum("n_records"))
    assert _rows(result) == [("r", 2, "fail")]
    assert _rows(checks.result("r", checks.unique(good, ["id"]))) == [("r", 0, "pass")]


@pytest.mark.parametrize("hour,status", [("12", "pass"), ("13", "warn")])
def test_freshness_limits(spark, hour, status):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 12),)], "at timestamp_ntz")
    now = F.lit(f"2024-01-02 {hour}:00:00").cast("timestamp_ntz")
    assert checks.freshness(df, "at", now).first()["status"] == status
    assert checks.freshness(df.limit(0), "at", now).first()["status"] == "error"


def test_drift_keeps_file_order_and_ignores_lineage():
    old = {"a": "bigint", "b": "string", "_batch_id": "string"}
    drift = evolve.detect_drift(old, {"z": "string", "a": "double", "y": "string"})
    assert drift == evolve.Drift(["z", "y"], ["b"], [("a", "bigint", "double")])
    assert evolve.detect_drift({}, {"a": "string"}) == evolve.Drift()


def test_schema_hash_follows_order_and_types():
    base = evolve.schema_hash({"a": "bigint", "b": "string"})
    assert len(base) == 8 and base == evolve.schema_hash({"a": "bigint", "b": "string"})
    assert base != evolve.schema_hash({"b": "string", "a": "bigint"})
    assert base != evolve.schema_hash({"a": "double", "b": "string"})


def test_evolve_union_fills_both_sides(spark):
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([(True, 2)], "c boolean, a int")
    assert _rows(evolve.evolve_union(left, right)) == [(1, "x", None), (2, None, True)]


def test_types_are_the_narrowest_that_fit(spark):
    df = spark.createDataFrame(
        [("1", "1", "true", "2024-01-01", "1", None), ("02", "1e3", "FALSE",
                                                       "2024-01-01 10:00:00", "x", None)],
        "i string, d string, b string, t string, s string, e string")
    assert {r["column_name"]: r["inferred_type"] for r in clean.infer_types(df).collect()} == {
        "i": "bigint", "d": "double", "b": "boolean", "t": "timestamp_ntz", "s": "string",
        "e": "string"}


def test_too_large_integers_stay_text(spark):
    df = spark.createDataFrame([("99999999999999999999",), ("1.5",)], "n string")
    assert clean.infer_types(df).first()["inferred_type"] == "string"


def test_pending_files(spark):
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "source_file string")
    log = spark.createDataFrame([("a", "SUCCESS"), ("b", "FAILED"), ("a", "FAILED")],
                                "source_file string, status string")
    assert _rows(operations.pending_files(files, log)) == [("b",), ("c",)]


def test_batches(spark):
    df = spark.createDataFrame([(1, "b1", "x"), (2, "b2", "y"), (3, None, "z")],
                               "id int, _batch_id string, v string")
    assert _rows(operations.without_batch(df, F.lit("b1")).select("id")) == [(2,), (3,)]
    redone = operations.reprocess_batch(df, F.lit("b2"), "id",
                                        lambda b: b.withColumn("v", F.lit("Y")), [F.asc("v")])
    assert _rows(redone.select("id", "v")) == [(1, "x"), (2, "Y"), (3, "z")]


def test_command_line(drops, capsys):
    from orderloom.__main__ import main
    drops.put("orders_1.csv", "id\n1\n")
    drops.put("bad_1.csv", "a,a\n1,1\n")
    arguments = ["--root", drops.root, "--landing", str(drops.landing)]
    assert main(["ingest", *arguments, "--run-ts", "2024-01-01T00:00:00"], drops.spark) == 0
    assert main(["ingest", *arguments, "--fail-on-error"], drops.spark) == 1
    assert main(["history", "--root", drops.root], drops.spark) == 0
    assert "orders_1.csv" in capsys.readouterr().out
