"""Whole runs over small drops: build, change, check, publish, take back."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderloom.plans import batches
from orderloom.plans.daily import DailyOptions, Models, build_models, create_views, run_daily
from orderloom.sources.tables import Tables

PREFIX = "shop_"
DAY = [datetime(2024, 1, d) for d in range(1, 29)]

FIRST = {
    "customers_dataset": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,"
                         "customer_state\nc1,u1,01151,sao paulo,SP\nc2,u2,20000,rio,RJ\n",
    "orders_dataset": "order_id,customer_id,order_status,order_purchase_timestamp,"
                      "order_approved_at,order_delivered_carrier_date,"
                      "order_delivered_customer_date,order_estimated_delivery_date\n"
                      "o1,c1,delivered,2018-01-02 10:00:00,2018-01-02 11:00:00,,,2018-01-20\n"
                      "o2,c2,created,2018-02-03 10:00:00,,,,2018-02-20\n",
    "order_items_dataset": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,"
                           "price,freight_value\no1,1,p1,s1,2018-01-05 00:00:00,10.10,1.05\n"
                           "o1,2,p2,s1,2018-01-06 00:00:00,20.20,2.00\n",
    "order_payments_dataset": "order_id,payment_sequential,payment_type,payment_installments,"
                              "payment_value\no1,1,credit_card,3,30.00\no1,2,voucher,1,3.35\n"
                              "o1,3,barter,1,1.00\no2,1,,1,\n",
    "order_reviews_dataset": "review_id,order_id,review_score,review_comment_title,"
                             "review_comment_message,review_creation_date,"
                             "review_answer_timestamp\n"
                             "r1,o1,5,,old,2018-01-10,2018-01-11 00:00:00\n"
                             "r1,o1,4,,new,2018-01-10,2018-01-12 00:00:00\n"
                             "r2,o1,4,,answered,2018-01-10,2018-01-12 00:00:00\n"
                             "r2,o2,3,,open,2018-01-10,\n"
                             "r3,o2,1,,tie b,2018-01-10,2018-01-12 00:00:00\n"
                             "r3,o1,1,,tie a,2018-01-10,2018-01-12 00:00:00\n",
    "products_dataset": "product_id,product_category_name,product_name_lenght,"
                        "product_description_lenght,product_photos_qty,product_weight_g,"
                        "product_length_cm,product_height_cm,product_width_cm\n"
                        "p1,brinquedos,10,100,1,200,10,5,4\np2,raro,11,90,2,300,20,6,5\n",
    "sellers_dataset": "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
                       "s1,3000,santos,SP\n",
    "geolocation_dataset": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,"
                           "geolocation_city,geolocation_state\n1151,-23.5,-46.6,sao paulo,SP\n",
}
TRANSLATION = ("product_category_name,product_category_name_english\nbrinquedos,toys\n")
ORDERS_HEAD = FIRST["orders_dataset"].split("\n")[0] + "\n"


class Shop:
    def __init__(self, spark, base):
        self.spark = spark
        self.landing, self.root = base / "landing", str(base / "warehouse")
        self.landing.mkdir()
        for name, text in FIRST.items():
            self.put(f"{PREFIX}{name}.csv", text)
        self.put("product_category_name_translation.csv", TRANSLATION)

    def put(self, name, text):
        (self.landing / name).write_text(text, encoding="utf-8")

    def run(self, day, **options):
        from orderloom.plans.ingest import IngestOptions
        names = {f"{PREFIX}{n}": f"{PREFIX}{n}" for n in FIRST}
        return run_daily(self.spark, str(self.landing), self.root, DAY[day],
                         DailyOptions(source_prefix=PREFIX, ingest=IngestOptions(tables=names),
                                      **options))

    def models(self, **kwargs):
        return Models(self.spark, self.root, PREFIX, **kwargs)

    def fact(self):
        return {r["order_id"]: r for r in self.models()("fct_orders").collect()}


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, tmp_path)


def test_first_run(shop):
    result = shop.run(0)
    assert result.published
    assert result.checks.count() == 24
    assert {r["status"] for r in result.checks.collect()} == {"pass"}
    assert {r["status"] for r in result.freshness.collect()} == {"pass"}
    assert result.freshness.count() == 9
    o1, o2 = shop.fact()["o1"], shop.fact()["o2"]
    assert (o1["total_items"], o1["total_item_price"], o1["total_freight"]) == (2, 30.3, 3.05)
    assert (o1["credit_card_amount"], o1["voucher_amount"], o1["boleto_amount"]) == (30, 3.35, 0)
    assert o1["total_payment_value"] == 34.35
    assert o1["customer_unique_id"] == "u1"
    assert o1["purchased_at"] == datetime(2018, 1, 2, 10)
    assert (o2["total_items"], o2["total_item_price"], o2["total_payment_value"]) == (0, 0, 0)
    models = shop.models()
    assert {r[0]: r[1] for r in models("dim_products").select("product_id", "category_name")
            .collect()} == {"p1": "toys", "p2": "raro"}
    assert {r[0]: r[1] for r in models("stg_order_reviews")
            .select("review_id", "review_comment_message").collect()} == {
        "r1": "new", "r2": "open", "r3": "tie a"}


def test_rerun_without_files_changes_nothing(shop):
    shop.run(0)
    before = shop.fact()
    assert shop.run(1).files.count() == 0
    assert shop.fact() == before


def test_update_replaces_adds_and_touches_only_its_months(shop):
    shop.run(0)
    january = Tables(shop.spark, shop.root).live("fct_orders")["2018-01"].path
    shop.put(f"{PREFIX}orders_dataset_2.csv", ORDERS_HEAD +
             "o2,c1,shipped,2018-02-03 10:00:00,,,,2018-02-20\n"
             "o3,c9,created,2018-03-01 10:00:00,,,,\no3,c2,paid,2018-03-02 10:00:00,,,,\n")
    result = shop.run(1)
    assert result.published
    fact = shop.fact()
    assert set(fact) == {"o1", "o2", "o3"}
    assert (fact["o2"]["order_status"], fact["o2"]["customer_unique_id"]) == ("shipped", "u1")
    assert fact["o3"]["order_status"] == "paid"
    tables = Tables(shop.spark, shop.root)
    live = tables.live("fct_orders")
    assert live["2018-01"].path == january
    assert {(r["table_name"], r["version"], r["part"]) for r in tables.superseded().collect()} == {
        ("stg_orders", 1, "2018-02"), ("fct_orders", 1, "2018-02"),
        ("dim_customers", 1, "all"), ("dim_products", 1, "all")}
    assert sorted(live) == ["2018-01", "2018-02", "2018-03"]


def test_order_that_moves_month_leaves_the_old_one(shop):
    shop.run(0)
    shop.put(f"{PREFIX}orders_dataset_2.csv", ORDERS_HEAD +
             "o2,c2,created,2018-05-03 10:00:00,,,,\n")
    shop.run(1)
    assert shop.fact()["o2"]["purchased_at"] == datetime(2018, 5, 3, 10)
    assert len(shop.fact()) == 2
    assert Tables(shop.spark, shop.root).live("fct_orders")["2018-02"].path is None


def test_widened_column_rewrites_every_part(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    part = F.col("p")
    tables.build("t", spark.createDataFrame([(1, 10, "a"), (2, 20, "b")],
                                            "k int, v bigint, p string"), part)
    tables.publish(DAY[0])
    tables.merge("t", spark.createDataFrame([(2, 2.5, "b")], "k int, v double, p string"), "k",
                 [F.desc("v")], part)
    tables.publish(DAY[1])
    assert sorted(map(tuple, tables.read("t").collect())) == [(1, 10.0, "a"), (2, 2.5, "b")]


def test_leftovers_of_an_unpublished_version_are_not_read(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    Tables(spark, str(tmp_path)).build("t", rows, F.col("p"))
    tables = Tables(spark, str(tmp_path))
    tables.build("t", rows.where("k = 2"), F.col("p"))
    tables.publish(DAY[0])
    assert [r["k"] for r in tables.read("t").collect()] == [2]


def test_incremental_equals_rebuild(shop):
    shop.run(0)
    shop.put(f"{PREFIX}orders_dataset_2.csv", ORDERS_HEAD +
             "o4,c2,created,2018-03-01 10:00:00,,,,\n")
    shop.put(f"{PREFIX}order_items_dataset_2.csv", FIRST["order_items_dataset"].split("\n")[0] +
             "\no4,1,p1,s1,2018-03-05 00:00:00,5.5,1\n")
    shop.run(1)
    incremental = shop.fact()
    shop.run(2, full_refresh=True)
    assert shop.fact() == incremental


def test_late_items_need_the_option(shop):
    shop.run(0)
    shop.put(f"{PREFIX}order_items_dataset_2.csv", FIRST["order_items_dataset"].split("\n")[0] +
             "\no2,1,p1,s1,2018-03-05 00:00:00,5.5,1\n")
    shop.run(1)
    assert shop.fact()["o2"]["total_items"] == 0
    shop.run(2, late_inputs=True)
    assert shop.fact()["o2"]["total_items"] == 1
    assert shop.fact()["o1"]["total_items"] == 2


def test_late_customers_need_the_option(shop):
    shop.put(f"{PREFIX}orders_dataset_2.csv", ORDERS_HEAD +
             "o8,c8,created,2018-03-01 10:00:00,,,,\n")
    shop.run(0, publish_on_failure=True)
    assert shop.fact()["o8"]["customer_unique_id"] is None
    shop.put(f"{PREFIX}customers_dataset_2.csv", FIRST["customers_dataset"].split("\n")[0] +
             "\nc8,u8,1000,natal,RN\n")
    assert shop.run(1, late_inputs=True).published
    assert shop.fact()["o8"]["customer_unique_id"] == "u8"
    assert len(shop.fact()) == 3


def test_failing_checks_keep_the_live_tables(shop):
    shop.run(0)
    before = shop.fact()
    shop.put(f"{PREFIX}orders_dataset_2.csv", ORDERS_HEAD +
             "o5,missing,created,2018-03-01 10:00:00,,,,\n")
    result = shop.run(1)
    assert not result.published
    failing = {r["check_name"]: r["failing_rows"] for r in result.checks.collect()
               if r["status"] == "fail"}
    assert failing == {"relationships_fct_orders_customer_id": 1}
    assert shop.fact() == before
    assert shop.run(2, publish_on_failure=True).published
    assert "o5" in shop.fact()


def test_every_check_can_fail(shop):
    """Duplicate keys everywhere; NULLs where a key filter does not already drop them."""
    for name in ("customers", "orders", "products", "sellers"):
        text = FIRST[f"{name}_dataset"]
        shop.put(f"{PREFIX}{name}_dataset_2.csv", text)
    shop.put("product_category_name_translation_2.csv", TRANSLATION)
    shop.put(f"{PREFIX}order_items_dataset_2.csv", FIRST["order_items_dataset"].split("\n")[0] +
             "\no1,,p1,s1,2018-03-05 00:00:00,5.5,1\n")
    shop.put(f"{PREFIX}orders_dataset_3.csv", ORDERS_HEAD + "o6,,created,2018-03-01 10:00:00,,,,\n")
    from orderloom.plans.ingest import IngestOptions
    names = {f"{PREFIX}{n}": f"{PREFIX}{n}" for n in FIRST}
    names["product_category_name_translation"] = "product_category_name_translation"
    result = run_daily(shop.spark, str(shop.landing), shop.root, DAY[0],
                       DailyOptions(source_prefix=PREFIX, ingest=IngestOptions(tables=names)))
    assert not result.published
    failing = {r["check_name"] for r in result.checks.collect() if r["status"] == "fail"}
    assert failing == {
        "unique_stg_customers_customer_id", "unique_stg_orders_order_id",
        "unique_stg_products_product_id", "unique_stg_sellers_seller_id",
        "unique_stg_category_translation_category_name", "unique_fct_orders_order_id",
        "unique_dim_products_product_id", "unique_dim_customers_customer_id",
        "not_null_stg_order_items_order_item_id", "not_null_fct_orders_customer_id"}


def test_stale_sources_warn_then_fail(shop):
    from orderloom.plans.quality import source_freshness
    shop.run(0)
    raw = shop.models().raw
    for now, status in ((datetime(2024, 1, 2), "pass"), (datetime(2024, 1, 2, 0, 0, 1), "warn"),
                        (datetime(2024, 1, 3, 0, 0, 1), "error")):
        assert {r["status"] for r in source_freshness(raw, now).collect()} == {status}


def test_failed_file_may_stop_the_run(shop):
    shop.put(f"{PREFIX}orders_dataset_2.csv", ORDERS_HEAD + "o7\n")
    with pytest.raises(RuntimeError, match="orders_dataset_2"):
        shop.run(0, fail_on_error=True)
    assert shop.run(1).published


def test_roll_back_and_reload(shop):
    shop.run(0)
    shop.put(f"{PREFIX}orders_dataset_2.csv", ORDERS_HEAD +
             "o4,c2,created,2018-03-01 10:00:00,,,,\n")
    shop.run(1)
    before = shop.models().raw("orders").drop("_ingested_at")
    rows = sorted(map(repr, before.collect()))
    batch = before.where(F.col("order_id") == "o4").first()["_batch_id"]
    files = batches.roll_back(shop.spark, shop.root, f"{PREFIX}orders_dataset", batch, DAY[2],
                              reload=True)
    assert files == [f"{PREFIX}orders_dataset_2.csv"]
    assert shop.models().raw("orders").count() == 2
    shop.run(3, full_refresh=True)
    assert sorted(map(repr, shop.models().raw("orders").drop("_ingested_at").collect())) == rows
    batches.roll_back(shop.spark, shop.root, f"{PREFIX}orders_dataset", batch, DAY[4])
    assert shop.run(5, full_refresh=True).files.count() == 0
    assert set(shop.fact()) == {"o1", "o2"}
    loads = {r["source_file"]: r["loads"] for r in batches.history(shop.spark, shop.root).collect()}
    assert loads[f"{PREFIX}orders_dataset_2.csv"] == 4


def test_reprocess_a_batch(shop):
    shop.run(0)
    shop.put(f"{PREFIX}order_items_dataset_2.csv", FIRST["order_items_dataset"].split("\n")[0] +
             "\no2,1,p1,s1,2018-03-05 00:00:00,5.5,1\n")
    shop.run(1)
    models = shop.models(staged=True)
    batch = models.raw("order_items").where(F.col("order_id") == "o2").first()["_batch_id"]
    batches.reprocess(models, batch)
    models.tables.publish(DAY[2])
    assert shop.fact()["o2"]["total_items"] == 1
    assert len(shop.fact()) == 2


def test_reprocess_a_batch_of_customers(shop):
    shop.run(0)
    models = shop.models(staged=True)
    batch = models.raw("customers").first()["_batch_id"]
    before = shop.fact()
    batches.reprocess(models, batch)
    assert {"fct_orders", "stg_orders", "dim_customers", "dim_products"} <= set(
        models.tables.staged)
    models.tables.publish(DAY[2])
    assert shop.fact() == before


def test_roll_back_that_dies_half_way_is_repeated(shop, monkeypatch):
    shop.run(0)
    table = f"{PREFIX}orders_dataset"
    batch = shop.models().raw("orders").first()["_batch_id"]
    monkeypatch.setattr(batches, "clear_files", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        batches.roll_back(shop.spark, shop.root, table, batch, DAY[1], reload=True)
    monkeypatch.undo()
    log = batches.Audit(shop.spark, shop.root).read("ingestion_log")
    assert log.where("status = 'REOPENED'").count() == 1
    assert batches.roll_back(shop.spark, shop.root, table, batch, DAY[2], reload=True) == [
        f"{table}.csv"]
    assert shop.models().raw("orders").count() == 0


def test_totals_agree_across_layers(shop):
    shop.run(0)
    models = shop.models()
    staged = models("stg_order_payments").agg(F.sum("payment_value")).first()[0]
    assert models("fct_orders").agg(F.sum("total_payment_value")).first()[0] == pytest.approx(staged)
    assert models("fct_orders").count() == models("stg_orders").count()


def test_views_answer_sql(shop):
    shop.run(0)
    names = create_views(shop.spark, shop.root, PREFIX)
    assert len(names) == 9 + 8 + 3 + 4 + 4
    assert shop.spark.sql("select sum(total_items) n from fct_orders").first()["n"] == 2
    assert shop.spark.sql("select count(*) n from ingestion_log").first()["n"] == 9


def test_commands(shop, capsys):
    from orderloom.__main__ import main
    common = ["--root", shop.root, "--landing", str(shop.landing), "--prefix", PREFIX]
    maps = [a for n in FIRST for a in ("--table-map", f"{PREFIX}{n}={PREFIX}{n}")]

    def run(command, day, *more):
        return main([command, *common, "--run-ts", DAY[day].isoformat(), *more], shop.spark)

    assert run("daily", 0, *maps) == 0
    shop.put(f"{PREFIX}orders_dataset_2.csv", ORDERS_HEAD +
             "o5,missing,created,2018-03-01 10:00:00,,,,\n")
    assert run("ingest", 1, *maps) == 0
    assert run("build", 1) == 0
    assert run("check", 1) == 1
    assert run("freshness", 1) == 0
    batch = shop.models().raw("orders").where("order_id = 'o5'").first()["_batch_id"]
    assert run("rollback", 2, "--table", f"{PREFIX}orders_dataset", "--batch", batch) == 0
    assert run("build", 2, "--full-refresh") == 0
    assert run("check", 2) == 0
    capsys.readouterr()
    assert run("sql", 2, "--query", "select count(*) n_orders from fct_orders") == 0
    assert "n_orders" in capsys.readouterr().out


def test_views_before_everything_is_there(drops):
    drops.put("customers_dataset.csv", FIRST["customers_dataset"])
    drops.put("extra.csv", "a\n1\n")
    drops.load()
    names = create_views(drops.spark, drops.root)
    assert names == ["check_results", "customers_dataset", "extra", "ingestion_log",
                     "quarantine", "schema_registry", "stg_customers"]
    with pytest.raises(ValueError, match="orders_dataset"):
        build_models(Models(drops.spark, drops.root))


def test_unpublished_build_is_invisible(shop):
    shop.run(0)
    models = shop.models(staged=True)
    build_models(models, DailyOptions(source_prefix=PREFIX, full_refresh=True))
    assert Tables(shop.spark, shop.root).live("dim_customers")["all"].version == 1
    assert models("dim_customers").count() == 2


def test_sources_that_never_arrived_are_reported(shop):
    (shop.landing / f"{PREFIX}order_reviews_dataset.csv").unlink()
    (shop.landing / f"{PREFIX}sellers_dataset.csv").unlink()
    result = shop.run(0)
    errors = {r["check_name"] for r in result.checks.where("status = 'error'").collect()}
    assert errors == {"unique_stg_order_reviews_review_id", "not_null_stg_order_reviews_review_id",
                      "unique_stg_sellers_seller_id", "not_null_stg_sellers_seller_id"}
    assert result.checks.count() == 24 and result.checks.where("status = 'pass'").count() == 20
    assert {r["source"]: r["status"] for r in result.freshness.collect() if r["latest"] is None} \
        == {"order_reviews": "error", "sellers": "error"}
    assert not result.published
    assert shop.run(1, publish_on_failure=True).published
    assert set(shop.fact()) == {"o1", "o2"}
