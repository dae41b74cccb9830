"""The daily run: ingest, build next to the live tables, check, publish."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import SOURCES
from ..functions.values import naive_utc
from ..operators.incremental import high_water_mark, newer_than
from ..sources.audit import Audit
from ..sources.raw import MissingTable, read_raw
from ..sources.tables import Tables, month_of
from . import intermediate, marts, quality, staging
from .ingest import IngestOptions, ingest

STAGED_VIEWS = {
    "stg_customers": ("customers", staging.stg_customers),
    "stg_order_items": ("order_items", staging.stg_order_items),
    "stg_order_payments": ("order_payments", staging.stg_order_payments),
    "stg_order_reviews": ("order_reviews", staging.stg_order_reviews),
    "stg_products": ("products", staging.stg_products),
    "stg_sellers": ("sellers", staging.stg_sellers),
    "stg_geolocation": ("geolocation", staging.stg_geolocation),
    "stg_category_translation": ("category_translation", staging.stg_category_translation),
}
INTERMEDIATE_VIEWS = ("int_order_items_aggregated", "int_order_payments_pivoted",
                      "int_products_translated")
TABLES = ("stg_orders", "fct_orders", "dim_customers", "dim_products")


@dataclass(frozen=True)
class DailyOptions:
    """How a run treats trouble, and where files come from."""

    source_prefix: str = ""        # text before ``orders_dataset`` and its like
    ingest: IngestOptions = field(default_factory=IngestOptions)
    fail_on_error: bool = False    # stop if any file failed
    publish_on_failure: bool = False
    full_refresh: bool = False     # rebuild the incremental tables
    late_inputs: bool = False      # also redo orders whose other inputs are new


@dataclass(frozen=True)
class DailyResult:
    files: DataFrame
    checks: DataFrame
    freshness: DataFrame
    published: bool


class Models:
    """Every model by name, over raw tables and stored model tables."""

    def __init__(self, spark: SparkSession, root: str, source_prefix: str = "",
                 tables: Tables | None = None, staged: bool = False):
        self.spark, self.root, self.prefix = spark, root, source_prefix
        self.tables = tables or Tables(spark, root)
        self.staged = staged
        self.schemas = Audit(spark, root).active_schemas()

    def raw(self, source: str, since: datetime | None = None) -> DataFrame:
        return read_raw(self.spark, self.root, SOURCES[source].table(self.prefix), self.schemas,
                        since)

    def arrived(self, name: str, since: datetime | None) -> DataFrame:
        """A staged view of the loads from a time's day on."""
        source, view = STAGED_VIEWS[name]
        return view(self.raw(source, since))

    def __call__(self, name: str) -> DataFrame:
        if name in STAGED_VIEWS:
            source, view = STAGED_VIEWS[name]
            return view(self.raw(source))
        if name == "int_order_items_aggregated":
            return intermediate.order_items_aggregated(self("stg_order_items"))
        if name == "int_order_payments_pivoted":
            return intermediate.order_payments_pivoted(self("stg_order_payments"))
        if name == "int_products_translated":
            return intermediate.products_translated(self("stg_products"),
                                                    self("stg_category_translation"))
        table = self.tables.read(name, self.staged)
        if table is None:
            raise MissingTable(f"model {name!r} has not been built")
        return table


def build_models(models: Models, options: DailyOptions = DailyOptions()) -> None:
    """Stage new versions of the stored models."""
    tables = models.tables

    known = None if options.full_refresh else tables.read("stg_orders")
    mark = None if known is None else high_water_mark(known, "_ingested_at")
    fresh = staging.stg_orders(newer_than(models.raw("orders", mark), "_ingested_at", mark))
    by_month = month_of("purchased_at")
    if known is None:
        tables.build("stg_orders", fresh, by_month)
    else:
        tables.merge("stg_orders", fresh, "order_id", marts.latest_load(), by_month)

    staged_orders = tables.read("stg_orders", staged=True)
    inputs = (models("stg_customers"), models("stg_order_items"), models("stg_order_payments"))
    target = None if options.full_refresh else tables.read("fct_orders")
    if target is None:
        fact = marts.fct_orders(staged_orders, models("stg_customers"),
                                models("int_order_items_aggregated"),
                                models("int_order_payments_pivoted"))
        tables.build("fct_orders", fact, by_month)
    else:
        mark = high_water_mark(target, "_ingested_at")
        due = newer_than(staged_orders, "_ingested_at", mark)
        if options.late_inputs:
            due = marts.late_orders(mark, staged_orders, *[
                models.arrived(name, mark)
                for name in ("stg_customers", "stg_order_items", "stg_order_payments")])
        tables.merge("fct_orders", marts.fct_orders_for(due, *inputs), "order_id",
                     marts.latest_load(), by_month)

    tables.build("dim_customers", marts.dim_customers(models("stg_customers")))
    tables.build("dim_products", marts.dim_products(models("int_products_translated")))


def check_models(models: Models, run_ts: datetime) -> DataFrame:
    """Run the checks once and keep their results in the audit."""
    run_ts = naive_utc(run_ts)
    audit = Audit(models.spark, models.root)
    rows = quality.model_checks(models).collect()
    audit.append("check_results", [(*r, run_ts) for r in rows])
    return audit.read("check_results").where(
        F.col("checked_at") == F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz"))


def run_daily(spark: SparkSession, landing: str, root: str, run_ts: datetime,
              options: DailyOptions = DailyOptions()) -> DailyResult:
    """One day's work. Failing checks leave the live tables as they were."""
    run_ts = naive_utc(run_ts)
    files = ingest(spark, landing, root, run_ts, options.ingest)
    failed = [r["source_file"] for r in
              files.where(F.col("status") == "FAILED").select("source_file").collect()]
    if failed and options.fail_on_error:
        raise RuntimeError(f"files failed to load: {failed}")
    tables = Tables(spark, root)
    models = Models(spark, root, options.source_prefix, tables, staged=True)
    build_models(models, options)
    checks = check_models(models, run_ts)
    passed = checks.where(F.col("status") != "pass").isEmpty()
    publish = passed or options.publish_on_failure
    if publish:
        tables.publish(run_ts)
    return DailyResult(files, checks, quality.source_freshness(models.raw, run_ts), publish)


def create_views(spark: SparkSession, root: str, source_prefix: str = "") -> list[str]:
    """Temporary views over every layer, for SQL: raw, staging, intermediate, marts, audit.

    Models whose sources have not been loaded, or that have not been built, are left out.
    """
    models = Models(spark, root, source_prefix)
    audit = Audit(spark, root)
    views = {table: read_raw(spark, root, table, models.schemas) for table in models.schemas}
    for name in (*STAGED_VIEWS, *INTERMEDIATE_VIEWS, *TABLES):
        try:
            views[name] = models(name)
        except MissingTable:
            continue
    views |= {"ingestion_log": audit.read("ingestion_log"), "schema_registry": audit.registry(),
              "check_results": audit.read("check_results"), "quarantine": audit.quarantined()}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
