"""The declared checks of the order model, and source freshness."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS, SOURCES
from ..operators import checks
from ..sources.local import local_table
from ..sources.raw import MissingTable

# Which columns of which model must be unique, and which never NULL.
UNIQUE = {
    "stg_customers": "customer_id",
    "stg_orders": "order_id",
    "stg_products": "product_id",
    "stg_sellers": "seller_id",
    "stg_order_reviews": "review_id",
    "stg_category_translation": "category_name",
    "fct_orders": "order_id",
    "dim_products": "product_id",
    "dim_customers": "customer_id",
}
NOT_NULL = {
    "stg_customers": ["customer_id"],
    "stg_orders": ["order_id"],
    "stg_order_items": ["order_id", "order_item_id"],
    "stg_order_payments": ["order_id"],
    "stg_products": ["product_id"],
    "stg_sellers": ["seller_id"],
    "stg_order_reviews": ["review_id"],
    "stg_geolocation": ["zip_code_prefix"],
    "stg_category_translation": ["category_name"],
    "fct_orders": ["order_id", "customer_id"],
    "dim_products": ["product_id"],
    "dim_customers": ["customer_id"],
}
# (child model, child column, parent model, parent column)
RELATIONSHIPS = [("fct_orders", "customer_id", "dim_customers", "customer_id")]

Models = Callable[[str], DataFrame]


def _errors(names: list[str]) -> DataFrame:
    """Results of checks that could not run, since what they read has never arrived."""
    return local_table(SparkSession.active(), [(n, None, "error") for n in names],
                       "check_name string, failing_rows bigint, status string")


def _model_results(model: Models, name: str) -> list[DataFrame]:
    """The unique and not-null checks of one model; a column checked both ways is grouped once."""
    key = UNIQUE.get(name)
    both = {"repeated": f"unique_{name}_{key}", "missing": f"not_null_{name}_{key}"} if key else {}
    rest = {c: f"not_null_{name}_{c}" for c in NOT_NULL[name] if c != key}
    try:
        table = model(name)
    except MissingTable:
        return [_errors([*both.values(), *rest.values()])]
    results = [checks.status_rows(checks.key_counts(table, key), both)] if key else []
    if rest:
        results.append(checks.status_rows(checks.null_counts(table, list(rest)), rest))
    return results


def model_checks(model: Models) -> DataFrame:
    """All 24 checks, one row each, as a single query.

    A check of a model whose source has never arrived has status ``error``; the others run.
    """
    results = [r for name in NOT_NULL for r in _model_results(model, name)]
    for child, column, parent, parent_column in RELATIONSHIPS:
        check = f"relationships_{child}_{column}"
        try:
            orphans = checks.relationships(model(child), column, model(parent), parent_column)
        except MissingTable:
            results.append(_errors([check]))
            continue
        results.append(checks.result(check, orphans, F.sum("n_records")))
    return checks.summary(results)


def source_freshness(raw: Models, as_of: datetime) -> DataFrame:
    """Age of the newest load of each source; over 24 hours warns, over 48 fails. A source that
    has never arrived is an error too."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    found, absent = [], []
    for name in SOURCES:
        try:
            found.append(checks.freshness(
                raw(name), "_ingested_at", now, warn_hours=FRESHNESS_WARN_HOURS,
                error_hours=FRESHNESS_ERROR_HOURS).select(
                F.lit(name).alias("source"), "latest", "age_seconds", "status"))
        except MissingTable:
            absent.append((name, None, None, "error"))
    if absent:
        found.append(local_table(SparkSession.active(), absent, "source string, "
                                 "latest timestamp_ntz, age_seconds bigint, status string"))
    return checks.summary(found)
