"""Data-quality checks. Each returns its failing rows, or one row of counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; NULL keys pass."""
    return (df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Repeated values and NULL rows of a key column, as one row from one pass."""
    per_value = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_records"))
    present = F.col(key).isNotNull()
    return per_value.agg(
        F.count_if(present & (F.col("n_records") > 1)).alias("repeated"),
        F.coalesce(F.sum(F.when(~present, F.col("n_records"))), F.lit(0)).alias("missing"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The number of NULLs of each column, as one row from one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of NULLs, from one pass over the table."""
    counts = null_counts(df, columns)
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failing_rows"))
        for c in columns])).alias("r")).select("r.*")


def relationships(child: DataFrame, column: str, parent: DataFrame,
                  parent_column: str) -> DataFrame:
    """Child values without a parent, with their number of rows; NULL children pass.

    The child is counted per value first, so a hot value is one row in the join.
    """
    values = (child.where(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")))
    keys = parent.select(F.col(parent_column).alias(column))
    return values.join(keys, column, "left_anti")


def age_status(latest: Column, as_of: Column, warn_hours: int, error_hours: int) -> Column:
    """pass / warn / error by the age of the latest load; error where there is none."""
    age = F.timestamp_diff("SECOND", latest, as_of)
    return (F.when(latest.isNull() | (age > error_hours * 3600), "error")
            .when(age > warn_hours * 3600, "warn").otherwise("pass"))


def freshness(df: DataFrame, loaded_at: str, as_of: Column, by: Sequence[str] = (),
              warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """Latest load, its age in seconds and its status, in total or per group."""
    latest = df.groupBy(*by).agg(F.max(loaded_at).alias("latest"))
    return latest.withColumns({
        "age_seconds": F.timestamp_diff("SECOND", F.col("latest"), as_of),
        "status": age_status(F.col("latest"), as_of, warn_hours, error_hours),
    })


def result(name: str, failing: DataFrame, rows: Column | None = None) -> DataFrame:
    """One summary row for a check: its name, failing rows and status."""
    failing_rows = F.coalesce(rows if rows is not None else F.count(F.lit(1)),
                              F.lit(0)).cast("bigint")
    return (failing.agg(failing_rows.alias("failing_rows"))
            .select(F.lit(name).alias("check_name"), "failing_rows",
                    F.when(F.col("failing_rows") > 0, "fail").otherwise("pass").alias("status")))


def status_rows(counts: DataFrame, names: dict[str, str]) -> DataFrame:
    """Summary rows from one row of counts: count column -> check name."""
    rows = counts.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(c).cast("bigint").alias("failing_rows"))
        for c, name in names.items()])).alias("r")).select("r.*")
    return rows.withColumn(
        "status", F.when(F.col("failing_rows") > 0, "fail").otherwise("pass"))


def summary(results: Sequence[DataFrame]) -> DataFrame:
    """All summary rows together."""
    return reduce(DataFrame.unionByName, results)
