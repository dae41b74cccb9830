"""Raw tables: text Parquet by load date and file, read through registered types."""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from ..functions.names import col
from ..functions.values import typed
from .audit import Audit
from .landing import exact, folders
from .local import local_table

LINEAGE = [StructField("_ingested_at", TimestampNTZType()),
           StructField("_batch_id", StringType()), StructField("_source_file", StringType())]
# Day of `_ingested_at`, as text. Loads after a time lie in the partitions from its day on.
LOADED_ON = "_loaded_on"


class MissingTable(ValueError):
    """A raw or model table that is not there yet."""


def raw_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/raw/{table}"


def write_raw(rows: DataFrame, root: str, table: str) -> None:
    """Store rows by day and file. A retry on one day replaces the partitions of its own files
    only; `clear_files` takes away what a run of another day has left.

    Rows already come file by file, so nothing is shuffled and a large file is
    written by as many tasks as read it.
    """
    (rows.withColumn(LOADED_ON, F.date_format("_ingested_at", "yyyy-MM-dd"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(LOADED_ON, "_source_file").parquet(raw_path(root, table)))


def _days(spark: SparkSession, root: str, table: str, since: datetime | None,
          days: Collection[str] | None) -> list[str]:
    """The folders of the days asked for."""
    first = "" if since is None else since.date().isoformat()
    named = {f: f.partition("=")[2] for f in folders(spark, raw_path(root, table))
             if f.startswith(f"{LOADED_ON}=")}
    return sorted(f for f, day in named.items() if day >= first and (days is None or day in days))


def read_text(spark: SparkSession, root: str, table: str, columns: list[str],
              since: datetime | None = None, days: Collection[str] | None = None) -> DataFrame:
    """A raw table as stored; a column a file lacks is NULL in its rows.

    With ``since``, only the days from that time's on, or with ``days`` only those: the folders
    of other days are not even listed.
    """
    path = raw_path(root, table)
    business = [StructField(c, StringType()) for c in columns]
    schema = StructType([*business, *LINEAGE, StructField(LOADED_ON, StringType())])
    found = _days(spark, root, table, since, days)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(
        *[f"{exact(path)}/{f}" for f in found])


def read_raw(spark: SparkSession, root: str, table: str,
             schemas: dict[str, tuple[int, dict[str, str]]] | None = None,
             since: datetime | None = None) -> DataFrame:
    """A raw table with its registered types, looked up unless given.

    With ``since``, at least all rows loaded after that time, without a look at earlier days.
    """
    schemas = Audit(spark, root).active_schemas() if schemas is None else schemas
    if table not in schemas:
        raise MissingTable(f"no raw table {table!r}")
    _, columns = schemas[table]
    return read_text(spark, root, table, list(columns), since).select(
        *[typed(col(c), t).alias(c) for c, t in columns.items()],
        "_ingested_at", "_source_file", "_batch_id")


def clear_files(spark: SparkSession, root: str, table: str, columns: list[str],
                files: Collection[str], days: Collection[str] | None = None) -> None:
    """Take the rows of some files out of a raw table, of all days or some.

    Each file is a partition of its own, which is overwritten with no rows.
    """
    if not _days(spark, root, table, None, days):
        return
    stored = read_text(spark, root, table, columns, days=days)
    names = local_table(spark, [(f,) for f in files], "_source_file string")
    rows = (stored.select("_source_file", F.col("_metadata.file_path").alias("file"))
            .join(names, "_source_file").select("file").distinct().collect())
    kept = stored.drop("_source_file", LOADED_ON).schema
    for folder in sorted({unquote(r["file"]).rsplit("/", 1)[0] for r in rows}):
        spark.createDataFrame([], kept).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(folder)
