"""The audit tables: ingestion log, schema registry, check results, quarantine."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..operators.keys import latest_per_key
from .landing import missing_path
from .local import local_table

LOG = ("table_name string, batch_id string, schema_hash string, source_file string, "
       "file_size bigint, rows_read bigint, rows_loaded bigint, rows_rejected bigint, "
       "rows_duplicate bigint, promoted array<string>, status string, message string, "
       "ingested_at timestamp_ntz")
REGISTRY = ("table_name string, version bigint, schema_hash string, column_order array<string>, "
            "columns map<string,string>, source_file string, detected_at timestamp_ntz")
CHECKS = ("check_name string, failing_rows bigint, status string, checked_at timestamp_ntz")
ATTEMPTS = "table_name string, source_file string, loaded_on string"
EVIDENCE = ("table_name string, source_file string, column_name string, n_values bigint, "
            "fits map<string,bigint>, loaded_at timestamp_ntz")
QUARANTINE = ("table_name string, batch_id string, reason string, record string, "
              "quarantined_at timestamp_ntz, run_id string, source_file string")

TABLES = {"ingestion_log": LOG, "schema_registry": REGISTRY, "check_results": CHECKS,
          "load_attempts": ATTEMPTS, "type_evidence": EVIDENCE}


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A Parquet table under a declared schema; columns older files lack are NULL."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if not missing_path(error):
            raise
        return spark.createDataFrame([], schema)


class Audit:
    """Append-only tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.root}/audit/{name}"

    def ensure(self) -> None:
        """Create the audit tables that do not exist yet."""
        for name, schema in TABLES.items():
            try:
                self.spark.read.schema(schema).parquet(self._path(name))
            except AnalysisException as error:
                if not missing_path(error):
                    raise
                self.append(name, [])

    def append(self, name: str, rows: Iterable[tuple]) -> None:
        """Add a run's rows as one file."""
        (local_table(self.spark, list(rows), TABLES[name])
         .write.mode("append").parquet(self._path(name)))

    def read(self, name: str) -> DataFrame:
        return read_or_empty(self.spark, self._path(name), TABLES[name])

    def _last(self, *statuses: str) -> Column:
        return F.max(F.when(F.col("status").isin(*statuses), F.col("ingested_at")))

    def processed(self) -> DataFrame:
        """Files that are not loaded again: a SUCCESS row and no later reopening."""
        return (self.read("ingestion_log").groupBy("source_file")
                .agg(self._last("SUCCESS").alias("loaded"),
                     self._last("REOPENED").alias("reopened"))
                .where(F.col("reopened").isNull() | (F.col("loaded") > F.col("reopened")))
                .where(F.col("loaded").isNotNull())
                .select("source_file", F.lit("SUCCESS").alias("status")))

    def held(self, table: str) -> DataFrame:
        """Files whose rows a raw table holds: loaded, and not taken back since."""
        return (self.read("ingestion_log").where(F.col("table_name") == table)
                .groupBy("source_file")
                .agg(self._last("SUCCESS").alias("loaded"),
                     self._last("REOPENED", "ROLLED_BACK").alias("taken"))
                .where(F.col("loaded").isNotNull() & (
                    F.col("taken").isNull() | (F.col("loaded") > F.col("taken"))))
                .select("source_file"))

    def left_behind(self, files: Iterable[str], today: str) -> list[Row]:
        """(table_name, source_file, loaded_on) of earlier days' attempts to load some files: a
        run that died after storing a file has not logged it."""
        names = local_table(self.spark, [(f,) for f in files], "source_file string")
        return (self.read("load_attempts").join(names, "source_file")
                .where(F.col("loaded_on") != today).distinct().collect())

    def registry(self) -> DataFrame:
        """Every registered schema as JSON too, the newest of each table marked active."""
        newest = F.max("version").over(Window.partitionBy("table_name"))
        return self.read("schema_registry").withColumns({
            "columns_json": F.to_json("columns"),
            "is_active": F.col("version") == newest,
        })

    def active_schemas(self) -> dict[str, tuple[int, dict[str, str]]]:
        """Table -> (version, ordered columns and types); one small row per table."""
        active = latest_per_key(self.read("schema_registry"), ["table_name"],
                                [F.desc("version"), F.desc("schema_hash")])
        return {r["table_name"]: (r["version"], {c: r["columns"][c] for c in r["column_order"]})
                for r in active.collect()}

    def table_columns(self, table: str) -> list[str] | None:
        """Business columns of a raw table in order, or None if there is no such table."""
        found = self.active_schemas().get(table)
        return list(found[1]) if found else None

    def quarantine(self, rows: DataFrame) -> None:
        """Put rows aside; repeating a run replaces what it put there before."""
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "source_file").parquet(f"{self.root}/quarantine"))

    def quarantined(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/quarantine", QUARANTINE)
