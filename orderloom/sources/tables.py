"""Model tables as versioned Parquet with a manifest.

A version is written beside the live one and becomes live when the manifest
names it, all models of a run in one append. Tables may be kept in parts (for
example months); an upsert then rewrites only the parts it touches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.incremental import upsert
from ..operators.keys import latest_per_key
from ..session import scratch_dir
from .audit import read_or_empty
from .local import local_table

MANIFEST = ("table_name string, version bigint, part string, path string, full boolean, "
            "n_rows bigint, schema_json string, published_at timestamp_ntz")
_PART = "__part"
_WHOLE = "all"


@dataclass(frozen=True)
class Entry:
    """One part of a table version; without a path the part is empty."""

    table: str
    version: int
    part: str
    path: str | None
    full: bool
    n_rows: int
    schema_json: str


def month_of(column: str) -> Column:
    """Part name of a timestamp: its month, or ``none``."""
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit("none"))


class Tables:
    """Live and staged versions of the model tables under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifest_path = f"{self.root}/dev/manifest"
        self.staged: dict[str, list[Entry]] = {}
        self._live: dict[str, dict[str, Entry]] | None = None

    def manifest(self) -> DataFrame:
        return read_or_empty(self.spark, self.manifest_path, MANIFEST)

    def live(self, table: str) -> dict[str, Entry]:
        """Part -> newest entry since the last full build; one small row per part."""
        if self._live is None:
            m = self.manifest()
            base = (m.where("full").groupBy("table_name")
                    .agg(F.max("version").alias("base")))
            current = latest_per_key(
                m.join(base, "table_name").where(F.col("version") >= F.col("base")),
                ["table_name", "part"], [F.desc("version"), F.desc_nulls_last("path")])
            self._live = {}
            for r in current.collect():
                self._live.setdefault(r["table_name"], {})[r["part"]] = Entry(
                    r["table_name"], r["version"], r["part"], r["path"], r["full"],
                    r["n_rows"], r["schema_json"])
        return self._live.get(table, {})

    def superseded(self) -> DataFrame:
        """Folders of parts that a later version replaced; none is read any more."""
        self.live("")
        live = local_table(self.spark, [(e.path,) for parts in self._live.values()
                                        for e in parts.values() if e.path], "path string")
        return (self.manifest().where(F.col("path").isNotNull())
                .join(live, "path", "left_anti").select("table_name", "version", "part", "path"))

    def _after_staging(self, table: str) -> dict[str, Entry]:
        entries = self.staged.get(table, [])
        kept = {} if any(e.full for e in entries) else self.live(table)
        return {**kept, **{e.part: e for e in entries}}

    def _open(self, entries: Sequence[Entry]) -> DataFrame | None:
        if not entries:
            return None
        newest = max(entries, key=lambda e: e.version)
        schema = StructType.fromJson(json.loads(newest.schema_json))
        paths = [e.path for e in entries if e.path]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, table: str, staged: bool = False) -> DataFrame | None:
        """The live table, or with ``staged`` as it will be; None before its first build."""
        entries = self._after_staging(table) if staged else self.live(table)
        return self._open(list(entries.values()))

    def build(self, table: str, df: DataFrame, part: Column | None = None) -> None:
        """Stage a full new version."""
        self._write(table, df, part, full=True)

    def merge(self, table: str, batch: DataFrame, key: str, order: Sequence[Column],
              part: Column) -> None:
        """Stage an upsert of a batch; the first one is a full build.

        Only parts holding a batch key, before or after, are read and rewritten.
        The batch is written first, so that it is computed once.
        """
        live = self.live(table)
        if not live:
            self.build(table, batch, part)
            return
        path = scratch_dir(self.spark, table, f"{self.root}/work")
        batch.write.mode("overwrite").parquet(path)
        batch = self.spark.read.schema(batch.schema).parquet(path)
        target = self._open(list(live.values()))
        keys = batch.select(key).distinct()
        touched = {r[0] for r in
                   batch.select(part.alias(_PART))
                   .unionByName(target.join(keys, key, "left_semi").select(part.alias(_PART)))
                   .distinct().collect()}
        if not touched:
            return
        merged_types = dict(target.unionByName(batch, allowMissingColumns=True).dtypes)
        if any(merged_types[c] != t for c, t in target.dtypes):
            # Parquet cannot be read under another type: a widened column is rewritten whole.
            touched |= set(live)
        old = self._open([e for name, e in live.items() if name in touched])
        if old is None:
            old = self.spark.createDataFrame([], target.schema)
        self._write(table, upsert(old, batch, key, order), part, full=False, touched=touched)

    def _next(self, table: str) -> int:
        staged = [e.version for e in self.staged.get(table, [])]
        known = self.manifest().where(F.col("table_name") == table).agg(F.max("version")).first()[0]
        return max([known or 0, *staged]) + 1

    def _write(self, table: str, df: DataFrame, part: Column | None, full: bool,
               touched: set[str] = frozenset()) -> None:
        version = self._next(table)
        # Runs at the same time may come to the same number; their folders differ.
        path = f"{self.root}/dev/{table}/v{version:08d}-{uuid.uuid4().hex[:12]}"
        schema = df.schema.json()
        if part is None:
            df.write.mode("overwrite").parquet(path)
            rows = self.spark.read.schema(df.schema).parquet(path).count()
            entries = [Entry(table, version, _WHOLE, path, full, rows, schema)]
        else:
            # Rebalancing gives each part few files, and splits a part too big for one task.
            (df.withColumn(_PART, part).hint("rebalance", F.col(_PART))
             .write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy(_PART).parquet(path))
            counts = (read_or_empty(self.spark, path, f"{_PART} string")
                      .groupBy(_PART).count().collect())
            entries = [Entry(table, version, r[_PART], f"{path}/{_PART}={r[_PART]}", full,
                             r["count"], schema) for r in counts]
            gone = (set(touched) or ({_WHOLE} if not entries else set())) - {
                e.part for e in entries}
            entries += [Entry(table, version, name, None, full, 0, schema) for name in gone]
        self.staged[table] = entries

    def publish(self, at: datetime) -> None:
        """Make every staged version live at once."""
        rows = [(e.table, e.version, e.part, e.path, e.full, e.n_rows, e.schema_json, at)
                for entries in self.staged.values() for e in entries]
        if rows:
            (local_table(self.spark, rows, MANIFEST)
             .write.mode("append").parquet(self.manifest_path))
        self.staged, self._live = {}, None
