"""Deciding the types of a raw table anew, from what its files have said."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.values import UNKNOWN, naive_utc
from ..operators.evidence import Evidence
from ..operators.evolve import schema_hash
from ..operators.keys import latest_per_key
from ..sources.audit import Audit
from ..sources.raw import MissingTable
from .ingest import LINEAGE_TYPES


def _held(audit: Audit, table: str) -> tuple[DataFrame, DataFrame]:
    """The files a table holds, and the newest evidence of each of their columns."""
    files = audit.held(table)
    said = audit.read("type_evidence").where(F.col("table_name") == table).join(
        files, "source_file", "left_semi")
    return files, latest_per_key(said, ["source_file", "column_name"], [F.desc("loaded_at")])


def folded(audit: Audit, table: str) -> dict[str, Evidence]:
    """The sum of the evidence of all files a table holds, per column.

    Summed by Spark; one row per column and type reaches the driver.
    """
    files, said = _held(audit, table)
    silent = files.join(said.select("source_file").distinct(), "source_file", "left_anti")
    without = [r["source_file"] for r in silent.orderBy("source_file").limit(5).collect()]
    if without:
        raise ValueError(f"files of {table!r} have left no counts of their types, "
                         f"load them again: {without}")
    values = said.groupBy("column_name").agg(F.sum("n_values").alias("n")).collect()
    fits = said.select("column_name", F.explode("fits").alias("kind", "n")).groupBy(
        "column_name", "kind").agg(F.sum("n").alias("n")).collect()
    kinds: dict[str, dict[str, int]] = defaultdict(dict)
    for r in fits:
        kinds[r["column_name"]][r["kind"]] = r["n"]
    return {r["column_name"]: Evidence(r["n"], kinds[r["column_name"]]) for r in values}


def retype(spark: SparkSession, root: str, table: str, at: datetime,
           pinned: Mapping[tuple[str, str], str] | None = None) -> dict[str, tuple[str, str]]:
    """Register the narrowest type of each column that all files still held fit.

    After a roll back, a column that only the removed file had widened is narrow again. No raw
    row is read: the counts of the files are summed. Pinned types stay, and must be given as for
    the load. Returns the changed columns with their type before and after.
    """
    audit = Audit(spark, root)
    if table not in (schemas := audit.active_schemas()):
        raise MissingTable(f"no raw table {table!r}")
    version, known = schemas[table]
    said, pinned = folded(audit, table), pinned or {}
    now = {c: pinned.get((table, c)) or said.get(c, Evidence()).narrowest(UNKNOWN) for c in known}
    changed = {c: (known[c], now[c]) for c in known if now[c] != known[c]}
    if changed:
        audit.append("schema_registry", [
            (table, version + 1, schema_hash({**now, **LINEAGE_TYPES}), list(now), now, None,
             naive_utc(at))])
    return changed
