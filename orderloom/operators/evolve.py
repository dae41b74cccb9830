"""Additive schema evolution."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

LINEAGE = ("_ingested_at", "_source_file", "_batch_id")

# Types a column may turn into without rejecting the file: stored text is unchanged.
WIDENS = {("bigint", "double"): "double", ("timestamp_ntz", "date_text"): "date_text"}


@dataclass(frozen=True)
class Drift:
    """What a new schema changes against a table; columns stay in file order."""

    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    type_changes: list[tuple[str, str, str]] = field(default_factory=list)


def detect_drift(existing: dict[str, str], incoming: dict[str, str]) -> Drift:
    """Added, removed and retyped business columns; lineage columns are ignored."""
    old = {c: t for c, t in existing.items() if c not in LINEAGE}
    new = {c: t for c, t in incoming.items() if c not in LINEAGE}
    if not old:
        return Drift()
    return Drift(
        added=[c for c in new if c not in old],
        removed=[c for c in old if c not in new],
        type_changes=[(c, old[c], t) for c, t in new.items() if c in old and old[c] != t],
    )


def schema_hash(columns: dict[str, str]) -> str:
    """Eight hex digits naming an ordered list of columns and types."""
    digest = hashlib.md5()
    for pair in columns.items():
        digest.update("\x1f".join(pair).encode() + b"\x1e")
    return digest.hexdigest()[:8]


def evolve_union(table: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of both, by column name; a column one side lacks is NULL there."""
    return table.unionByName(incoming, allowMissingColumns=True)
