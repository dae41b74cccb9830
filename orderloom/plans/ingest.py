"""Load new CSV drops: profile, type, accept or quarantine, store, log."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from ..functions.names import batch_id, col, looks_like_date, normalise_header, target_table
from ..functions.values import DOUBLE, UNKNOWN, is_exact_amount, naive_utc
from ..operators.clean import apply_null_tokens, drop_all_null, type_classes, type_counts
from ..operators.evidence import DATE_TEXT, Evidence
from ..operators.evolve import LINEAGE, WIDENS, detect_drift, schema_hash
from ..operators.keys import duplicate_rows
from ..session import WIDE_QUERY, scratch_dir, settings
from ..sources.audit import Audit
from ..sources.landing import (CORRUPT, HEADER, OPEN, content_ids, header_names, headers, hidden,
                               list_files, parsed_lines, read_rows, text_lines)
from ..sources.local import local_table
from ..sources.raw import clear_files, read_text, write_raw
from ..sources.spanning import header_lengths, read_spanning, store_lines, unclosed_files
from .operations import pending_files

TABLE_THREADS = 4
# Beginnings of the names Spark gives to errors that lie in the data it reads. Others,
# as of writing, of storage or of memory, are no fault of a file.
DATA_ERRORS = ("ARITHMETIC_OVERFLOW", "CANNOT_PARSE", "CAST_", "DATETIME_OVERFLOW", "DIVIDE_BY_ZERO",
               "INVALID_UTF8_STRING", "MALFORMED_CSV_RECORD", "MALFORMED_RECORD",
               "NUMERIC_VALUE_OUT_OF_RANGE", "NUMERIC_OUT_OF_SUPPORTED_RANGE")
LINEAGE_TYPES = {"_ingested_at": "timestamp_ntz", "_source_file": "string", "_batch_id": "string"}


@dataclass(frozen=True)
class IngestOptions:
    """What a load may be told; the defaults match the described behaviour."""

    # File-name prefix -> table, ahead of the naming rule; the longest prefix counts.
    tables: Mapping[str, str] = field(default_factory=dict)
    # (table, column) -> type, ahead of inference.
    pinned_types: Mapping[tuple[str, str], str] = field(default_factory=dict)
    # (table, column) pairs whose missing-value tokens are real values.
    keep_tokens: frozenset[tuple[str, str]] = frozenset()
    # table -> whether records may span lines; where not given, a pass over the text tells.
    spanning: Mapping[str, bool] = field(default_factory=dict)
    # Columns whose amounts are summed exactly; a file with one too long for that is not loaded.
    amounts: frozenset[str] = frozenset(("price", "freight_value", "payment_value"))
    # Batch id from the file's name, or from its content.
    batch_from_content: bool = False
    # Count surplus copies of rows per file; costs a shuffle.
    count_duplicates: bool = False


@dataclass
class _File:
    path: str
    name: str
    size: int
    table: str
    batch: str
    header: str | None
    columns: list[str]
    # Whether records span lines; None until the lines have been looked at.
    spanning: bool | None
    stats: Row | None = None
    copies: int | None = None
    error: str | None = None
    removed: list[str] = field(default_factory=list)
    promoted: list[str] = field(default_factory=list)
    schema_hash: str | None = None
    notes: str = ""

    @property
    def read(self) -> int:
        return self.stats["rows_read"] if self.stats else 0

    @property
    def loaded(self) -> int:
        return 0 if self.error else self.read - self.stats["rows_blank"]


def ingest(spark: SparkSession, landing: str, root: str, run_ts: datetime,
           options: IngestOptions = IngestOptions()) -> DataFrame:
    """Load every new file of a folder and return one status row per file.

    Only names, headers and per-file counts reach the driver. A file is logged
    after its rows are stored and storing replaces, so a run that dies half way
    is simply repeated.
    """
    run_ts = naive_utc(run_ts)
    audit = Audit(spark, root)
    audit.ensure()
    files = _new_files(spark, audit, landing, options)
    _announce(audit, files, run_ts)
    by_table: dict[str, list[_File]] = defaultdict(list)
    for file in sorted(files, key=lambda f: f.name):
        by_table[file.table].append(file)

    load = _Load(spark, audit, root, run_ts, options)
    with settings(spark, WIDE_QUERY), ThreadPoolExecutor(TABLE_THREADS) as pool:
        registered = [row for rows in pool.map(load.table, by_table.values()) for row in rows]
    load.quarantine_failed(files)
    failed = {f.name for f in files if f.error}
    registered = [row for row in registered if row[5] not in failed]
    if registered:
        audit.append("schema_registry", registered)
    said = [row for f in files if not f.error for row in load.evidence_rows(f)]
    if said:
        audit.append("type_evidence", said)
    log = [load.log_row(f) for f in files]
    if log:
        audit.append("ingestion_log", log)
    return audit.read("ingestion_log").where(F.col("ingested_at") == _ntz(run_ts))


def _announce(audit: Audit, files: list[_File], run_ts: datetime) -> None:
    """Note that files are about to be stored, after taking away what runs of other days that
    died between storing and logging have left of them."""
    if not files:
        return
    today = run_ts.date().isoformat()
    left: dict[str, list[Row]] = defaultdict(list)
    for row in audit.left_behind((f.name for f in files), today):
        left[row["table_name"]].append(row)
    for table, rows in left.items():
        clear_files(audit.spark, audit.root, table, audit.table_columns(table) or [],
                    {r["source_file"] for r in rows}, {r["loaded_on"] for r in rows})
    audit.append("load_attempts", [(f.table, f.name, today) for f in files])


def _ntz(ts: datetime) -> Column:
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def _new_files(spark: SparkSession, audit: Audit, landing: str,
               options: IngestOptions) -> list[_File]:
    name = F.col("source_file")
    table = target_table(name)
    for prefix, target in sorted(options.tables.items(), key=lambda pair: len(pair[0])):
        table = F.when(name.startswith(prefix), target).otherwise(table)
    pending = (pending_files(list_files(spark, landing), audit.processed())
               .select("*", table.alias("table_name"), batch_id(name).alias("name_id")).collect())
    if not pending:
        return []
    first_lines = headers(spark, {p["source_file"]: p["path"] for p in pending
                                  if p["file_size"] and not hidden(p["source_file"])})
    ids = content_ids(spark, [p["path"] for p in pending if p["source_file"] in first_lines]) \
        if options.batch_from_content and first_lines else {}
    return [_describe(spark, p, first_lines.get(p["source_file"]), ids.get(p["source_file"]),
                      options) for p in pending]


def _describe(spark: SparkSession, listed: Row, header: str | None, content: str | None,
              options: IngestOptions) -> _File:
    names = normalise_header(spark, header_names(header))
    table = listed["table_name"]
    file = _File(
        path=listed["path"], name=listed["source_file"], size=listed["file_size"], table=table,
        batch=content or listed["name_id"], header=header, columns=names,
        spanning=options.spanning.get(table))
    reserved = [n for n in names if n in (*LINEAGE, CORRUPT)]
    if hidden(file.name):
        file.error = "names that start with _ or . are hidden from Spark's readers"
    elif not names:
        file.error = "no header"
    elif not all(names):
        file.error = "header has an empty column name"
    elif len(set(names)) < len(names):
        file.error = f"column names collide: {sorted({n for n in names if names.count(n) > 1})}"
    elif reserved:
        file.error = f"reserved column names: {reserved}"
    return file


def _lies_in_data(error: PySparkException) -> bool:
    condition = error.getCondition() or ""
    return isinstance(error, AnalysisException) or condition.startswith(DATA_ERRORS)


class _Load:
    """One run's work on each table."""

    def __init__(self, spark: SparkSession, audit: Audit, root: str, run_ts: datetime,
                 options: IngestOptions):
        self.spark, self.audit, self.root = spark, audit, root
        self.run_ts, self.options = run_ts, options
        self.schemas = audit.active_schemas()
        self.lines: dict[str, DataFrame] = {}

    def table(self, files: list[_File]) -> list[tuple]:
        """Load one table's files; returns its new registry rows."""
        readable = [f for f in files if not f.error]
        for group in self._groups([f for f in readable if f.spanning is None]):
            self._attempt(self._look, group)
        spanning = [f for f in readable if f.spanning and not f.error]
        if spanning:
            self._attempt(self._join_lines, spanning)
        for group in self._groups([f for f in readable if not f.error and not f.stats]):
            self._attempt(self._measure, group)
        registered = self._decide(readable)
        for group in self._groups([f for f in readable if not f.error]):
            self._attempt(self._store, group)
        return registered

    @staticmethod
    def _groups(files: list[_File]) -> list[list[_File]]:
        """Files that can be read together."""
        groups: dict[tuple, list[_File]] = defaultdict(list)
        for file in files:
            groups[(tuple(file.columns), file.spanning)].append(file)
        return list(groups.values())

    def _join_lines(self, files: list[_File]) -> None:
        """Number the lines of files whose records span lines."""
        folder = scratch_dir(self.spark, "lines", f"{self.root}/work")
        lines = store_lines(self.spark, [f.path for f in files], folder)
        unclosed, first = unclosed_files(lines), header_lengths(lines)
        for file in files:
            self.lines[file.name] = lines
            if file.name in unclosed:
                file.error = "the file ends within a quoted cell"
            elif first.get(file.name) != len(file.header.removeprefix("\ufeff")):
                file.error = "the first record is not the first line"

    def _attempt(self, work: Callable[[list[_File]], None], files: list[_File]) -> None:
        """Do a group at once; if its data fail, by halves, to fail only the bad files.

        That are errors of `DATA_ERRORS`, and names that Spark does not take. Anything else, as a
        lost executor or a full disk, is no fault of a file and ends the run.
        """
        try:
            work(files)
        except PySparkException as error:
            if not _lies_in_data(error):
                raise
            if len(files) > 1:
                half = len(files) // 2
                self._attempt(work, files[:half])
                self._attempt(work, files[half:])
            else:
                files[0].error = f"{type(error).__name__}: {error}"

    def _rows(self, files: list[_File]) -> DataFrame:
        first = files[0]
        if first.spanning:
            names = defaultdict(list)
            for file in files:
                names[id(self.lines[file.name])].append(file.name)
            lines = reduce(DataFrame.unionByName, [
                self.lines[group[0]].where(F.col("_source_file").isin(group))
                for group in names.values()])
            rows = read_spanning(lines, first.columns)
        else:
            rows = read_rows(self.spark, [f.path for f in files], first.columns)
        return self._with_nulls(rows, first)

    def _with_nulls(self, rows: DataFrame, first: _File) -> DataFrame:
        keep = {c for t, c in self.options.keep_tokens if t == first.table}
        return apply_null_tokens(rows, first.columns, keep)

    def _look(self, files: list[_File]) -> None:
        """Measure files as if every line were a record, and see whether that holds.

        The same pass over the lines does both. A file with a line that ends within a quoted
        cell is read by records instead, and one whose data repeat the header by the CSV reader.
        """
        rows = self._with_nulls(parsed_lines(
            self.spark, {f.header for f in files}, [f.path for f in files], files[0].columns),
            files[0])
        found = self._counts(files[0], rows, is_header=F.col(f"`{HEADER}`"), extra=[
            F.count_if(F.col(f"`{c}`")).alias(c) for c in (OPEN, HEADER)])
        for file in files:
            stats = found.get(file.name)
            file.spanning = bool(stats and stats[OPEN])
        self._take([f for f in files if not f.spanning and f.name in found
                    and found[f.name][HEADER] == 1], found)

    def _measure(self, files: list[_File]) -> None:
        """Measure files, whose records are known by now."""
        self._take(files, self._counts(files[0], self._rows(files)))

    def _take(self, files: list[_File], found: dict[str, Row]) -> None:
        empty = Row("rows_read", "rows_blank", "rows_corrupt")(0, 0, 0)
        for file in files:
            file.stats = found.get(file.name, empty)
            if file.stats["rows_corrupt"]:
                file.error = f"{file.stats['rows_corrupt']} rows do not match the header"
        if self.options.count_duplicates and files:
            surplus = duplicate_rows(self._rows(files).drop(CORRUPT), ["_source_file"]).collect()
            copies = {r["_source_file"]: r["n_duplicates"] for r in surplus}
            for file in files:
                file.copies = copies.get(file.name, 0)

    def _counts(self, first: _File, rows: DataFrame, is_header: Column | None = None,
                extra: Sequence[Column] = ()) -> dict[str, Row]:
        """Row, blank, corrupt and type counts per file, from one aggregation."""
        columns, is_header = first.columns, F.lit(False) if is_header is None else is_header
        named = [c for c in rows.columns if c not in (*columns, CORRUPT)]
        rows = rows.select(*[F.when(~is_header, col(c)).alias(c) for c in columns],
                           *named, (F.col(CORRUPT).isNotNull() & ~is_header).alias("::corrupt"),
                           (~is_header).alias("::row"))
        blank = F.coalesce(*[col(c) for c in columns]).isNull()
        pinned = {c for (t, c), kind in self.options.pinned_types.items()
                  if t == first.table and kind == "date_text"}
        dated = [c for c in columns if looks_like_date(c) or c in pinned]
        amounts = [c for c in columns if c in self.options.amounts]
        cells = rows.select(*[F.col(f"`{c}`") for c in [*named, "::corrupt", "::row"]],
                            blank.alias("::blank"), *type_classes(columns, dated), *[
            (col(c).rlike(DOUBLE) & ~is_exact_amount(col(c))).alias(f"{c}::not_amount")
            for c in amounts])
        stats = cells.groupBy("_source_file").agg(
            F.count_if(col("::row")).alias("rows_read"),
            F.count_if(col("::row") & col("::blank") & ~col("::corrupt")).alias("rows_blank"),
            F.count_if(col("::corrupt")).alias("rows_corrupt"),
            *type_counts(columns, dated),
            *[F.count_if(col(f"{c}::not_amount")).alias(f"{c}::not_amount") for c in amounts],
            *extra)
        return {r["_source_file"]: r for r in stats.collect()}

    def _decide(self, files: list[_File]) -> list[tuple]:
        """Check each file against the table's types, in file order, and evolve them."""
        registered = []
        for file in files:
            if file.error:
                continue
            version, known = self.schemas.get(file.table, (0, {}))
            found, file.error = self._column_types(file, known)
            if file.error:
                continue
            drift = detect_drift(known, found)
            file.removed = drift.removed
            file.notes = "; ".join(
                f"{what}: {names}" for what, names in (
                    ("added", drift.added), ("removed", drift.removed),
                    ("retyped", [f"{c} {old} -> {new}" for c, old, new in drift.type_changes]))
                if names)
            file.promoted = [c for c, t in found.items()
                             if t == DATE_TEXT or (t == "timestamp_ntz" and looks_like_date(c))]
            merged = {**known, **found}
            file.schema_hash = schema_hash({**merged, **LINEAGE_TYPES})
            if merged != known:
                self.schemas[file.table] = (version + 1, merged)
                registered.append((file.table, version + 1, file.schema_hash, list(merged),
                                   merged, file.name, self.run_ts))
        return registered

    def _column_types(self, file: _File, known: dict[str, str]) -> tuple[dict, str | None]:
        """Type of each column after this file, or why the file does not fit."""
        found = {}
        for c in file.columns:
            pinned = self.options.pinned_types.get((file.table, c))
            # Only dated columns are counted against the looser date forms.
            said = Evidence.of(file.stats, c)
            n, fitting, narrowest = said.n_values, said.fitting(), said.narrowest(UNKNOWN)
            current = known.get(c, UNKNOWN)
            if pinned:
                found[c] = pinned
                if pinned != "string" and n and pinned not in fitting:
                    return {}, f"type conflict: {c} is pinned as {pinned}"
            elif n and c in self.options.amounts and file.stats[f"{c}::not_amount"]:
                return {}, f"{c} holds {file.stats[f'{c}::not_amount']} amounts that have too many digits"
            elif current == UNKNOWN:
                found[c] = narrowest
            elif n == 0 or current == "string" or current in fitting:
                found[c] = current
            elif (current, narrowest) in WIDENS:
                found[c] = WIDENS[(current, narrowest)]
            else:
                return {}, f"type conflict: {c} is {current}, file has {narrowest}"
        return found, None

    def _store(self, files: list[_File]) -> None:
        if not files:
            return
        first = files[0]
        rows = drop_all_null(self._rows(files).drop(CORRUPT), first.columns)
        stored = rows.select(*map(col, first.columns), _ntz(self.run_ts).alias("_ingested_at"),
                             self._batch(files).alias("_batch_id"), "_source_file")
        write_raw(stored, self.root, first.table)
        shrunk = [f for f in files if f.removed]
        if shrunk:
            self._quarantine_shrunk(shrunk)

    def _batch(self, files: list[_File]) -> Column:
        if not self.options.batch_from_content:
            return batch_id(F.col("_source_file"))
        pairs = [F.lit(x) for f in files for x in (f.name, f.batch)]
        return F.create_map(*pairs)[F.col("_source_file")]

    def _put_aside(self, rows: DataFrame, files: list[_File], reasons: list[str]) -> None:
        """Quarantine the ``record`` texts of some files, each file for its reason."""
        why = local_table(
            self.spark, [(f.name, f.table, f.batch, r) for f, r in zip(files, reasons)],
            "source_file string, table_name string, batch_id string, reason string")
        self.audit.quarantine(rows.join(why, "source_file").select(
            "table_name", "batch_id", "reason", "record",
            _ntz(self.run_ts).alias("quarantined_at"),
            F.lit(self.run_ts.strftime("%Y%m%dT%H%M%S%f")).alias("run_id"), "source_file"))

    def _quarantine_shrunk(self, files: list[_File]) -> None:
        """Copy the stored rows of files that lack known columns, which are NULL in them."""
        _, columns = self.schemas[files[0].table]
        stored = read_text(self.spark, self.root, files[0].table, list(columns),
                           days=[self.run_ts.date().isoformat()])
        record = F.to_json(F.struct(*map(col, columns)), {"ignoreNullFields": "false"})
        rows = stored.where(F.col("_source_file").isin([f.name for f in files])).select(
            F.col("_source_file").alias("source_file"), record.alias("record"))
        self._put_aside(rows, files, [f"columns removed: {f.removed}" for f in files])

    def quarantine_failed(self, files: list[_File]) -> None:
        """Put every line of the failed files aside, in one job."""
        failed = [f for f in files if f.error and not hidden(f.name)]
        if failed:
            lines = text_lines(self.spark, [f.path for f in failed])
            self._put_aside(lines.select("source_file", F.col("value").alias("record")),
                            failed, [f.error for f in failed])

    def evidence_rows(self, file: _File) -> list[tuple]:
        """What a file says of its columns, kept for later decisions."""
        said = {c: Evidence.of(file.stats, c) for c in file.columns}
        return [(file.table, file.name, c, e.n_values, dict(e.fits), self.run_ts)
                for c, e in said.items()]

    def log_row(self, file: _File) -> tuple:
        return (file.table, file.batch, file.schema_hash, file.name, file.size, file.read,
                file.loaded, file.read - file.loaded, file.copies, file.promoted,
                "FAILED" if file.error else "SUCCESS", file.error or file.notes, self.run_ts)
