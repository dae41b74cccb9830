"""CSV drops: which files there are, what they look like, and their rows as text."""

from __future__ import annotations

import csv
import re
from collections.abc import Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.names import col
from .local import local_table

FILES_SCHEMA = "path string, source_file string, file_size bigint, modified_at timestamp"
CORRUPT = "_corrupt"
OPEN, HEADER = "::open", "::header"
# A header that is longer is none. Headers are read by so many threads.
HEADER_BYTES, HEADER_THREADS = 1 << 20, 16
RECORD_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE",
                  "columnNameOfCorruptRecord": CORRUPT}
_BLANK = "".join(map(chr, range(33)))
# A quoted field up to its closing quote; quotes inside it are doubled. Quotes
# elsewhere than at the start of a field are plain text.
TO_CLOSING_QUOTE = r'^[^"]*+(?:""[^"]*+)*+"'
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'


def missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def exact(path: str) -> str:
    """The path, for a reader that would take ``[``, ``{``, ``*``, ``?`` and the like in it for
    a pattern."""
    return re.sub(r"[\[\]{}*?\\]", lambda m: "\\" + m[0], path)


def hidden(name: str) -> bool:
    """Whether Spark's readers pass over a file of this name."""
    return name.startswith(("_", "."))


def file_name() -> Column:
    """Name of the file a row is read from; the metadata column holds it URI-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _listing(spark: SparkSession, folder: str) -> list:
    """What lies directly in a folder, if there is one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(files.listStatus(path)) if files.exists(path) else []


def folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly in a folder."""
    return [s.getPath().getName() for s in _listing(spark, folder) if s.isDirectory()]


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.csv`` directly in the folder, hidden names too; contents are not read."""
    found = []
    for status in _listing(spark, folder):
        name = status.getPath().getName()
        if name.endswith(".csv") and status.isFile():
            found.append((f"{folder.rstrip('/')}/{name}", name, status.getLen(),
                          datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc)))
    return local_table(spark, found, FILES_SCHEMA)


def text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of the files with the file name and the start of the split they are in."""
    return spark.read.text([exact(p) for p in paths]).select(
        file_name().alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"), "value")


def ends_inside(line: Column) -> Column:
    """Whether a line that starts a record ends within a quoted cell.

    If no line of a file does, no record of it spans lines.
    """
    plain = F.regexp_replace(line, f"(^|,){_QUOTED}", "$1x")
    return line.contains('"') & plain.rlike('(^|,)"')


def header_line(spark: SparkSession, path: str) -> str | None:
    """First filled line of a file, of which little more is read; None if there is none, the file
    has gone, or the line goes on beyond `HEADER_BYTES`."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        limited = jvm.org.apache.commons.io.input.BoundedInputStream(stream, HEADER_BYTES)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(limited, "UTF-8"))
        line = lines.readLine()
        while line is not None and not line.strip(_BLANK):
            line = lines.readLine()
        cut = lines.read() == -1 and files.getFileStatus(where).getLen() > HEADER_BYTES
        return None if cut else line
    finally:
        stream.close()


def headers(spark: SparkSession, files: Mapping[str, str]) -> dict[str, str]:
    """First filled line of each file, by name; files are name -> path."""
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        lines = pool.map(lambda path: header_line(spark, path), files.values())
    return {name: line for name, line in zip(files, lines) if line is not None}


def filled(line: Column) -> Column:
    """Whether a line is one that the CSV reader does not pass over."""
    return line.rlike(r"[^\x00-\x20]")


def content_ids(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Eight hex digits per file that depend on its lines and on their order.

    Each line's hash is weighted with its number in the split; the sums of splits combine, in
    the order of the splits, to those of the file, however it was split.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    lines = text_lines(spark, paths).select(
        "source_file", "block", place.alias("place"),
        F.xxhash64("value").bitwiseAND(0xFFFFFFFF).alias("hash"))
    weighted = F.col("hash").cast("decimal(10,0)") * F.col("place").cast("decimal(10,0)")
    sums = lines.groupBy("source_file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("hash").cast("decimal(10,0)")).alias("plain"),
        F.sum(weighted).alias("weighted"), F.min("place").alias("first"))
    before = (Window.partitionBy("source_file").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    offset = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    files = sums.withColumn("offset", offset.cast("decimal(12,0)")).groupBy("source_file").agg(
        F.sum("n").alias("n"), F.sum("plain").alias("plain"),
        F.sum(F.col("weighted") + F.col("plain") * F.col("offset")).alias("weighted"))
    content = F.concat_ws(":", "n", "plain", "weighted").cast("binary")
    return {r["source_file"]: r["id"] for r in files.select(
        "source_file", F.substring(F.md5(content), 1, 8).alias("id")).collect()}


def record_schema(columns: Sequence[str]) -> str:
    """Of a line parsed as a record, for ``from_csv``."""
    return ", ".join(f"`{c.replace('`', '``')}` string" for c in [*columns, CORRUPT])


def header_names(header: str | None) -> list[str]:
    """Column names in a header line."""
    if header is None:
        return []
    return next(csv.reader([header.removeprefix("\ufeff")]), [])


def parsed_lines(spark: SparkSession, headers: Collection[str], paths: Sequence[str],
                 columns: Sequence[str]) -> DataFrame:
    """Lines of files with the same columns, each parsed as a record, as `read_rows` gives them.

    Besides, `OPEN` says whether a line ends within a quoted cell, and `HEADER` whether it may be
    its file's header, for it reads like one: of those there is one per file, unless data repeat it.
    """
    cells = F.from_csv("value", record_schema(columns), RECORD_OPTIONS)
    lines = text_lines(spark, paths).where(filled(F.col("value")))
    return lines.select(
        cells.alias("row"), F.col("source_file").alias("_source_file"),
        ends_inside(F.col("value")).alias(OPEN),
        ((F.col("block") == 0) & F.col("value").isin(*headers)).alias(HEADER)).select(
        *[F.col("row").getField(c).alias(c) for c in [*columns, CORRUPT]], "_source_file",
        *[F.col(f"`{c}`") for c in (OPEN, HEADER)])


def read_rows(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of files sharing one header, every column as text.

    Rows with too few or too many cells keep their line in `CORRUPT`. Every line
    is a record; `spanning` reads files for which that does not hold.
    """
    schema = StructType([StructField(c, StringType()) for c in [*columns, CORRUPT]])
    rows = (spark.read.schema(schema)
            .option("header", True).options(**RECORD_OPTIONS)
            .csv([exact(p) for p in paths]))
    return rows.select(*map(col, columns), CORRUPT, file_name().alias("_source_file"))
