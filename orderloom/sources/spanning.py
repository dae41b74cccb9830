"""CSV files whose quoted cells hold line breaks, each read by many tasks.

Spark's reader gives such a file to one task and rewrites the breaks. Here its lines are read in splits,
numbered by the record they belong to, and only the lines of longer records are
put together. Whether a line starts inside a quoted cell follows from the lines
before it: each either keeps that state, swaps it, or ends in the same state
whatever came before. So one row per split is enough to carry it along a file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .landing import (CORRUPT, RECORD_OPTIONS, TO_CLOSING_QUOTE, ends_inside, exact, file_name,
                      record_schema)


def _inside_after(line: Column) -> Column:
    """Whether a line that starts within a quoted cell also ends within one."""
    rest = F.regexp_replace(line, TO_CLOSING_QUOTE, "x")
    return ~line.rlike(TO_CLOSING_QUOTE) | ends_inside(rest)


def _carry(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Add what `_state` needs to tell the state before each row.

    A row's ``from_out`` and ``from_in`` are the states it ends in. Where they are
    equal the row fixes the state; else ``from_out`` says whether it swaps it.
    """
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    fixes = F.col("from_out") == F.col("from_in")
    swaps = F.when(fixes, 0).otherwise(F.col("from_out"))
    swapped = rows.withColumn("swapped", F.coalesce(F.sum(swaps).over(before), F.lit(0)))
    mark = F.when(fixes, F.col("from_out") - F.col("swapped"))
    return swapped.withColumn("mark", F.last(mark, ignorenulls=True).over(before))


def _state(start: Column) -> Column:
    """1 within a quoted cell, else 0, given the state before the first row."""
    return F.pmod(F.coalesce("mark", start) + F.col("swapped"), F.lit(2))


def _numbered_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with the number of their record in the file; blank lines between records go.

    Each window over lines covers one split, so its size is that of a split; the
    windows over a whole file see one row per split.
    """
    text = F.col("value")
    lines = spark.read.option("lineSep", "\n").text([exact(p) for p in paths]).select(
        file_name().alias("_source_file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.rtrim(text, F.lit("\r")).alias("bare"), "value").select(
        "_source_file", "block", "at", "value", (F.trim("bare") != "").alias("filled"),
        ends_inside(F.col("bare")).cast("int").alias("from_out"),
        _inside_after(F.col("bare")).cast("int").alias("from_in"))
    carried = _carry(lines, ["_source_file", "block"], "at")

    out, inside = F.lit(0), F.lit(1)

    def after(start: Column) -> Column:
        return F.when(_state(start) == 0, F.col("from_out")).otherwise(F.col("from_in"))

    splits = carried.groupBy("_source_file", "block").agg(
        F.max(F.struct("at", after(out).alias("from_out"), after(inside).alias("from_in")))
        .alias("end"),
        F.count_if(F.col("filled") & (_state(out) == 0)).alias("starts_from_out"),
        F.count_if(F.col("filled") & (_state(inside) == 0)).alias("starts_from_in"))
    in_file = (Window.partitionBy("_source_file").orderBy("block")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (_carry(splits.select("*", "end.from_out", "end.from_in"),
                      ["_source_file"], "block")
               .withColumn("start", _state(out))
               .withColumn("starts_here", F.when(F.col("start") == 0, F.col("starts_from_out"))
                           .otherwise(F.col("starts_from_in")))
               .select("_source_file", "block", "start",
                       F.coalesce(F.sum("starts_here").over(in_file), F.lit(0)).alias("offset")))

    outside = _state(F.col("start")) == 0
    starts = outside & F.col("filled")
    until_here = (Window.partitionBy("_source_file", "block").orderBy("at")
                  .rowsBetween(Window.unboundedPreceding, 0))
    return (carried.join(offsets, ["_source_file", "block"])
            .where(starts | ~outside)
            .withColumn("record", F.col("offset") + F.count_if(starts).over(until_here))
            .select("_source_file", "record", "block", "at", "value",
                    (starts & (F.col("from_out") == 0)).alias("whole"),
                    (F.when(outside, F.col("from_out")).otherwise(F.col("from_in")) == 1)
                    .alias("open")))


def _records(lines: DataFrame) -> DataFrame:
    """Whole lines as they are; the lines of longer records joined, in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))),
                        lambda part: part["value"])
    longer = (lines.where(~F.col("whole")).groupBy("_source_file", "record")
              .agg(F.array_join(parts, "\n").alias("value")))
    return (lines.where("whole").select("_source_file", "record", "value").unionByName(longer)
            .withColumn("value", F.rtrim("value", F.lit("\r"))))


def store_lines(spark: SparkSession, paths: Sequence[str], folder: str) -> DataFrame:
    """The files' lines by record, kept in a table so that they are numbered once."""
    _numbered_lines(spark, paths).write.parquet(folder)
    return spark.read.parquet(folder)


def unclosed_files(lines: DataFrame) -> set[str]:
    """Files that end within a quoted cell: a quote in them is never closed.

    Such a file is not read, so the rest of it is never put together as one record.
    """
    last = lines.groupBy("_source_file").agg(
        F.max(F.struct("block", "at", "open")).getField("open").alias("open"))
    return {r["_source_file"] for r in last.where("open").collect()}


def header_lengths(lines: DataFrame) -> dict[str, int]:
    """Characters in the first record of each file, which is its header."""
    text = F.ltrim(F.rtrim("value", F.lit("\r")), F.lit("\ufeff"))
    first = (lines.where(F.col("record") == 1).groupBy("_source_file")
             .agg(F.sum(F.length(text)).alias("chars")))
    return {r["_source_file"]: r["chars"] for r in first.collect()}


def read_spanning(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of files that close their quotes, as `landing.read_rows` gives them."""
    parsed = F.from_csv("value", record_schema(columns), RECORD_OPTIONS)
    return (_records(lines).where(F.col("record") > 1)
            .select(parsed.alias("row"), "_source_file")
            .select(*[F.col("row").getField(c).alias(c) for c in [*columns, CORRUPT]],
                    "_source_file"))
