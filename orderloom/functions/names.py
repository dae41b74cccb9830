"""Expressions over file and column names."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# The substrings that mark a column as date-like.
DATE_WORDS = ("date", "time", "_at", "timestamp")


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


# White space that does not count at the ends of a name.
_EDGES = " \t\r\n\x0b\x0c"


def normalise_name(name: Column) -> Column:
    """Trim, lower-case, and turn spaces into underscores."""
    return F.translate(F.lower(F.trim(name, F.lit(_EDGES))), " ", "_")


def normalise_header(spark: SparkSession, names: list[str]) -> list[str]:
    """`normalise_name` for the names in one header line; no job runs."""
    if not names:
        return []
    row = spark.sql("VALUES (1)").select(F.array(*[normalise_name(F.lit(n)) for n in names]))
    return list(row.first()[0])


def file_stem(file_name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name, r"(?<=.)\.[^.]*$", "")


def target_table(file_name: Column) -> Column:
    """Table a file belongs to: dated names collapse to the text before the first `_`."""
    stem = F.lower(file_stem(file_name))
    dated = stem.contains("_") & stem.rlike("[0-9]")
    return F.when(dated, F.split_part(stem, F.lit("_"), F.lit(1))).otherwise(stem)


def batch_id(file_name: Column) -> Column:
    """First eight hex digits of the md5 of the file name."""
    return F.substring(F.md5(file_name.cast("binary")), 1, 8)


def looks_like_date(name: str) -> bool:
    return any(word in name.lower() for word in DATE_WORDS)
