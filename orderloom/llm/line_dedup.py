"""Boilerplate lines by their frequency within a site.

A line is boilerplate on a site if more than ``max_ratio`` of the site's pages have it. The ratio
decides at all sizes: ``min_pages`` is 2, which only says that a line has to repeat, so that the
single pages of small sites stay. Every occurrence there is dropped; the same line stays on sites
where it is rare. Lines are compared without white space at their ends, and blank ones are left
alone.

A page counts a line once. Counting is per site and line with a map-side phase, so a hot site
or line sends one row per task. A site has at most (distinct lines per page, on average) /
``max_ratio`` boilerplate lines; they are kept as one array of 16-byte digests per site, written
out, and joined to the pages by site: the texts are shuffled only if that table is too large to
broadcast, and a site's lines are never gathered otherwise.

A NULL site is a site of its own. A NULL text has no lines and stays NULL; an empty one has one
blank line. A page of nothing but boilerplate becomes empty and is kept. Repeated rows are pages
like others. An empty table gives an empty result. Other columns pass through unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_dir
from .batches import fresh


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _digest(line: Column) -> Column:
    """16 bytes for a line; NULL for a blank one."""
    line = F.trim(line, F.lit(" \t\r"))
    return F.when(line != "", F.unhex(F.md5(line)))


def _site(site: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), site.cast("string")), F.lit(""))


def boilerplate(spark: SparkSession, pages: DataFrame, site: str, text: str = "text",
                max_ratio: float = 0.02, min_pages: int = 2) -> DataFrame:
    """(site_key, lines): digests of the boilerplate lines of each site that has any."""
    rows = pages.select(_site(F.col(site)).alias("site_key"), F.col(text).alias("text"))
    totals = rows.groupBy("site_key").agg(F.count(F.lit(1)).alias("pages"))
    path = scratch_dir(spark, "line-dedup")
    common = rows.select("site_key", F.explode(F.array_distinct(F.transform(
        _lines(F.col("text")), _digest))).alias("line")).where(F.col("line").isNotNull()).groupBy(
        "site_key", "line").agg(F.count(F.lit(1)).alias("having")).where(
        F.col("having") >= min_pages)
    common.join(totals, "site_key").where(
        F.col("having") > F.col("pages") * F.lit(float(max_ratio))).groupBy("site_key").agg(
        F.collect_list("line").alias("lines")).write.parquet(path)
    return spark.read.schema("site_key string, lines array<binary>").parquet(path)


def drop_boilerplate(spark: SparkSession, pages: DataFrame, site: str, text: str = "text",
                     max_ratio: float = 0.02, min_pages: int = 2,
                     n_lines: str | None = None, n_dropped: str | None = None) -> DataFrame:
    """``pages`` with boilerplate lines taken out of ``text``. Named columns for the number of
    lines before, and of those dropped, are added."""
    found = boilerplate(spark, pages, site, text, max_ratio, min_pages)
    key, lines = fresh(pages, "site_key"), fresh(pages, "lines")
    found = found.select(F.col("site_key").alias(key), F.col("lines").alias(lines))
    joined = pages.withColumn(key, _site(F.col(site))).join(found, key, "left")
    own = _lines(F.col(text))
    has = F.arrays_overlap(F.transform(own, _digest), F.col(lines))
    cleaned = fresh(joined, "cleaned")
    joined = joined.withColumn(cleaned, F.when(has, F.filter(
        own, lambda l: ~F.coalesce(F.array_contains(F.col(lines), _digest(l)), F.lit(False)))
    ).otherwise(own))
    added = {}
    if n_lines:
        added[n_lines] = F.coalesce(F.size(own), F.lit(0)).cast("long")
    if n_dropped:
        added[n_dropped] = F.coalesce(F.size(own) - F.size(cleaned), F.lit(0)).cast("long")
    return joined.select(
        *[F.array_join(cleaned, "\n").alias(c) if c == text else F.col(c) for c in pages.columns],
        *[c.alias(n) for n, c in added.items()])
