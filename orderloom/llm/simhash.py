"""Near-duplicate documents by SimHash, found through popcounts of fingerprint segments.

A fingerprint is cut into segments and mapped to the vector of their popcounts. Two
fingerprints that differ in d bits have vectors at Manhattan distance d or less, so that
distance is a lower bound. The range join on the grid of such vectors finds all pairs within
the bound: vectors at distance 2r or less meet in a cell within r of both, and each
fingerprint is entered in all cells within r of its own. Pairs that meet are then verified on
the bits themselves.

Where more fingerprints meet in one cell than ``PAIRED``, as in a large group of near copies,
their pairs are not written out: such fingerprints are linked through the bit patterns within
r bits of them, with one link per fingerprint and pattern. Fingerprints share such a pattern
exactly if they differ in 2r bits or less, so no link is lost.

Null, empty and blank texts have fingerprint zero and are linked like any other. Repeated rows
give repeated results. A group's id is its smallest doc_id; rows without doc_id take part, and
a group of only such rows has none. An empty table gives an empty result. Texts are read whole;
columns other than id and text are not looked at.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import scratch_dir
from .batches import map_texts
from .components import components

BITS = 64
# Members up to which the pairs of a cell are compared one by one.
PAIRED = 32
# Fingerprints that a task enters in the grid, 33 cells each.
ENTERED = 200_000
# Hashes summed at a time.
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """As a signed long: a bit is set if over half of the shingles' hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, size = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends, digest = ends.tolist(), xxhash.xxh64_intdigest
    count, total = len(words) - size + 1, np.zeros(BITS, np.int64)
    for at in range(0, count, _BLOCK):
        last = min(at + _BLOCK, count)
        hashes = np.fromiter((digest(line[s:e], seed) for s, e in
                              zip(starts[at:last], ends[at + size - 1:last + size - 1])),
                             "<u8", last - at)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((total * 2 > count).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(rows: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``rows`` with ``fp`` in place of their last column, the text."""
    return map_texts(rows, StructType([*rows.schema.fields[:-1], StructField("fp", LongType())]),
                     lambda texts: [[fingerprint(t, shingle, seed) for t in texts]])


def _patterns(fp: Column, flips: int) -> Column:
    """All bit patterns within ``flips`` (0 or 1) bits."""
    own = F.array(fp)
    if flips == 0:
        return own
    return F.concat(own, F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda i: fp.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))


def _cells(fp: Column, segments: int, radius: int) -> Column:
    """Grid cells within ``radius`` (0 or 1) of the popcount vector, each packed in a long."""
    width = BITS // segments
    digit = width.bit_length()
    counts = [F.bit_count(F.shiftrightunsigned(fp, width * i).bitwiseAND(
        F.lit((1 << width) - 1).cast("long"))) for i in range(segments)]
    packed = sum((F.shiftleft(c.cast("long"), digit * i) for i, c in enumerate(counts)),
                 F.lit(0).cast("long"))
    if radius == 0:
        return F.array(packed)
    near = []
    for i, c in enumerate(counts):
        step = F.lit(1 << (digit * i)).cast("long")
        near += [F.when(c < width, packed + step), F.when(c > 0, packed - step)]
    return F.filter(F.array(packed, *near), lambda cell: cell.isNotNull())


def links(spark: SparkSession, fps: DataFrame, max_bits: int = 2, segments: int = 16) -> DataFrame:
    """Links (u, v) that connect all distinct ``fp`` at ``max_bits`` (0 to 2) or fewer bits."""
    if not 0 <= max_bits <= 2 or segments not in (16, 8, 4):
        raise ValueError("max_bits is 0 to 2, segments 4, 8 or 16")
    radius = (max_bits + 1) // 2
    # By what they grow to: stored, distinct fingerprints are few bytes in fewer tasks.
    tasks = max(spark.sparkContext.defaultParallelism, -(-fps.count() // ENTERED))
    entered = fps.repartition(tasks, "fp").select(
        "fp", F.explode(_cells(F.col("fp"), segments, radius)).alias("cell"))
    base = scratch_dir(spark, "simhash-cells")
    met = entered.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met.write.parquet(f"{base}/met")
    met = spark.read.parquet(f"{base}/met")
    entered.join(met, "cell").write.parquet(f"{base}/entered")
    entered = spark.read.parquet(f"{base}/entered")

    def differing(a: str, b: str) -> Column:
        return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))

    few = entered.where(F.col("n") <= PAIRED).select("cell", F.col("fp").alias("u"))
    paired = few.join(few.withColumnRenamed("u", "v"), "cell").where(
        (F.col("u") > F.col("v")) & (differing("u", "v") <= max_bits)).select("u", "v")
    crowded = entered.where(F.col("n") > PAIRED).select("fp").distinct()
    shared = crowded.select("fp", F.explode(_patterns(F.col("fp"), radius)).alias("pattern"))
    least = shared.groupBy("pattern").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n"))
    starred = shared.join(least.where("n > 1"), "pattern").select(F.col("fp").alias("u"), "v")
    if max_bits == 1:
        # Patterns within one bit of both also join fingerprints two bits apart.
        starred = crowded.select(F.col("fp").alias("u"),
                                 F.explode(_patterns(F.col("fp"), 1)).alias("v")).join(
            crowded.select(F.col("fp").alias("v")), "v", "left_semi").select("u", "v")
    return paired.unionByName(starred.where("u <> v"))


def groups(spark: SparkSession, rows: DataFrame, max_bits: int = 2, segments: int = 16
           ) -> DataFrame:
    """(fp, root): for each distinct fingerprint of ``rows``, one that stands for its group."""
    path = f"{scratch_dir(spark, 'simhash')}/distinct"
    rows.select("fp").distinct().write.parquet(path)
    distinct = spark.read.parquet(path)
    roots = components(spark, links(spark, distinct, max_bits, segments))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def simhash_groups(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                   seed: int = 42, segments: int = 16, id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``; fingerprint is 16 hex digits."""
    path = f"{scratch_dir(spark, 'simhash')}/rows"
    fingerprints(docs.select(F.col(id_column).cast("long").alias("doc_id"), text_column),
                 shingle, seed).write.parquet(path)
    rows = spark.read.parquet(path)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = groups(spark, rows, max_bits, segments).join(least, "fp")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id")).join(
        rooted.select("fp", "root"), "root")
    return rows.join(named.select("fp", "component_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
