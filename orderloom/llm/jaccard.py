"""Documents linked by the Jaccard similarity of their shingle sets, through count vectors.

A document's set is that of its distinct shingles, as 64-bit hashes. Hashes are dealt into
groups, and a set becomes the point of its counts per group. Two sets share at most the summed
minima of their points. Points are held in an R-tree, and pairs that its boxes and then the
points leave are verified on the hashes themselves.

*Directory.* One tree over all points would prune little, since each coordinate carries but a
small part of a distance. So its upper level are cells of sub-vectors at the finest grouping.
Sets of at most n shingles that are similar enough differ in a bounded number d of shingles;
with hashes in d + 1 ranges, one range at least holds the same in both. Each set is entered in
one cell per range, by the sum of its hashes there. n goes in steps of half its size, and sets
near the end of a step are entered for the next one too, so each similar pair meets in a cell.

*Cells.* Equal sets are one member. First every member is compared with its cell's first one
and the found links are followed to components. Pairs already connected need no test, so a large
group of near copies costs one test per member and cell. Cells that hold several components
are searched whole: up to ``BLOCK`` members by one tree, above that in blocks, large components
in blocks of their own. Pairs of blocks are pruned by their boxes, then joined as trees. A cell
of m unlike members costs (m / BLOCK)^2 such joins at most, each of bounded size; nothing is
left out.

Texts are read whole; A to Z are lower-cased and words are runs of other than ASCII white space.
Texts with fewer words than a shingle have the whole sequence as their one. Null, empty and
blank texts have an empty set, and are linked with nothing: each is its own component. Repeated
rows give repeated results. A component's id is its smallest doc_id; rows without doc_id take
part, and a component of only such rows has none. An empty table gives an empty result. Columns
other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StructField,
                               StructType)

from ..session import scratch_dir
from .batches import map_texts
from .components import components
from .count_tree import CountTree

GROUPS = 64
# Members of a cell that one tree holds, and entries that one task searches at a time.
BLOCK, ENTRIES = 512, 20_000
# Bits that tell texts to be read again from most others.
SIEVE = 1 << 22
_GOLD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def shingles(text: str | None, size: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line, size = b" ".join(words), min(size, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter(
        (digest(line[s:e]) for s, e in zip(starts, ends[size - 1:].tolist())),
        np.uint64, len(words) - size + 1))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX
    return (values ^ (values >> np.uint64(27))) * _GOLD


def steps(size: int, percent: int) -> list[tuple[int, int]]:
    """(step, ranges) that a set of ``size`` is entered for."""
    found, step, start = [], 0, 1
    while True:
        end = start + (start + 1) // 2
        # The most by which sets below ``end`` that are similar enough differ.
        differing = 2 * (end - 1) * (100 - percent) // (100 + percent)
        if start <= size < end or (size < start and 100 * size >= percent * start):
            if differing:
                found.append((step, differing + 1))
        if size < start and 100 * size < percent * start:
            return found
        step, start = step + 1, end


def cells(hashes: np.ndarray, percent: int) -> np.ndarray:
    """One cell per step and range, from the hashes that the set has in that range."""
    made = [np.zeros(0, np.uint64)]
    scrambled = _mixed(hashes)
    for step, ranges in steps(len(hashes), percent) if len(hashes) else []:
        at = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        sums = np.zeros(ranges, np.uint64)
        sums[at[first]] = np.add.reduceat(scrambled, first)
        made.append(_mixed(sums + _mixed(
            np.arange(ranges, dtype=np.uint64) + (np.uint64(step + 1) << np.uint64(40)))))
    return np.concatenate(made).view(np.int64)


def _entered(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per row of ``docs`` (doc_id, a, b, text): n, digest, point and cells in place of text."""
    schema = StructType([
        *docs.schema.fields[:-1], StructField("n", LongType()),
        StructField("digest", BinaryType()), StructField("point", ArrayType(IntegerType())),
        StructField("cells", ArrayType(LongType()))])

    def work(texts: list[str | None]) -> Iterator[list]:
        sets = [shingles(t, size) for t in texts]
        yield [len(s) for s in sets]
        yield [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        yield [np.bincount((s % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)
               for s in sets]
        yield [cells(s, percent) for s in sets]

    return map_texts(docs, schema, work)


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, a, b, text): a and b tell different texts apart."""
    text = F.col(text_column)
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("a"),
        F.xxhash64(F.concat(F.lit("\x01"), text)).alias("b"), text.alias("text"))


def _overlap(left: str, right: str) -> Column:
    """The summed minima of two points or corners of boxes."""
    return F.aggregate(F.zip_with(left, right, lambda x, y: F.least(x, y)), F.lit(0),
                       lambda total, x: total + x)


class _Join:
    """The stored rows of one call, and the folder of their intermediate tables."""

    def __init__(self, spark: SparkSession, docs: DataFrame, size: int, percent: int,
                 id_column: str, text_column: str):
        self.spark, self.size, self.percent = spark, size, percent
        self.base, self.tables = scratch_dir(spark, "jaccard"), 0
        self.docs = _keyed(docs, id_column, text_column)
        self.rows = self.stored(_entered(self.docs, size, percent).withColumn(
            "row", F.monotonically_increasing_id()))
        # Equal sets are one member, that of their first row.
        self.members = self.stored(self.rows.where("n > 0").groupBy("digest").agg(
            F.min("row").alias("row"), F.min("doc_id").alias("least")))
        self.sets: DataFrame | None = None

    def stored(self, frame: DataFrame) -> DataFrame:
        self.tables += 1
        path = f"{self.base}/{self.tables}"
        frame.write.parquet(path)
        return self.spark.read.parquet(path)

    def _needed(self, sizes: Column) -> Column:
        """The overlap that two sets of ``sizes`` in all need."""
        return F.ceil(sizes * self.percent / (100 + self.percent))

    def met(self) -> DataFrame:
        """(cell, lead, row): members of the cells that have several, for one cell of those
        that hold the same ones. lead is the cell's first member."""
        held = self.stored(self.rows.join(self.members.select("row"), "row", "left_semi").select(
            "row", "cells")).select("row", F.explode("cells").alias("cell"))
        shared = self.stored(held.groupBy("cell").agg(
            F.min("row").alias("lead"), F.max("row").alias("last")).where("lead < last"))
        met = self.stored(held.join(shared, "cell"))
        one = met.groupBy("cell", "lead", "last").agg(
            F.bit_xor(F.xxhash64("row")).alias("all")).groupBy("lead", "last", "all").agg(
            F.min("cell").alias("cell"))
        return self.stored(met.select("cell", "lead", "row").join(one.select("cell"), "cell"))

    def similar(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct ``pairs`` (u, v) that are similar enough."""
        points = self.rows.select("row", "n", "point")
        near = self.stored(
            pairs.join(points.toDF("u", "n_u", "of_u"), "u")
            .join(points.toDF("v", "n_v", "of_v"), "v")
            .where((F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * self.percent)
                   & (_overlap("of_u", "of_v") >= self._needed(F.col("n_u") + F.col("n_v"))))
            .select("u", "v", (F.col("n_u") + F.col("n_v")).alias("sizes")))
        sets = self._hashed(near)
        both = F.size(F.array_intersect("of_u", "of_v"))
        return self.stored(
            near.join(sets.toDF("u", "of_u"), "u").join(sets.toDF("v", "of_v"), "v")
            .where(both * (100 + self.percent) >= F.col("sizes") * self.percent).select("u", "v"))

    def _hashed(self, pairs: DataFrame) -> DataFrame:
        """(row, hashes) of the members in ``pairs`` and before, from their texts again."""
        wanted = pairs.select(F.col("u").alias("row")).unionByName(
            pairs.select(F.col("v").alias("row"))).distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets, "row", "left_anti")
        named = self.stored(wanted.join(self.rows.select("row", "a", "b"), "row"))
        # Of all copies one is read. Not a semi-join: Spark would move that before the sieve.
        texts = self._likely(named).join(named, ["a", "b"]).groupBy("a", "b", "row").agg(
            F.first("text").alias("text")).select("row", "text")
        size = self.size
        schema = StructType([*texts.schema.fields[:-1],
                             StructField("hashes", ArrayType(LongType()))])
        hashed = self.stored(map_texts(texts, schema, lambda some: [
            [shingles(t, size).view(np.int64) for t in some]]))
        self.sets = hashed if self.sets is None else self.sets.unionByName(hashed)
        return self.sets

    def _likely(self, named: DataFrame) -> DataFrame:
        """The documents without most that are not ``named``, by one bit per hash: the join that
        follows need not shuffle those texts. The bits are a table of at most SIEVE / 64 rows."""
        at = F.pmod("a", F.lit(SIEVE))
        word, bit = F.shiftright(at, 6), F.call_function(
            "shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
        words = self.stored(named.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")))
        return self.docs.join(F.broadcast(words), word == F.col("word")).where(
            F.col("bits").bitwiseAND(bit) != 0).select(*self.docs.columns)

    def unlike(self, met: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs (u, v) of members of one cell, in different components so far, that their
        points leave."""
        rooted = met.join(roots, F.col("row") == F.col("node"), "left").select(
            "cell", "row", F.coalesce("root", "row").alias("root"))
        rooted = self.stored(rooted)
        # Stored, so that Spark can split the join where a cell is hot.
        mixed = self.stored(rooted.groupBy("cell").agg(
            F.min("root").alias("low"), F.max("root").alias("high"),
            F.count(F.lit(1)).alias("members")).where("low < high").select("cell", "members"))
        mixed = rooted.join(mixed, "cell").join(self.rows.select("row", "n", "point"), "row")
        mixed = self.stored(mixed)
        few = mixed.where(F.col("members") <= BLOCK).select(
            F.xxhash64("cell").alias("unit"), F.lit(False).alias("right"),
            F.lit(False).alias("two"), "row", "root", "n", "point")
        return self._searched(few.unionByName(self._units(mixed.where(F.col("members") > BLOCK))))

    def _units(self, crowded: DataFrame) -> DataFrame:
        """Members of crowded cells once for each pair of blocks that theirs may match in."""
        share = crowded.groupBy("cell", "root").agg(F.count(F.lit(1)).alias("share"),
                                                    F.max("members").alias("members"))
        own = F.col("share") >= BLOCK
        # A large component has blocks of its own, by row; the others are dealt out by component.
        share = self.stored(share.select("cell", "root", F.when(own, F.col("root")).alias("only"), F.when(
            own, F.ceil(F.col("share") / BLOCK)).otherwise(F.ceil(F.col("members") / BLOCK))
            .alias("blocks")))
        dealt = F.pmod(F.xxhash64(F.when(F.col("only").isNull(), F.col("root")).otherwise(
            F.col("row"))), F.col("blocks"))
        placed = self.stored(crowded.join(share, ["cell", "root"]).withColumn(
            "block", F.xxhash64("only", dealt)))
        boxes = self.stored(placed.groupBy("cell", "block").agg(
            F.max("only").alias("only"), F.min("n").alias("least"), F.max("n").alias("most"),
            F.array(*[F.max(F.get("point", F.lit(g))) for g in range(GROUPS)]).alias("high")))
        other = boxes.toDF("cell", *[f"{c}_v" for c in boxes.columns[1:]])
        units = boxes.join(other, "cell").where(
            (F.col("block") <= F.col("block_v"))
            & ~F.coalesce(F.col("only") == F.col("only_v"), F.lit(False))
            & (F.col("most") * 100 >= F.col("least_v") * self.percent)
            & (F.col("most_v") * 100 >= F.col("least") * self.percent)
            & (_overlap("high", "high_v") >= self._needed(F.col("least") + F.col("least_v"))))
        units = self.stored(units.select(
            "cell", "block", "block_v", F.xxhash64("cell", "block", "block_v").alias("unit")))
        two = (F.col("block") != F.col("block_v")).alias("two")
        sides = units.select("cell", "unit", two, F.lit(False).alias("right"), "block").unionByName(
            units.where("block <> block_v").select(
                "cell", "unit", two, F.lit(True).alias("right"), F.col("block_v").alias("block")))
        return placed.join(sides, ["cell", "block"]).select(
            "unit", "right", "two", "row", "root", "n", "point")

    def _searched(self, entries: DataFrame) -> DataFrame:
        """The pairs that the trees of each unit leave; many units are one group of rows."""
        entries = self.stored(entries)
        parts = max(1, -(-entries.count() // ENTRIES))
        percent = self.percent

        def search(table: pa.Table) -> pa.Table:
            unit, right, two, row, root, n = (
                table[c].to_numpy() for c in ("unit", "right", "two", "row", "root", "n"))
            points = table["point"].combine_chunks().flatten().to_numpy().reshape(-1, GROUPS)
            order = np.lexsort((right, unit))
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for at in np.split(order, np.flatnonzero(np.diff(unit[order])) + 1):
                sides = [at[~right[at]], at[right[at]]] if two[at[0]] else [at]
                if min(map(len, sides)) == 0:
                    continue
                trees = [CountTree(points[s], n[s], root[s]) for s in sides]
                left, other = trees[0].join(trees[-1], percent)
                found.append((row[sides[0][left]], row[sides[-1][other]]))
            u, v = map(np.concatenate, zip(*found))
            return pa.table({"u": np.minimum(u, v), "v": np.maximum(u, v)})

        return self.stored(entries.groupBy(F.pmod("unit", F.lit(parts))).applyInArrow(
            search, "u long, v long").distinct())


def jaccard_groups(spark: SparkSession, docs: DataFrame, shingle: int = 3, percent: int = 90,
                   id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``.

    Sets are linked where 100 times their shared shingles is ``percent`` (1 to 100) or more of
    all that they have.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent is 1 to 100")
    join = _Join(spark, docs, shingle, percent, id_column, text_column)
    met = join.met()
    links = join.similar(met.where("row <> lead").select(
        F.col("lead").alias("u"), F.col("row").alias("v")).distinct())
    more = join.similar(join.unlike(met, components(spark, links)))
    roots = components(spark, links.unionByName(more))
    rooted = join.members.join(roots, F.col("row") == F.col("node"), "left").select(
        "digest", "least", F.coalesce("root", "row").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    filled, blank = join.rows.where("n > 0"), join.rows.where("n = 0")
    return filled.join(named.select("digest", "component_id"), "digest").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(blank.select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
