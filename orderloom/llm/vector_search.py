"""Exact top-k inner products by norm buckets.

Vectors are grouped by length: bucket b holds lengths in [GROWTH^b, GROWTH^(b+1)). A query's
k-th best product with a bounded block of the longest vectors is a threshold theta that its
answers must reach. In a bucket of length at most l, a vector can reach theta only with a
cosine of theta / (|q| l) or more, the local threshold. Buckets where it is above one are
never visited. In the others each query is pruned by what its threshold there allows: by
coordinates, where few unit vectors have coordinates near enough to the query's largest ones,
or by length, where only vectors of length theta / |q| or more remain. Whatever is left is
verified by integer products.

Work is split in blocks: a bucket's vectors by a hash into blocks of about ``BLOCK``. Queries
that need the same length, theta / |q|, at least visit the same buckets; those of one lowest
bucket form blocks of about ``QUERIES``, and a bucket's blocks are copied to the query blocks
that visit it and to no other. A hot bucket is thus many groups, and none is larger than two
blocks. Each group keeps k answers per query.

Vectors that are NULL, or hold NULL or non-finite components, take no part, nor do rows
without id. Shorter vectors count as filled up with zeros. Rows that repeat id and vector
count once; rows that share an id are one query with each of their vectors, answered together,
and never answers of each other. Ties go to the smaller id. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import scratch_dir

GROWTH = 1.05
BLOCK, QUERIES = 4096, 2048
# Local cosine threshold from which coordinates prune; below it, only length does.
BY_COORDINATE = 0.75
FOCUS = 3
# Sums below this are exact in doubles.
_EXACT = 2.0 ** 53


def scaled(vectors: DataFrame, scale: float, id_column: str, vector_column: str) -> DataFrame:
    """(id, v): floor(scale * x) of every component x, for the rows that take part."""
    finite = F.forall(vector_column, lambda x: F.coalesce(
        F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.when(finite, F.transform(
            vector_column, lambda x: F.call_function(
                "floor", x.cast("double") * F.lit(float(scale))).cast("double"))).alias("v"))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).distinct()


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width)


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products, beyond the range of doubles too (held within that of longs)."""
    bound = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1]
    if bound < _EXACT:
        return (queries @ vectors.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object) for m in (queries, vectors)]
    return np.clip(whole[0].dot(whole[1].T), -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id, without the query's own id."""
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        at = at[scores[at] >= np.partition(scores[at], -k)[-k]]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


class Bucket:
    """A block of vectors of similar length, longest first, ready to be searched."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        order = np.lexsort((ids, -lengths))
        self.ids, self.vectors, self.lengths = ids[order], vectors[order], lengths[order]
        self.units = self.vectors / np.maximum(self.lengths, 1e-300)[:, None]
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _near(self, axis: int, low: float, high: float) -> np.ndarray:
        if axis not in self.sorted:
            order = np.argsort(self.units[:, axis])
            self.sorted[axis] = order, self.units[order, axis]
        order, values = self.sorted[axis]
        return order[np.searchsorted(values, low, "left"):np.searchsorted(values, high, "right")]

    def by_coordinate(self, query: np.ndarray, cosine: float) -> np.ndarray:
        """Vectors whose focus coordinates allow an angle to the query of that cosine."""
        unit = query / math.sqrt(float(query @ query))
        angle, slack, left = math.acos(min(1.0, cosine)), 1e-7, None
        for axis in np.argsort(-np.abs(unit))[:FOCUS]:
            own = math.acos(max(-1.0, min(1.0, unit[axis])))
            low = math.cos(min(math.pi, own + angle)) - slack
            high = math.cos(max(0.0, own - angle)) + slack
            if left is None:
                left = self._near(int(axis), low, high)
            else:
                values = self.units[left, axis]
                left = left[(values >= low) & (values <= high)]
        return left

    def search(self, ids: np.ndarray, queries: np.ndarray, thetas: np.ndarray, k: int
               ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query id, vector ids, scores) of each query's k best that reach its threshold."""
        lengths = np.sqrt((queries * queries).sum(axis=1))
        reach = lengths * self.lengths[0]
        cosines = np.where(reach > 0, thetas / np.maximum(reach, 1e-300),
                           np.where(thetas > 0, np.inf, -np.inf))
        alive = cosines <= 1 + 1e-9
        pruned = alive & (cosines >= BY_COORDINATE)
        for i in np.flatnonzero(pruned):
            left = self.by_coordinate(queries[i], cosines[i] - 1e-9)
            scores = _products(queries[i:i + 1], self.vectors[left])[0]
            best = _best(self.ids[left], scores, ids[i], k)
            yield ids[i], self.ids[left][best], scores[best]
        rest = np.flatnonzero(alive & ~pruned)
        # Longest first: those long enough for a query are the first so many.
        least = np.where(lengths > 0, thetas / np.maximum(lengths, 1e-300), -np.inf)
        counts = np.searchsorted(-self.lengths, -(least - 1e-9 * np.abs(least)), "right")
        rest = rest[np.argsort(-counts[rest], kind="stable")]
        for start in range(0, len(rest), 256):
            some = rest[start:start + 256]
            scores = _products(queries[some], self.vectors[:counts[some[0]]])
            for i, row in zip(some, scores):
                row = row[:counts[i]]
                best = _best(self.ids[:counts[i]], row, ids[i], k)
                yield ids[i], self.ids[best], row[best]


def _thresholds(queries: DataFrame, seeds: pd.DataFrame, width: int, k: int) -> DataFrame:
    """Queries with theta: the k-th best product with the seeds, or minus infinity."""
    seed_ids = seeds["id"].to_numpy()
    seed_vectors = np.array(seeds["v"].tolist(), float).reshape(len(seeds), width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            vectors = _matrix(pa.chunked_array([batch.column("v")]), width)
            thetas = []
            for start in range(0, len(ids), 256):
                scores = _products(vectors[start:start + 256], seed_vectors)
                for own, row in zip(ids[start:start + 256], scores):
                    row = row[seed_ids != own]
                    thetas.append(float(np.partition(row, -k)[-k]) if len(row) >= k
                                  else -math.inf)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(thetas, pa.float64())],
                names=["id", "v", "theta"])

    return queries.mapInArrow(run, "id long, v array<double>, theta double")


def spread(queries: DataFrame, found: DataFrame, stats: list[tuple[int, int, float]]
           ) -> tuple[DataFrame, DataFrame]:
    """Queries and vectors with the (bucket, block, query_block) they are compared in.

    ``stats`` are the buckets, shortest first, with their count and greatest length. A query
    visits the lowest bucket where it can reach its threshold, and all longer ones.
    """
    own = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)) * (1 + 1e-9)
    # Lengths grow with the bucket, so those too short come first.
    most = F.array(*[F.lit(float(m)) for _, _, m in stats])
    short = F.size(F.filter(most, lambda m: F.col("theta") > F.col("own") * m))
    queries = queries.withColumn("own", own).withColumn("band", short).where(
        F.col("band") < len(stats)).drop("own")
    # One row per band at most; bands are numbered as the buckets are.
    counts = {r["band"]: r["n"] for r in
              queries.groupBy("band").agg(F.count(F.lit(1)).alias("n")).collect()}
    ends = [0]
    for band in range(len(stats)):
        ends.append(ends[-1] - (-counts.get(band, 0) // QUERIES))
    blocks = [-(-n // BLOCK) for _, n, _ in stats]

    def of(values: list[int], band: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), band + 1)

    def part(count: Column) -> Column:
        return F.pmod(F.xxhash64("id"), count).cast("int")

    band = F.col("band")
    each = F.transform(F.sequence(band, F.lit(len(stats) - 1)), lambda b: F.struct(
        b.alias("band"), of([b for b, _, _ in stats], b).alias("bucket")))
    asked = queries.select(
        "id", "v", "theta",
        (of(ends[:-1], band) + part(of([ends[i + 1] - ends[i] for i in range(len(stats))], band))
         ).alias("query_block"), F.inline(each)).select(
        "bucket", F.explode(F.sequence(F.lit(0), of(blocks, band) - 1)).alias("block"),
        "query_block", "id", "v", "theta")
    places = {b: i for i, (b, _, _) in enumerate(stats)}
    place = F.element_at(F.create_map(*[F.lit(x) for pair in places.items() for x in pair]),
                         F.col("bucket"))
    held = found.withColumn("band", place).select(
        "bucket", part(of(blocks, band)).alias("block"), F.explode(F.filter(
            F.sequence(F.lit(0), of(ends[1:], band)), lambda q: q < of(ends[1:], band))
        ).alias("query_block"), "id", "v")
    return asked, held


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 20,
          scale: float = 64.0, id_column: str = "vec_id", vector_column: str = "embedding",
          seeds: int = 1024) -> DataFrame:
    """Per query its k highest integer products: query_id, rank (from 1), vec_id, score.

    ``is_query`` is a condition on a column named ``id``. ``seeds`` bounds the longest vectors
    that give the first thresholds; it changes the work, not the answers.
    """
    base = scratch_dir(spark, "vectors")
    found = scaled(vectors, scale, id_column, vector_column)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    found = found.withColumn("length", length).withColumn("bucket", F.when(
        F.col("length") > 0, F.floor(F.log("length") / math.log(GROWTH)).cast("int")).otherwise(
        F.lit(-1)))
    found.write.parquet(f"{base}/scaled")
    found = spark.read.parquet(f"{base}/scaled")
    # At most as many rows as steps of GROWTH that a double has room for.
    stats = found.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.max("length").alias("most"),
        F.max(F.size("v")).alias("width")).collect()
    schema = "query_id long, vec_id long, score long"
    width = max((r["width"] for r in stats), default=0) or 1
    found = found.withColumn("v", F.concat("v", F.array_repeat(
        F.lit(0.0), F.lit(width) - F.size("v"))))
    if not stats:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    stats.sort(key=lambda r: r["bucket"])
    # The longest buckets that hold all seeds, so that tasks sort little else.
    lowest = max((i for i in range(len(stats)) if sum(r["n"] for r in stats[i:]) >= seeds),
                 default=0)
    first = found.where(F.col("bucket") >= stats[lowest]["bucket"]).orderBy(
        F.desc("length"), "id").limit(seeds).select("id", "v").toPandas()
    _thresholds(found.where(is_query).select("id", "v"), first, width, k).write.parquet(
        f"{base}/queries")
    asked, held = spread(spark.read.parquet(f"{base}/queries"), found,
                         [(r["bucket"], r["n"], r["most"]) for r in stats])
    keys = ["bucket", "block", "query_block"]

    def search(asked: pa.Table, block: pa.Table) -> pa.Table:
        made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(asked) and len(block):
            bucket = Bucket(block["id"].to_numpy(), _matrix(block["v"], width))
            for query, ids, scores in bucket.search(
                    asked["id"].to_numpy(), _matrix(asked["v"], width),
                    asked["theta"].to_numpy(), k):
                made.append((np.full(len(ids), query), ids, scores))
        columns = [np.concatenate(c) for c in zip(*made)] or [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns],
                        names=["query_id", "vec_id", "score"])

    answers = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(search, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
