"""Vectors as short codes: per part of a vector, the index of the nearest codebook entry.

Components become whole numbers, floor(scale * x). Parts and entries are padded with zeros to a
power of two, N, and turned by the integer Walsh-Hadamard transform, which multiplies every
squared distance by N and changes nothing else. Differences are squared and summed coefficient
by coefficient in sequency order, where smooth parts have most of their weight first; an entry
whose sum exceeds the whole sum of some other entry cannot be nearest and is eliminated. All of
it is in whole numbers, so codes, errors and codebooks are the same on any cluster.

Every round reads the stored whole numbers once; a task sums its parts per entry, so that no
more than parts x entries x positions numbers per task are shuffled, and that many reach the
driver. Codebooks, of that size too, travel with the plan.

Vectors that are NULL, or hold NULL or non-finite components, take no part. Shorter vectors
count as filled up with zeros, as do lengths that the parts do not divide. Whole numbers are
held within 2^62, and errors within the range of longs. Repeated rows count as often as they stand
there. Codebooks start from the smallest ids: of rows that share an id the least vector is taken,
and rows without id count as one id after all others. With fewer ids there are fewer entries.
An empty table gives empty results. Other columns are only passed on, but for any that are named
as the new ones, which replace them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import scratch_dir
from .batches import fresh

# Sums below this are exact in 64 bits.
_LONG = 2 ** 63 - 1
# Rows worked on at a time.
ROWS = 4096
# Whole numbers are held within this.
RANGE = 2 ** 62

Codebooks = list[list[list[int]]]


def whole(vectors: DataFrame, scale: int, vector_column: str, name: str) -> DataFrame:
    """The rows that take part, with floor(scale * x) of every component in column ``name``."""
    finite = F.forall(vector_column, lambda x: F.coalesce(
        F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    scaled = F.transform(vector_column, lambda x: F.greatest(F.lit(-RANGE), F.least(
        F.lit(RANGE), F.floor(x.cast("double") * F.lit(float(scale))))))
    return vectors.withColumn(name, F.when(finite, scaled)).where(F.col(name).isNotNull())


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width``, shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    filled = np.zeros((len(column), width), np.int64)
    filled[np.arange(width) < sizes[:, None]] = flat
    return filled


def walsh(rows: np.ndarray) -> np.ndarray:
    """The unnormalised transform of rows padded to a power of two, in sequency order."""
    n = 1 << max(0, rows.shape[1] - 1).bit_length()
    turned = np.zeros((len(rows), n), rows.dtype)
    turned[:, :rows.shape[1]] = rows
    signs = np.array([[1]])
    half = 1
    while half < n:
        pairs = turned.reshape(len(rows), n // (2 * half), 2, half)
        turned = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]],
                          axis=2).reshape(len(rows), n)
        signs = np.block([[signs, signs], [signs, -signs]])
        half *= 2
    return turned[:, np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the nearest entry, ties to the lower index, and its squared distance."""
    n = 1 << max(0, parts.shape[1] - 1).bit_length()
    largest = max(abs(int(e)) for m in (parts, entries) for e in (m.min(initial=0),
                                                                  m.max(initial=0)))
    # A sum of n squared differences of sums of n numbers has to fit.
    if n * n * 4 * largest * largest > _LONG:
        parts, entries = parts.astype(object), entries.astype(object)
    points, marks = walsh(parts), walsh(entries)
    row = np.repeat(np.arange(len(points)), len(marks))
    entry = np.tile(np.arange(len(marks)), len(points))
    total = (points[row, 0] - marks[entry, 0]) ** 2
    # The entry that leads after one coefficient gives each row a bound.
    lead = total.reshape(len(points), -1).argmin(axis=1)
    bound = ((points - marks[lead]) ** 2).sum(axis=1)
    for k in range(1, n):
        left = np.flatnonzero(total <= bound[row])
        row, entry = row[left], entry[left]
        total = total[left] + (points[row, k] - marks[entry, k]) ** 2
    left = np.flatnonzero(total <= bound[row])
    order = left[np.lexsort((entry[left], total[left], row[left]))]
    first = order[np.unique(row[order], return_index=True)[1]]
    return entry[first], total[first] // n


def _split(batch: pa.RecordBatch, column: int, parts: int, width: int
           ) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Runs of rows with their vectors, one array per part."""
    for start in range(0, len(batch), ROWS):
        run = batch.slice(start, ROWS)
        yield run, np.split(matrix(run.column(column), width), parts, axis=1)


def _summed(rows: DataFrame, books: Codebooks, width: int) -> dict[tuple[int, int], list[int]]:
    """Per part and entry, if it is nearest to any: the floored means of its parts."""
    parts, size = len(books), width // len(books)
    marks = [np.array(book, dtype=object if _big(book) else np.int64) for book in books]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, len(books[0])), np.int64)
        sums = np.zeros((parts, len(books[0]), size), object)
        for batch in batches:
            for _, cut in _split(batch, 0, parts, width):
                for p, part in enumerate(cut):
                    codes, _ = nearest(part, marks[p])
                    counts[p] += np.bincount(codes, minlength=counts.shape[1])
                    exact = part if len(part) * int(np.abs(part).max(initial=0)) < _LONG \
                        else part.astype(object)
                    for e in np.unique(codes):
                        sums[p, e] += exact[codes == e].sum(axis=0).astype(object)
        used = np.argwhere(counts)
        for p, e in used:
            yield pa.RecordBatch.from_arrays([
                pa.array([int(p)] * size, pa.int32()), pa.array([int(e)] * size, pa.int32()),
                pa.array(range(size), pa.int32()), pa.array([int(counts[p, e])] * size, pa.int64()),
                pa.array([Decimal(int(s)) for s in sums[p, e]], pa.decimal128(38, 0))],
                names=["part", "entry", "position", "n", "total"])

    made = rows.mapInArrow(run, "part int, entry int, position int, n long, total decimal(38,0)")
    means: dict[tuple[int, int], list[int]] = {}
    for r in made.groupBy("part", "entry", "position").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy(
            "part", "entry", "position").collect():
        means.setdefault((r["part"], r["entry"]), []).append(int(r["total"]) // r["n"])
    return means


def _big(book: list[list[int]]) -> bool:
    return any(abs(x) > _LONG // 4 for entry in book for x in entry)


def _first_entries(rows: DataFrame, id_column: str, vector: str, entries: int, width: int
                   ) -> list[list[int]]:
    """The vectors of the smallest ids, ascending."""
    order = F.col(id_column).asc_nulls_last()
    ids = [r[0] for r in rows.select(id_column).distinct().orderBy(order).limit(entries).collect()]
    wanted = F.col(id_column).isin([i for i in ids if i is not None])
    if None in ids:
        wanted = wanted | F.col(id_column).isNull()
    least = rows.where(F.coalesce(wanted, F.lit(False))).groupBy(id_column).agg(
        F.min(vector).alias(vector)).orderBy(order).collect()
    return [[*r[vector], *[0] * (width - len(r[vector]))] for r in least]


def codebooks(rows: DataFrame, id_column: str, vector: str, parts: int = 8, entries: int = 16,
              rounds: int = 6) -> Codebooks:
    """Per part its entries, after that many rounds over all of ``rows``' whole numbers."""
    longest = rows.agg(F.max(F.size(vector))).first()[0]
    if longest is None:
        return []
    size = max(1, -(-longest // parts))
    first = _first_entries(rows, id_column, vector, entries, size * parts)
    books = [[v[p * size:(p + 1) * size] for v in first] for p in range(parts)]
    for _ in range(rounds):
        for (part, entry), mean in _summed(rows.select(vector), books, size * parts).items():
            books[part][entry] = mean
    return books


def encode(rows: DataFrame, books: Codebooks, vector: str, code: str = "code",
           error: str = "error") -> DataFrame:
    """``rows`` with, in place of ``vector``, their code and its squared error.

    A code has one index per part, each in two hexadecimal digits (more beyond 256 entries).
    """
    made = {vector.lower(), code.lower(), error.lower()}
    kept = [f for f in rows.schema.fields if f.name.lower() not in made]
    schema = StructType([*kept, StructField(code, StringType()), StructField(error, LongType())])
    if not books:
        return rows.sparkSession.createDataFrame([], schema)
    arrow, width = to_arrow_schema(schema), len(books) * len(books[0][0])
    digits = max(2, len(f"{len(books[0]) - 1:x}"))
    marks = [np.array(book, dtype=object if _big(book) else np.int64) for book in books]
    names = np.array([f"{e:0{digits}x}" for e in range(len(books[0]))], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, cut in _split(batch, len(kept), len(books), width):
                codes, errors = zip(*[nearest(part, m) for part, m in zip(cut, marks)])
                exact = sum(e.astype(object) for e in errors)
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(i).cast(arrow.field(i).type) for i in range(len(kept))],
                     pa.array(sum((names[c] for c in codes[1:]), names[codes[0]]), pa.string()),
                     pa.array([min(e, _LONG) for e in exact], pa.int64())], schema=arrow)

    return rows.select(*[f.name for f in kept], vector).mapInArrow(run, schema)


def digest(books: Codebooks) -> str:
    """SHA-256 of all components, by part, entry and position."""
    numbers = ",".join(str(x) for book in books for entry in book for x in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def compress(spark: SparkSession, vectors: DataFrame, parts: int = 8, entries: int = 16,
             rounds: int = 6, scale: int = 4096, id_column: str = "vec_id",
             vector_column: str = "embedding", code: str = "code", error: str = "error"
             ) -> tuple[DataFrame, Codebooks]:
    """The rows that take part with their codes in place of vectors, and the codebooks."""
    path = f"{scratch_dir(spark, 'vector-codes')}/whole"
    numbers = fresh(vectors, "whole_numbers")
    whole(vectors, scale, vector_column, numbers).drop(vector_column).write.parquet(path)
    rows = spark.read.parquet(path)
    books = codebooks(rows, id_column, numbers, parts, entries, rounds)
    return encode(rows, books, numbers, code, error), books
