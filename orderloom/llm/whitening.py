"""Vectors along the principal components of their distribution, each scaled to variance one.

Components become whole numbers, x = floor(scale * c). Every distinct vector counts once. Its
sums, and the products of its differences from the centre, are gathered as whole numbers by the
tasks and summed by Spark, so the covariance is exact and the same on any cluster. Products are
taken of differences from the rounded mean; what rounding left is taken off the sums, in whole
numbers too.

The eigenvectors of the covariance start in single precision and are corrected by the iteration
of Ogita and Aishima in extended precision, which consists of matrix products and doubles the
number of right digits each time. Where eigenvalues lie closer together than the iteration can
tell apart, the vectors of the cluster are turned by the solution of the small problem that the
matrix poses within the cluster, and the iteration goes on. That work is on a matrix of
dimensions by dimensions on the driver; nothing else of the vectors gets there.

Vectors that are NULL, or hold NULL or non-finite components, take no part. Shorter vectors
count as filled up with zeros, and whole numbers are held within 2^62.
Components of variance zero, by the rounding of double precision, have no direction of their own
and give no rows; with fewer than two distinct vectors there are none at all. Signs are such that
a component's largest entry is positive. A deviation beyond the range of longs is NULL. Repeated
rows give repeated results, also those without id. An empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_dir
from .vector_codes import matrix, whole

# Rows worked on at a time.
ROWS = 4096
ROUNDS = 30
_DOUBLE, _LONG = 2 ** 53, 2 ** 63 - 1
# Sums travel in two decimals: the bits from this one on, and those below.
_HALF = 60


def _wide(values: list[int] | np.ndarray) -> np.ndarray:
    """Whole numbers of any size in extended precision."""
    flat = np.asarray(values, object)
    high = flat.astype(float)
    low = (flat - np.array([int(h) for h in high.ravel()], object).reshape(high.shape)).astype(float)
    return high.astype(np.longdouble) + low.astype(np.longdouble)


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Positions of values, by size, that lie within ``gap`` of the next one."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def refined(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix in extended precision."""
    n = len(a)
    scale = float(np.abs(a).max(initial=0)) or 1.0
    a = a / np.longdouble(scale)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    eps = float(np.finfo(np.longdouble).eps)
    one = np.eye(n, dtype=np.longdouble)
    turned: dict[tuple[int, ...], float] = {}
    last = np.inf
    for _ in range(ROUNDS):
        r, s = one - x.T @ x, x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        # Eigenvalues closer than this cannot be told apart yet.
        delta = 2 * float(np.sqrt((off * off).sum()) + np.sqrt((r * r).sum()) * np.abs(values).max())
        close = np.abs(values[:, None] - values[None, :]) <= delta
        # Half of r restores unit length and right angles; the rest, which is antisymmetric, turns.
        means = (values[:, None] + values[None, :]) / 2
        apart = np.where(close, 1, values[None, :] - values[:, None])
        e = r / 2 + np.where(close, 0, (s + means * r) / apart)
        x = x + x @ e
        size = float(np.sqrt((e * e).sum()))
        # Within a cluster the iteration only keeps vectors orthogonal: solve it on its own, and
        # again whenever the rest has become much more exact.
        groups = {tuple(sorted(g)): g for g in _clusters(values.astype(float), delta)}
        due = [(k, g) for k, g in groups.items() if delta < min(1e-6, turned.get(k, 1.0) / 100)]
        for part, group in due:
            turned[part] = delta
            x[:, group] = x[:, group] @ _within(a, x[:, group])
        if not due and (size < 8 * n * eps or size >= last < 1e-12):
            break
        last = np.inf if due else size
    x = x + x @ (one - x.T @ x) / 2
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    largest = x[np.abs(x).argmax(axis=0), np.arange(n)] if n else np.zeros(0)
    return values[order] * np.longdouble(scale), x * np.where(largest < 0, -1, 1)


def _within(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How the vectors of a cluster turn into eigenvectors: those of the matrix within their
    span, less its mean eigenvalue, which would hide the differences."""
    small = x.T @ (a @ x)
    mean = np.trace(small) / len(small)
    gram = x.T @ x
    small = small - mean * gram
    small = (small + small.T) / 2
    top = float(np.abs(small).max())
    if top == 0:
        return np.eye(len(small), dtype=np.longdouble)
    return np.linalg.eigh((small / top).astype(float))[1].astype(np.longdouble)


@dataclass
class Fit:
    """What whitening needs to know of the distinct vectors."""

    n: int
    sums: list[int]
    trace: np.longdouble
    values: np.ndarray
    vectors: np.ndarray

    @property
    def kept(self) -> int:
        """Components of variance above zero."""
        least = len(self.values) * 2.0 ** -52 * float(self.values[0]) if len(self.values) else 0
        return int((self.values > least).sum())

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly."""
        sums = np.array(self.sums, object)
        top = max(map(abs, self.sums), default=0)
        if self.n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + top < _LONG:
            return self.n * x - sums.astype(np.int64)
        return self.n * x.astype(object) - sums

    def whitened(self, centred: np.ndarray, components: int) -> np.ndarray:
        scale = self.n * np.sqrt(self.values[:components])
        return centred.astype(float) @ (self.vectors[:, :components] / scale).astype(float)


def _gathered(rows: DataFrame, width: int, work: Callable[[np.ndarray], np.ndarray]
              ) -> tuple[int, list[list[int]]]:
    """How many vectors there are, and the sums of what ``work`` gives for runs of them: whole
    numbers, in as many rows and columns for every run. Tasks send one sum each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = None, 0
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                x = matrix(batch.column(0).slice(start, ROWS), width)
                made = _integers(work(x))
                total, count = made if total is None else total + made, count + len(x)
        for i, line in enumerate([] if total is None else total):
            yield pa.RecordBatch.from_arrays([
                pa.array([i] * len(line), pa.int32()), pa.array(range(len(line)), pa.int32()),
                pa.array([count] * len(line), pa.int64()),
                *[pa.array([Decimal(int(v)) for v in part], pa.decimal128(38, 0))
                  for part in (line >> _HALF, line & (1 << _HALF) - 1)]],
                names=["i", "j", "n", "high", "low"])

    sums = rows.mapInArrow(
        run, "i int, j int, n long, high decimal(38,0), low decimal(38,0)").groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "high", "low")]).orderBy("i", "j").collect()
    table: list[list[int]] = []
    for r in sums:
        if r["j"] == 0:
            table.append([])
        table[-1].append((int(r["high"]) << _HALF) + int(r["low"]))
    return (sums[0]["n"] if sums else 0), table


def _integers(values: np.ndarray) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(values)


def _products(y: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whole-number products, in doubles or longs where these hold them."""
    top = max(1, int(np.abs(y).max(initial=0))) * max(1, int(np.abs(other).max(initial=0)))
    if top * y.shape[1] < _DOUBLE:
        return y.astype(float) @ other.astype(float)
    if top * y.shape[1] < _LONG:
        return y.astype(np.int64) @ other.astype(np.int64)
    return y.astype(object) @ other.astype(object)


def fit(rows: DataFrame, vector: str) -> Fit | None:
    """The covariance of ``rows``' whole-number vectors and its components."""
    width = rows.agg(F.max(F.size(vector))).first()[0]
    if not width:
        return None
    vectors = rows.select(vector)

    def sums(x: np.ndarray) -> np.ndarray:
        safe = int(np.abs(x).max(initial=0)) * len(x) < _LONG
        return (x if safe else x.astype(object)).sum(axis=0)[None, :]

    n, [total] = _gathered(vectors, width, sums)
    centre = [(2 * s + n) // (2 * n) for s in total]

    def products(x: np.ndarray) -> np.ndarray:
        y = x.astype(object) - np.array(centre, object)
        if int(np.abs(x).max(initial=0)) + max(map(abs, centre)) < _LONG:
            y = x - np.array(centre, np.int64)
        return _products(y.T, y)

    _, squares = _gathered(vectors, width, products)
    rest = np.array([s - n * c for s, c in zip(total, centre)], object)
    # n * sum(y y') - sum(y) sum(y)', over n squared.
    exact = n * np.array(squares, object) - rest[:, None] * rest[None, :]
    trace = Fraction(int(sum(exact.diagonal())), n * n)
    values, components = refined(_wide(exact) / (np.longdouble(n) * np.longdouble(n)))
    return Fit(n, total, np.longdouble(float(trace)), values, components)


def identity_error(rows: DataFrame, vector: str, model: Fit, components: int) -> float:
    """The largest entry of the whitened vectors' covariance less the identity."""
    width = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components, components + 1))
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                x = matrix(batch.column(0).slice(start, ROWS), width)
                w = model.whitened(model.centred(x), components)
                total += np.column_stack([w.T @ w, w.sum(axis=0)])
        at = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(total.ravel())],
            names=["i", "j", "total"])

    sums = np.zeros((components, components + 1))
    for r in rows.select(vector).mapInArrow(run, "i int, j int, total double").groupBy(
            "i", "j").agg(F.sum("total").alias("total")).collect():
        sums[r["i"], r["j"]] = r["total"] / model.n
    means = sums[:, -1]
    return float(np.abs(sums[:, :-1] - np.outer(means, means) - np.eye(components)).max())


def whiten(spark: SparkSession, vectors: DataFrame, components: int = 4, scale: int = 256,
           id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Per row and component: vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error.

    n is the number of distinct vectors; deviation is the sum of (n x - sum)^2 over dimensions;
    explained is the component's share of the whole variance.
    """
    base = scratch_dir(spark, "whitening")
    whole(vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("c")),
          scale, "c", "x").drop("c").write.parquet(f"{base}/whole")
    rows = spark.read.parquet(f"{base}/whole")
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    rows.select(filled.alias("x")).distinct().write.parquet(f"{base}/distinct")
    distinct = spark.read.parquet(f"{base}/distinct")
    model = fit(distinct, "x")
    found = 0 if model is None else min(components, model.kept)
    if not found:
        return spark.createDataFrame([], schema)
    error = identity_error(distinct, "x", model, found)
    explained = [float(v / model.trace) for v in model.values[:found]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                some = batch.slice(start, ROWS)
                centred = model.centred(matrix(some.column(1), width))
                safe = int(np.abs(centred).max(initial=0)) ** 2 * width < _LONG
                squares = (centred if safe else centred.astype(object)) ** 2
                deviation = pa.array([d if d <= _LONG else None
                                      for d in squares.sum(axis=1).tolist()], pa.int64())
                whitened = model.whitened(centred, found)
                at = pa.array(np.repeat(np.arange(len(some)), found))
                yield pa.RecordBatch.from_arrays([
                    some.column(0).take(at), pa.array(np.tile(np.arange(1, found + 1), len(some)),
                                                      pa.int32()),
                    pa.array(np.full(len(at), model.n)), deviation.take(at),
                    pa.array(whitened.ravel()), pa.array(np.tile(explained, len(some))),
                    pa.array(np.full(len(at), error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(run, schema)
