"""Top-k search against all products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import vector_search
from orderloom.llm.vector_search import Bucket, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, id long, score string, bucket int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, k):
    whole = {(i, tuple(math.floor(64 * np.float32(x).item()) for x in v)) for i, v in rows
             if i is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in {i for i, _ in whole if i % 20 == 0}:
        scores = [(-sum(a * b for a, b in zip(u, v)), j)
                  for i, u in whole if i == q for j, v in whole if j != q]
        want += [(q, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(want)


def vectors(seed, n, spread):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        size = draw.choice(spread)
        rows.append((i, [draw.gauss(0, 1) * size for _ in range(8)]))
    return rows


AWKWARD = [(None, [1.0] * 8), (200, None), (220, []), (240, [1.0, None]), (260, [math.nan] * 8),
           (280, [math.inf] * 8), (300, [0.0] * 8), (320, [1.0, 2.0]), (1, [9.0] * 8),
           (340, [9.0] * 8), (360, [9.0] * 8), (360, [9.0] * 8), (380, [1e17] * 8)]


@pytest.mark.parametrize("block, coordinate", [(4096, 0.75), (16, 0.1), (7, 2.0)])
def test_against_all_products(spark, monkeypatch, block, coordinate):
    monkeypatch.setattr(vector_search, "BLOCK", block)
    monkeypatch.setattr(vector_search, "QUERIES", 3)
    monkeypatch.setattr(vector_search, "BY_COORDINATE", coordinate)
    rows = vectors(3, 150, [0.05, 1.0, 1.02, 4.0]) + [(i, [0.5] * 8) for i in range(400, 440)] \
        + AWKWARD[:-1]
    got = top_k(spark, table(spark, rows), F.col("id") % 20 == 0, k=5, seeds=12)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_scores_beyond_doubles_are_whole(spark):
    rows = [(20, [1e7] * 4), (1, [1e7 + 1] * 4), (2, [3.0] * 4)]
    got = top_k(spark, table(spark, rows), F.col("id") % 20 == 0, k=5)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)
    assert top_k(spark, table(spark, AWKWARD), F.col("id") % 20 == 0, k=5).count() > 0


def test_vectors_are_copied_to_blocks_that_visit_them_only(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "BLOCK", 4)
    monkeypatch.setattr(vector_search, "QUERIES", 2)
    lengths = [1.0] * 9 + [2.0] * 5 + [4.0] * 3
    found = spark.createDataFrame([(i, [x, 0.0], {1.0: 0, 2.0: 14, 4.0: 28}[x])
                                   for i, x in enumerate(lengths)],
                                  "id long, v array<double>, bucket int")
    # By the length they need: three of the longest only, four of two buckets, two of all, none.
    thetas = [3.0] * 3 + [1.5] * 4 + [-math.inf, 0.5] + [9.0] * 5
    queries = spark.createDataFrame([(i, [1.0, 0.0], t) for i, t in enumerate(thetas)],
                                    "id long, v array<double>, theta double")
    asked, held = vector_search.spread(queries, found, [(0, 9, 1.0), (14, 5, 2.0), (28, 3, 4.0)])
    visits = {0: 2, 14: 6, 28: 9}
    rows = asked.collect()
    assert {b: len({r["id"] for r in rows if r["bucket"] == b}) for b in visits} == visits
    copies = {b: held.where(F.col("bucket") == b).count() for b in visits}
    # Blocks of two queries: one, two and two by what they need.
    assert copies == {0: 9 * 1, 14: 5 * 3, 28: 3 * 5}
    met = {(r["id"], r["bucket"], r["block"], r["query_block"]) for r in rows}
    pairs = [(r["id"], q[0]) for r in held.collect() for q in met
             if q[1:] == (r["bucket"], r["block"], r["query_block"])]
    assert len(pairs) == len(set(pairs)) == 9 * 2 + 5 * 6 + 3 * 9


def test_few_or_no_rows(spark):
    assert top_k(spark, table(spark, []), F.col("id") % 20 == 0).collect() == []
    assert top_k(spark, table(spark, [(20, [1.0])]), F.col("id") % 20 == 0).collect() == []
    assert top_k(spark, table(spark, [(1, [1.0])]), F.col("id") % 20 == 0).collect() == []
    got = top_k(spark, table(spark, [(20, [1.0]), (3, [2.0])]), F.col("id") % 20 == 0).collect()
    assert list(map(tuple, got)) == [(20, 1, 3, 64 * 128)]


def test_pruning_leaves_what_can_reach_the_threshold():
    draw = np.random.default_rng(1)
    units = draw.normal(size=(500, 6))
    bucket = Bucket(np.arange(500), np.floor(64 * units))
    query = np.floor(64 * draw.normal(size=6))
    left = set(bucket.by_coordinate(query, 0.8).tolist())
    cosines = bucket.units @ (query / np.linalg.norm(query))
    assert {i for i in range(500) if cosines[i] >= 0.8} <= left
    assert len(left) < 250
