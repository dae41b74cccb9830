"""Vector codes against plain arithmetic in whole numbers."""

import math
import random

import numpy as np
import pytest

from orderloom.llm import vector_codes
from orderloom.llm.vector_codes import compress, digest, nearest, walsh

SCHEMA = ("vec_id long, embedding array<double>, label int, code int, error string, "
          "whole_numbers long")


def table(spark, rows):
    return spark.createDataFrame([(i, v, 3, 1, "x", 2) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, parts, entries, rounds, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], []
    size = max(1, -(-max(len(v) for _, v in kept) // parts))
    kept = [(i, v + [0] * (size * parts - len(v))) for i, v in kept]
    cut = [(i, [v[p * size:(p + 1) * size] for p in range(parts)]) for i, v in kept]
    first = {}
    for i, v in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        first.setdefault(i, v)
    first = list(first.values())[:entries]
    books = [[v[p * size:(p + 1) * size] for v in first] for p in range(parts)]

    def best(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            found = [(best(v[p], p)[1], v[p]) for _, v in cut]
            for k in {k for k, _ in found}:
                own = [v for j, v in found if j == k]
                books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    codes = []
    for i, v in cut:
        d, k = zip(*[best(v[p], p) for p in range(parts)])
        codes.append((i, "".join(f"{x:02x}" for x in k), min(sum(d), 2 ** 63 - 1)))
    return codes, books


def clustered(seed, n, width):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(9)]
    return [(i, [c + draw.gauss(0, 0.3) for c in draw.choice(centres)]) for i in range(n)]


AWKWARD = [(None, [1.0] * 6), (None, [-1.0] * 6), (900, None), (901, []), (902, [1.0, None]),
           (903, [math.nan] * 6), (904, [math.inf] * 6), (0, [0.25] * 6), (0, [0.25] * 6),
           (1, [9.0] * 6), (1, [-9.0] * 6), (905, [1.0, 2.0])]


@pytest.mark.parametrize("width, parts, entries", [(6, 2, 4), (8, 8, 5), (7, 3, 16), (5, 1, 3)])
def test_against_plain_arithmetic(spark, monkeypatch, width, parts, entries):
    monkeypatch.setattr(vector_codes, "ROWS", 17)
    rows = clustered(width, 120, width) + clustered(1, 10, width) + [
        (i, v and [*v, 0.5][:width]) for i, v in AWKWARD]
    got, books = compress(spark, table(spark, rows), parts, entries, rounds=3, scale=64)
    codes, want = brute(rows, parts, entries, 3, 64)
    assert books == want
    assert got.columns == ["vec_id", "label", "whole_numbers", "code", "error"]
    assert sorted(map(tuple, got.select("vec_id", "code", "error").collect()), key=repr) \
        == sorted(codes, key=repr)


def test_numbers_beyond_longs_stay_exact(spark):
    rows = [(i, [x * 10.0 ** 9, -x * 10.0 ** 9, 1.0]) for i, x in enumerate((1, 2, 3, 9, 10, 11))]
    got, books = compress(spark, table(spark, rows), 1, 2, 2, 4096)
    codes, want = brute(rows, 1, 2, 2, 4096)
    assert books == want
    assert sorted(r["error"] for r in got.select("error").collect()) == sorted(c[2] for c in codes)


def test_few_or_no_rows(spark):
    got, books = compress(spark, table(spark, []))
    assert books == [] and got.collect() == [] and "code" in got.columns
    got, books = compress(spark, table(spark, [(None, [1.0] * 8), (4, None)]))
    assert [r["error"] for r in got.collect()] == [0] and len(books[0]) == 1
    assert len(digest(books)) == 64


def test_the_transform_keeps_distances_and_orders_by_sequency():
    draw = np.random.default_rng(2)
    rows = draw.integers(-50, 50, (40, 6))
    turned = walsh(rows)
    for a, b in zip(range(0, 40, 2), range(1, 40, 2)):
        assert ((turned[a] - turned[b]) ** 2).sum() == 8 * ((rows[a] - rows[b]) ** 2).sum()
    changes = (np.diff(np.sign(walsh(np.eye(8, dtype=np.int64))), axis=0) != 0).sum(axis=0)
    assert changes.tolist() == list(range(8))


def test_ties_go_to_the_lower_index():
    entries = np.array([[5, 5], [1, 1], [1, 1], [-1, -1]])
    codes, errors = nearest(np.array([[0, 0], [1, 1], [9, 9], [3, 3]]), entries)
    assert codes.tolist() == [1, 1, 0, 0] and errors.tolist() == [2, 0, 32, 8]
