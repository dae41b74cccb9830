"""SimHash groups against all pairs."""

import random
import re

import pytest
import xxhash
from rows import AWKWARD, documents

from orderloom.llm import simhash
from orderloom.llm.components import components
from orderloom.llm.simhash import fingerprint, groups, simhash_groups


def plain_fingerprint(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def group_of(values, near):
    """The smallest member of each value's group, by all pairs."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if near(a, b):
                a_root, b_root = find(a), find(b)
                root[max(a_root, b_root)] = min(a_root, b_root)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("text", [None, "", " \n\x0b", "One", "a b", "A b C d e f a B c", "é É\x85x \x1c y",
                                  "w " * 70_000])
def test_fingerprint(text):
    assert fingerprint(text, 3, 42) % 2 ** 64 == plain_fingerprint(text)


def clustered(seed, n, flips):
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(12)]
    values = {0, 1, 2 ** 64 - 1, 2 ** 63}
    while len(values) < n:
        value = draw.choice(centres)
        for _ in range(draw.randint(0, flips)):
            value ^= 1 << draw.randrange(64)
        values.add(value)
    return sorted(values)


@pytest.mark.parametrize("paired", [1000, 2])
@pytest.mark.parametrize("bits, segments", [(2, 16), (1, 16), (0, 16), (2, 8)])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, paired, bits, segments):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    values = clustered(bits + segments, 220, 6)
    signed = [v - 2 ** 64 if v >= 2 ** 63 else v for v in values]
    rows = spark.createDataFrame([(v,) for v in signed + signed[:20]], "fp long")
    got = {r["fp"] % 2 ** 64: r["root"] % 2 ** 64
           for r in groups(spark, rows, bits, segments).collect()}
    want = group_of(values, lambda a, b: (a ^ b).bit_count() <= bits)
    assert len({*got.values()}) == len({*want.values()})
    assert all(want[got[v]] == want[v] for v in values)


def test_rows(spark):
    got = simhash_groups(spark, documents(spark, AWKWARD)).collect()
    want = group_of([plain_fingerprint(r[1]) for r in AWKWARD],
                    lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for doc_id, text, *_ in AWKWARD:
        root = want[plain_fingerprint(text)]
        least[root] = min((x for x in (least.get(root), doc_id) if x is not None), default=None)
    assert sorted(map(tuple, got), key=repr) == sorted(
        ((r[0], f"{plain_fingerprint(r[1]):016x}", least[want[plain_fingerprint(r[1])]])
         for r in AWKWARD), key=repr)
    assert simhash_groups(spark, documents(spark, [])).collect() == []


def test_components_of_chains_and_stars(spark):
    draw = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)] \
        + [(draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(60)]
    want = group_of({v for a, b in links if a != b for v in (a, b)},
                    lambda a, b: (a, b) in links or (b, a) in links)
    got = components(spark, spark.createDataFrame(links + links[:5], "u long, v long")).collect()
    assert sorted(map(tuple, got)) == sorted(want.items())
    assert components(spark, spark.createDataFrame([], "u long, v long")).collect() == []
