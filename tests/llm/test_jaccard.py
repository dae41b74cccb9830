"""The n-gram Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest
from rows import AWKWARD, documents

from orderloom.llm import jaccard
from orderloom.llm.count_tree import CountTree, shared_at_least
from orderloom.llm.jaccard import cells, jaccard_groups, shingles, steps


def plain_set(text, size=3):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} \
        if words else set()


def brute(rows, percent=90, size=3):
    sets = [plain_set(t, size) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)), key=repr)


def got(spark, rows, **options):
    return sorted(map(tuple, jaccard_groups(spark, documents(spark, rows), **options).collect()),
                  key=repr)


def families(seed, n, words=60, edits=4):
    """Texts that differ from a few others in some words, and those again."""
    draw = random.Random(seed)
    known = [[f"w{draw.randrange(4000)}" for _ in range(draw.randint(9, words))]
             for _ in range(max(2, n // 12))]
    for _ in range(n):
        text = list(draw.choice(known))
        for _ in range(draw.randint(0, edits)):
            at = draw.randrange(len(text))
            if draw.random() < 0.5:
                text[at] = f"w{draw.randrange(4000)}"
            else:
                text.insert(at, f"w{draw.randrange(4000)}")
        known.append(text)
    draw.shuffle(known)
    return [(i, " ".join(t)) for i, t in enumerate(known)]


@pytest.mark.parametrize("seed, block, percent, words", [
    (1, 512, 90, 60), (2, 4, 90, 200), (3, 512, 70, 40)])
def test_against_all_pairs(spark, monkeypatch, seed, block, percent, words):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "ENTRIES", 200)
    rows = families(seed, 260, words)
    want = brute(rows, percent)
    assert got(spark, rows, percent=percent) == want
    assert len({r[2] for r in want}) < len({frozenset(plain_set(t)) for _, t in rows})


def test_a_crowded_cell_of_unlike_members_and_chains(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    common, rows = [f"c{i}" for i in range(150)], []
    for family in range(12):
        own = [f"f{family}-{i}" for i in range(40)]
        for k in range(8):
            # Neighbours in a family differ little, its ends much, families more.
            rows.append((100 * family + k, " ".join(
                common + own[:40 - 3 * k] + [f"x{family}-{i}" for i in range(2 * k)])))
    want = brute(rows)
    assert got(spark, rows) == want
    assert 1 < len({r[2] for r in want}) < len(rows)


def test_rows(spark):
    rows = [*AWKWARD, (11, "one"), (12, "ONE"), (13, "one two"), (14, "One\x0btwo"), (15, "\x85 é")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    assert got(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_similar_sets_meet_in_a_cell():
    draw = random.Random(9)
    for _ in range(300):
        size, percent = draw.randint(1, 400), draw.choice([90, 80, 97])
        a = {draw.getrandbits(64) for _ in range(size)}
        b = set(a)
        while 100 * len(a & b) >= percent * len(a | b):
            last = set(b)
            if b and draw.random() < 0.5:
                b.remove(next(iter(b & a or b)))
            else:
                b.add(draw.getrandbits(64))
        x, y = (np.array(sorted(s), np.uint64) for s in (a, last))
        assert a == last or set(cells(x, percent)) & set(cells(y, percent))


def test_steps_cover_neighbouring_sizes():
    for percent in (70, 90):
        for size in range(1, 300):
            own = {s for s, _ in steps(size, percent)}
            for other in range(size + 1, size * 100 // percent + 1):
                if 2 * other * (100 - percent) >= 100 + percent:
                    assert own & {s for s, _ in steps(other, percent)}, (size, other)


@pytest.mark.parametrize("percent", [90, 60])
def test_tree_leaves_all_pairs_that_points_leave(percent):
    draw = np.random.default_rng(percent)
    centres = draw.integers(0, 20, (5, 12))
    points = np.maximum(0, centres[draw.integers(0, 5, 300)] + draw.integers(-2, 3, (300, 12)))
    sizes, groups = points.sum(axis=1), draw.integers(0, 40, 300)

    def plain(a, b):
        return {(i, j) for i in a for j in b if groups[i] != groups[j]
                and 100 * min(sizes[i], sizes[j]) >= percent * max(sizes[i], sizes[j])
                and np.minimum(points[i], points[j]).sum()
                >= shared_at_least(sizes[i] + sizes[j], percent)}

    whole = CountTree(points, sizes, groups)
    left, right = whole.join(whole, percent)
    pairs = set(map(frozenset, zip(left.tolist(), right.tolist())))
    assert len(pairs) == len(left) and pairs == set(map(frozenset, plain(range(300), range(300))))
    one, two = (CountTree(points[s], sizes[s], groups[s]) for s in (slice(0, 20), slice(20, 300)))
    left, right = one.join(two, percent)
    assert set(zip(left.tolist(), (right + 20).tolist())) == plain(range(20), range(20, 300))
    left, right = two.join(one, percent)
    assert set(zip((left + 20).tolist(), right.tolist())) == plain(range(20, 300), range(20))


def test_shingles_are_distinct():
    assert len(shingles("a b c a b c a b", 3)) == 3
    assert len(shingles("A b", 3)) == 1 and len(shingles(" \n", 3)) == 0
