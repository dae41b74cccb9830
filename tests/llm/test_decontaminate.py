"""Benchmark passages against a search for every window."""

import hashlib
import random

import pytest
from rows import AWKWARD, documents

from orderloom.llm import decontaminate as d


def brute(docs, items, window):
    windows = {}
    for item, text in items:
        words = d.words_of(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i:i + size]), set()).add(item or "")
    rows = []
    for doc_id, text in docs:
        words = d.words_of(text)
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                holders = windows.get(tuple(words[i:i + size]), set())
                if holders:
                    found |= holders
                    hit |= set(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        rows.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(rows, key=repr)


def table(spark, items):
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, hit_items int")


def some(seed, n, words, least, most):
    draw = random.Random(seed)
    return [" ".join(draw.choice(words) for _ in range(draw.randint(least, most)))
            for _ in range(n)]


@pytest.mark.parametrize("shard, at_once", [(200_000, 8), (20, 2)])
def test_against_every_window(spark, monkeypatch, shard, at_once):
    """Few different words, so that items overlap, repeat themselves and contain each other."""
    monkeypatch.setattr(d, "SHARD_WORDS", shard)
    monkeypatch.setattr(d, "SHARDS_AT_ONCE", at_once)
    items = list(enumerate(some(1, 25, "a b É", 1, 14) + some(2, 10, "abc", 3, 40)))
    items = [(str(i), t) for i, t in items] + [("3", "b b b b b b b b"), (None, "zz yy xx"),
                                               ("n", None), ("e", " .! "), ("z", "Hot-Word")]
    docs = list(enumerate(some(3, 60, "a b c É".split(), 0, 60) + ["", None, "Zz, YY xx. hot  word",
                                                                 "zz yy"]))
    got = d.contamination(spark, documents(spark, docs), table(spark, items), window=6)
    assert sorted((tuple(r)[:6] for r in got.collect()), key=repr) == brute(docs, items, 6)


def test_rows(spark):
    items = [("1", "plain text of a few words and"), ("2", "x")]
    got = d.contamination(spark, documents(spark, AWKWARD), table(spark, items), window=5).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == brute(
        [r[:2] for r in AWKWARD], items, 5)
    for r in got:
        spans = [tuple(map(int, s.split("-"))) for s in r["hit_spans"].split(",") if s]
        assert sum(e - s for s, e in spans) == r["n_hit"]
    assert d.contamination(spark, documents(spark, []), table(spark, items)).collect() == []
    clean = d.contamination(spark, documents(spark, AWKWARD), table(spark, [])).collect()
    assert {(r["n_items"], r["contaminated"]) for r in clean} == {(0, False)}
    assert clean[0]["items_sha256"] == hashlib.sha256(b"").hexdigest()


def test_shards_follow_words(spark, monkeypatch):
    """Neither more partitions nor letters outside words make more shards, nor are items lost."""
    monkeypatch.setattr(d, "SHARD_WORDS", 100)
    items = [(str(i), ("Aé-9 %d \U00010400x" % i + " .," * 200)) for i in range(75)]
    items += [("0", None), (None, "zz"), ("0", items[0][1])]
    docs = list(enumerate(t for _, t in items[:20]))
    kind = type(spark.range(1))
    dealt = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda self, n, *keys: dealt(
        self, max(n, 40) if keys else n, *keys))
    assert d.shards(spark, table(spark, items[:20]), 10).count() == 1
    # 301 words are 4 shards of nine tenths; hashes deal them unevenly.
    assert 4 <= d.shards(spark, table(spark, items), 10).count() <= 7
    got = d.contamination(spark, documents(spark, docs), table(spark, items))
    assert sorted((tuple(r)[:6] for r in got.collect()), key=repr) == brute(docs, items, 10)


def test_passages_are_cut_and_copies_dropped(spark):
    item = "one two three four five six"
    docs = documents(spark, [
        (1, f"Before it, some words stay here. ONE two -- three\nfour five six! After it too."),
        (2, item + "."), (3, "one two three four five"), (4, None), (5, ""), (6, "Nothing.")])
    kept = d.decontaminate(spark, docs, table(spark, [("q", item)]), window=6)
    assert kept.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert got == {1: "Before it, some words stay here. ! After it too.",
                   3: "one two three four five", 4: None, 5: "", 6: "Nothing."}
