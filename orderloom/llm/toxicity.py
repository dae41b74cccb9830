"""Toxicity of whole texts from averaged subword embeddings.

Every word stands for its character n-grams, ends marked; each n-gram, by a hash, for an
embedding. A text is the average of the embeddings of all its n-grams, each counted once per
``WINDOW`` characters, and of ``PADDING`` neutral ones, so that neither a repeated word nor a
few n-grams of a short text decide alone. A linear softmax on the average gives the class. Embeddings and softmax are trained jointly, in numpy, by minibatch
Adam. An unseen spelling shares most n-grams with the words it comes from, so it scores alike.

The fit reads a bounded sample of labelled rows: at most ``PER_CLASS`` texts of each class, of
at most ``LONGEST`` characters, in the order of a hash, then the beginnings of longer ones. The shares of the classes among all
labelled rows, not those in the sample, set the scale of scores. N-grams in fewer than
``LEAST_TEXTS`` sample texts are not embedded. Scoring reads whole texts, in runs of bounded
size, and needs the softmax of each embedding only: averages commute with it.

NULL texts count as empty; a text without n-grams has the score of an empty sum, that of the
classes alone. Without labelled texts of both classes every score is the share of class 1 (0
if nothing is labelled). Labels that contradict each other for one id are not learned from.
Rows pass one for one, repeated rows and NULL ids alike; only id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .grams import characters, runs, within_words

SIZES = (3, 4, 5, 6)
BUCKETS, WIDTH = 1 << 16, 8
PER_CLASS = {0: 6000, 1: 2500}
LONGEST = 8000
LEAST_TEXTS = 20
EPOCHS, STEPS, MINIBATCH, RATE, DECAY = 4, 240, 128, 0.05, 0.05
# Averages are of many embeddings; this brings them to the size of one.
GAIN = 100.0
WINDOW, PADDING = 2000, 100
THRESHOLD = 0.3
_ROWS = 256


def _buckets(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hash buckets of the words' n-grams of one size."""
    at = within_words(codes, size)
    hashed, wide = np.full(len(at), size, np.uint64), codes.astype(np.uint64)
    for k in range(size):
        hashed = (hashed ^ wide[at + k]) * np.uint64(0x100000001B3)
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    return at, ((hashed >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int64)


def _occurrences(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and buckets of the texts' n-grams, once per window, run by run."""
    for parts, owners in runs(texts, _ROWS, WINDOW):
        codes, part = characters(parts, "isalnum")
        present = np.zeros((len(parts), BUCKETS), bool)
        for size in SIZES:
            at, bucket = _buckets(codes, size)
            present[part[at], bucket] = True
        window, bucket = np.divmod(np.flatnonzero(present), BUCKETS)
        yield np.array(owners)[window], bucket


@dataclass
class _Bags:
    """The texts' buckets, text after text, and how many windows have each, in a few bytes."""

    buckets: np.ndarray
    counts: np.ndarray
    ends: np.ndarray
    scales: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> "_Bags":
        buckets, counts, scales = [np.zeros(0, np.uint16)], [np.zeros(0, np.uint8)], []
        ends = [0]
        for start in range(0, len(texts), _ROWS):
            found: list[list[np.ndarray]] = [[] for _ in texts[start:start + _ROWS]]
            for rows, bucket in _occurrences(texts[start:start + _ROWS]):
                cuts = np.flatnonzero(np.diff(rows)) + 1
                for own, part in zip(rows[np.append(0, cuts)] if len(rows) else [],
                                     np.split(bucket, cuts)):
                    found[own].append(part)
            for parts in found:
                bucket, n = np.unique(np.concatenate([np.zeros(0, np.int64), *parts]),
                                      return_counts=True)
                buckets.append(bucket.astype(np.uint16))
                counts.append(np.minimum(n, 255).astype(np.uint8))
                scales.append(GAIN / (n.sum() + PADDING))
                ends.append(ends[-1] + len(bucket))
            # Many small arrays would keep the process large after they are gone.
            buckets, counts = [np.concatenate(buckets)], [np.concatenate(counts)]
        return cls(buckets[0], counts[0], np.array(ends), np.array(scales, np.float32))

    def drop(self, kept: np.ndarray) -> "_Bags":
        """Only the buckets that are kept; the scales stay."""
        stays = kept[self.buckets]
        ends = np.append(0, np.cumsum(stays))[self.ends]
        return _Bags(self.buckets[stays], self.counts[stays], ends, self.scales)

    def some(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, weights in the average and texts' places, of some texts."""
        spans = [slice(self.ends[i], self.ends[i + 1]) for i in texts]
        place = np.repeat(np.arange(len(texts)), [s.stop - s.start for s in spans])
        return (np.concatenate([self.buckets[s] for s in spans]),
                np.concatenate([self.counts[s] for s in spans]) * self.scales[texts][place], place)


@dataclass
class SubwordModel:
    """``table`` holds, per bucket, the log odds that an average made of it alone would give."""

    table: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for row, bucket in _occurrences(texts):
            total += np.bincount(row, self.table[bucket], len(texts))
            count += np.bincount(row, minlength=len(texts))
        odds = total / (count + PADDING) + self.bias
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def _shift(odds: np.ndarray, target: np.ndarray, share: float) -> float:
    """What to add to the odds so that the threshold of highest F1 becomes ``THRESHOLD``."""
    weight = np.where(target == 1, share / max(1, target.sum()),
                      (1 - share) / max(1, (1 - target).sum()))
    order = np.argsort(-odds)
    hits = np.cumsum((weight * target)[order])
    f1 = 2 * hits / (np.cumsum(weight[order]) + share)
    near = np.flatnonzero(f1 >= f1.max() - 0.002)
    best = odds[order][near[len(near) // 2]]
    return math.log(THRESHOLD / (1 - THRESHOLD)) - float(best)


def fit(texts: list[str], labels: list[int], share: float, seed: int = 7) -> SubwordModel:
    """``share`` is that of class 1 among all labelled rows."""
    kept_back = np.arange(len(texts)) % 5 == 4
    learned = np.flatnonzero(~kept_back)
    target = np.array(labels, np.float32)
    model = _fit([texts[i] for i in learned], target[learned], share, seed)
    rest = np.flatnonzero(kept_back)
    if 0 < target[rest].sum() < len(rest) and model.table.any():
        scores = np.clip(model.scores([texts[i] for i in rest]), 1e-12, 1 - 1e-12)
        model.bias += _shift(np.log(scores / (1 - scores)), target[rest], share)
    return model


def _fit(texts: list[str], target: np.ndarray, share: float, seed: int) -> SubwordModel:
    table = np.zeros(BUCKETS)
    if not 0 < target.sum() < len(target) or not 0 < share < 1:
        return SubwordModel(table, math.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    bags = _Bags.of(texts)
    kept = np.bincount(bags.buckets, minlength=BUCKETS) >= min(
        LEAST_TEXTS, max(2, len(texts) // 400))
    bags = bags.drop(kept)
    draw = np.random.default_rng(seed)
    embedding = draw.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    softmax = draw.uniform(-0.5, 0.5, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    weights = [embedding, softmax, bias]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    turns = -(-len(texts) // MINIBATCH)
    epochs = max(EPOCHS, -(-STEPS // turns))
    for step in range(1, epochs * turns + 1):
        if (step - 1) % turns == 0:
            order = draw.permutation(len(texts))
        start = (step - 1) % turns * MINIBATCH
        some = order[start:start + MINIBATCH]
        bucket, weight, text = bags.some(some)
        average = np.stack([np.bincount(text, embedding[bucket, k] * weight, len(some))
                            for k in range(WIDTH)], axis=1)
        odds = average @ softmax + bias
        chance = np.exp(odds - odds.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        wrong = (chance - np.stack([1 - target[some], target[some]], axis=1)) / len(some)
        back = wrong @ softmax.T
        slopes = (np.stack([np.bincount(bucket, weight * back[text, k], BUCKETS)
                            for k in range(WIDTH)], axis=1), average.T @ wrong, wrong.sum(axis=0))
        rate = RATE * (1 - (step - 1) / (epochs * turns))
        for own, slope, mean, square in zip(weights, slopes, first, second):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            own -= rate * (mean / (1 - 0.9 ** step)) / (
                np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        embedding *= 1 - rate * DECAY
    table[kept] = GAIN * (embedding[kept] @ (softmax[:, 1] - softmax[:, 0]))
    return SubwordModel(table.astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, learn: Column, label_column: str = "toxic",
          id_column: str = "doc_id", text_column: str = "text") -> SubwordModel:
    """The model of the labelled rows for which ``learn``, a condition on the id, holds."""
    marked = labels.where(learn).groupBy(id_column).agg(
        F.min(label_column).alias("label"), F.max(label_column).alias("other")).where(
        (F.col("label") == F.col("other")) & F.col("label").isin(0, 1)
        & F.col(id_column).isNotNull())
    counts = {r["label"]: r["n"] for r in
              marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    sample: list[tuple[str, int]] = []
    # Of a longer text its beginning, where there are too few others.
    text = F.col(text_column)
    texts = docs.select(F.col(id_column).alias("id"), (F.length(text) > LONGEST).alias("long"),
                        F.left(text, F.lit(LONGEST)).alias("text")).where(F.length("text") > 0)
    for label, most in PER_CLASS.items():
        # Twice as many ids as texts: some texts are missing, or long and come last.
        ids = marked.where(F.col("label") == label).select(F.col(id_column).alias("id")).orderBy(
            F.xxhash64("id"), "id").limit(2 * most)
        rows = texts.join(F.broadcast(ids), "id").orderBy(
            "long", F.xxhash64("id"), "id", "text").limit(most)
        sample += [(r["text"], label) for r in rows.select("id", "text").collect()]
    return fit([t for t, _ in sample], [y for _, y in sample], share)


def toxicity(model: SubwordModel, text: Column) -> Column:
    """The score of a text column, as a column."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return score(text)
