"""Language of whole texts by string kernels.

The kernel of two texts is the blended spectrum kernel over presence: the number of character
n-grams of 1 to 3 characters that both have, over the geometric mean of how many each has.
``LANDMARKS`` training texts span a Nyström approximation of its feature space, in which kernel
ridge regression is fitted for each language against the rest. A text's language is the one of
the highest regression value; its score maps the lead over the next to 0 to 1.

Scoring is by batched matrix products: presence of the landmarks' n-grams in a block of texts,
times the landmarks' own, gives the block's kernel rows, and these times the regression weights
give all values. The fit reads a bounded sample: up to ``PER_LANGUAGE`` texts per language, of
``SHORTEST`` to ``LONGEST`` characters where there are such, in the order of a hash, then shorter
ones, then one window of ``LONGEST`` characters of each longer one; copies count once. N-grams
lie within words, ends marked, case aside; scored texts are read whole, in runs of bounded size.

A NULL text, or one without a letter, is ``und`` with score 0; so is every text if no language
was learned. With one language learned, all others are that one. Equal values go to the
language first in order of name. Rows pass one for one, repeated rows and NULL ids alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_dir
from .grams import characters, runs, within_words

SIZES = (1, 2, 3)
LANDMARKS = 96
PER_LANGUAGE = 400
SHORTEST, LONGEST = 200, 6000
RIDGE = 1e-3
UNKNOWN = "und"
# Texts scored at a time; 9 bits of an n-gram's key tell them apart.
_ROWS = 512
_KEY_BITS = 50


def _keys(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of n-grams of one size within words, and a number for each: 16 bits a character
    (rare characters beyond share numbers) and its size."""
    at, wide = within_words(codes, size), codes.astype(np.int64) & 0xFFFF
    key = np.full(len(at), size, np.int64)
    for k in range(size):
        key = (key << 16) | wide[at + k]
    return at, key


def _present(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct n-grams of each text."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for parts, owners in runs(texts, _ROWS):
        codes, part = characters(parts, "isalpha")
        keys = []
        for size in SIZES:
            at, key = _keys(codes, size)
            keys.append((part[at] << _KEY_BITS) | key)
        both = np.unique(np.concatenate(keys))
        cuts = np.searchsorted(both, np.arange(1, len(parts)) << _KEY_BITS)
        for owner, own in zip(owners, np.split(both & ((1 << _KEY_BITS) - 1), cuts)):
            found[owner].append(own)
    return [f[0] if len(f) == 1 else np.unique(np.concatenate([np.zeros(0, np.int64), *f]))
            for f in found]


@dataclass
class KernelModel:
    languages: list[str]
    grams: np.ndarray       # sorted n-grams of the landmarks
    landmarks: np.ndarray   # n-grams by landmarks: presence over the root of the landmark's count
    weights: np.ndarray     # landmarks by languages

    def kernel(self, present: list[np.ndarray]) -> np.ndarray:
        """Kernel values of texts, given by their n-grams, with the landmarks."""
        block = np.zeros((len(present), len(self.grams)), np.float32)
        for i, keys in enumerate(present):
            at = np.searchsorted(self.grams, keys)
            known = at < len(self.grams)
            known[known] = self.grams[at[known]] == keys[known]
            block[i, at[known]] = 1
        counts = np.array([max(1, len(keys)) for keys in present], np.float32)
        return (block @ self.landmarks) / np.sqrt(counts)[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for start in range(0, len(texts), _ROWS):
            present = _present(texts[start:start + _ROWS])
            if not self.languages:
                names += [UNKNOWN] * len(present)
                scores += [0.0] * len(present)
                continue
            values = self.kernel(present) @ self.weights
            order = np.argsort(-values, axis=1, kind="stable")
            best = np.take_along_axis(values, order, 1)
            lead = best[:, 0] - (best[:, 1] if values.shape[1] > 1 else -1)
            for keys, first, ahead in zip(present, order[:, 0], lead):
                names.append(self.languages[first] if len(keys) else UNKNOWN)
                scores.append(float(min(1.0, (1 + ahead / 2) / 2)) if len(keys) else 0.0)
        return names, scores


def fit(texts: list[str], labels: list[str], landmarks: int = LANDMARKS) -> KernelModel:
    languages = sorted(set(labels))
    present = _present(texts)
    # Landmarks are dealt out over the languages in turn.
    drawn = dict.fromkeys(languages, 0)
    turns = []
    for i, label in enumerate(labels):
        if len(present[i]):
            turns.append((drawn[label], i))
            drawn[label] += 1
    chosen = [present[i] for _, i in sorted(turns)[:landmarks]]
    grams = np.unique(np.concatenate([np.zeros(0, np.int64), *chosen]))
    marks = np.zeros((len(grams), len(chosen)), np.float32)
    for k, keys in enumerate(chosen):
        marks[np.searchsorted(grams, keys), k] = 1 / np.sqrt(len(keys))
    model = KernelModel(languages if chosen else [], grams, marks,
                        np.zeros((len(chosen), len(languages)), np.float32))
    if not chosen:
        return model
    among = model.kernel(chosen).astype(float)
    size, axes = np.linalg.eigh((among + among.T) / 2)
    kept = size > size[-1] * 1e-6
    whiten = axes[:, kept] / np.sqrt(size[kept])
    features = np.concatenate([model.kernel(present[i:i + _ROWS]).astype(float) @ whiten
                               for i in range(0, len(present), _ROWS)])
    target = np.where(np.array(labels)[:, None] == np.array(languages), 1.0, -1.0)
    # Every language weighs the same, however many of its texts were drawn.
    weight = np.array([len(labels) / labels.count(l) for l in labels])[:, None]
    gram = features.T @ (features * weight)
    gram += RIDGE * weight.sum() * np.eye(len(gram))
    model.weights = (whiten @ np.linalg.solve(gram, features.T @ (target * weight))
                     ).astype(np.float32)
    return model


def train(docs: DataFrame, learn: Column, label_column: str = "lang",
          text_column: str = "text") -> KernelModel:
    """The model of the rows for which ``learn`` holds and the label is not NULL."""
    text = F.col(text_column)
    # Of a longer text a window from its first letter on, where there are too few others.
    long = F.length(text) > LONGEST
    window = F.when(long, text.substr(F.regexp_instr(text, F.lit(r"\p{L}")), F.lit(LONGEST)))
    rows = docs.where(learn & F.col(label_column).isNotNull()).where(text.rlike(r"\p{L}")).select(
        F.col(label_column).cast("string").alias("label"), F.coalesce(window, text).alias("text"),
        F.when(long, 2).when(F.length(text) < SHORTEST, 1).otherwise(0).alias("kind"))
    chosen = _chosen(rows.select("label", "kind", F.xxhash64("text").alias("h")))
    sample = rows.withColumn("h", F.xxhash64("text")).join(chosen, ["label", "kind", "h"]).groupBy(
        "label", "place").agg(F.min("text").alias("text")).orderBy("label", "place").collect()
    return fit([r["text"] for r in sample], [r["label"] for r in sample])


def _chosen(hashes: DataFrame) -> DataFrame:
    """(label, kind, h, place): the first ``PER_LANGUAGE`` distinct texts of each label, by kind
    and hash.

    Of each label and kind, only hashes below a bound are ranked, which about four times as many
    texts reach as are wanted: so no task gets more for a label with more texts, or with more
    tasks that read it. Where there are fewer texts, all are ranked.
    """
    counts = hashes.groupBy("label", "kind").agg(F.approx_count_distinct("h").alias("n"))
    part = F.least(F.lit(1.0), F.lit(4.0 * PER_LANGUAGE) / F.greatest("n", F.lit(1)))
    bounds = counts.select("label", "kind", F.when(part < 1, F.floor(
        F.lit(-2.0 ** 63) + part * 2.0 ** 64)).otherwise(F.lit(2 ** 63 - 1)).alias("bound"))
    base = scratch_dir(hashes.sparkSession, "language")
    bounds.write.parquet(f"{base}/bounds")
    bounds = hashes.sparkSession.read.parquet(f"{base}/bounds")
    order = Window.partitionBy("label").orderBy("kind", "h")
    ranked = hashes.join(bounds, ["label", "kind"]).where(F.col("h") <= F.col("bound")).select(
        "label", "kind", "h").distinct().withColumn("place", F.row_number().over(order))
    ranked.where(F.col("place") <= PER_LANGUAGE).write.parquet(f"{base}/chosen")
    return hashes.sparkSession.read.parquet(f"{base}/chosen")
