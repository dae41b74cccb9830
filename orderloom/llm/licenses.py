"""Licence paragraphs in documents, by a classifier trained on templates and confirmed by them.

Paragraphs are the lines of a text. A sparse logistic regression over word unigrams and bigrams,
hashed to ``BUCKETS``, tells the licence families of ``license_texts``, rights notices of no
family (``unknown``) and "none" apart. It is trained here, by proximal gradient steps on the
driver, from features that Spark makes of a bounded sample: windows of the templates, short forms
and rights notices and, as "none", other fixed paragraphs and at most ``SAMPLE`` paragraphs of
the corpus that share no bigram with these, by a hash; of a line, its first ``LONGEST``
characters. The bound below which a paragraph is of an ``unknown`` licence is found by a fit
without the last template of every family and a fifth of the corpus's paragraphs: it is the lowest
probability at which at least ``PRECISION`` of the licences found in those are right. The
weights are then fitted to all.

Every paragraph with a word is scored. What "none" wins by the sum, over the features, of the
most that any other class has over "none" is left out first: that sum is no less than the lead of
any class, so no finding is lost.

A finding is confirmed if the templates of its family agree: the share of the paragraph's bigrams
that the family's templates and short forms hold, or of one template's bigrams that the paragraph
holds, reaches ``SIMILAR``. It takes ``SHARED`` bigrams, or a paragraph that is a short form of
one. Rights notices of no family are never confirmed.

A document has a row per finding, none if it has no licence. NULL, empty and blank texts have
none. Repeated rows repeat their findings; equal probabilities go to "none", then to the class
first in order of name. Texts are scanned whole, row by row, with no shuffle; an empty table
gives an empty result, and other columns than id and text are not looked at.
"""

from __future__ import annotations

import json
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .license_texts import OTHERS, RIGHTS, SHORT, TEMPLATES
from .literals import doubles, let

BUCKETS, SEEN = 4096, 1 << 16
SAMPLE, LONGEST = 1000, 8000
STEPS, RATE, SPARSITY = 60, 20.0, 2e-5
SHARED, SIMILAR, PRECISION = 2, 0.6, 0.98
NONE, UNKNOWN = "none", "unknown"
# Words per window of a template, and the step between windows.
WINDOWS, STRIDE = (5, 8, 12, 20, 40), 3


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+(?:\.[0-9]+)*)"))


def bigrams(found: Column) -> Column:
    """A number for each pair of neighbouring words."""
    return F.zip_with(F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))),
                      F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0))),
                      lambda a, b: F.xxhash64(a, b))


def _features(found: Column, pairs: Column) -> Column:
    """Distinct buckets of the words and bigrams, and one more that all paragraphs have."""
    return F.array_distinct(F.concat(
        F.array(F.lit(BUCKETS)),
        F.transform(found, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int")),
        F.transform(pairs, lambda p: F.pmod(p, F.lit(BUCKETS)).cast("int"))))


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few fixed rows."""
    return spark.range(1).select(F.explode(F.from_json(
        F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


@dataclass
class LicenseModel:
    families: list[str]                  # "none", then the others, "unknown" included
    weights: np.ndarray                  # families by buckets
    bound: float
    seen: list[int]                      # slots of the bigrams of all known texts, sorted
    templates: dict[str, list[list[int]]]
    short: dict[str, list[list[int]]]

    def shared(self, pairs: Column) -> Column:
        """How many bigrams fall in slots of template bigrams."""
        slots = np.zeros(SEEN)
        slots[self.seen] = 1
        table = doubles(slots)
        return F.aggregate(pairs, F.lit(0.0), lambda a, p: a + F.get(
            table, F.pmod(p, F.lit(SEEN)).cast("int")))

    def lead(self, features: Column) -> Column:
        """At least the lead of any class over "none", before scaling."""
        table = doubles((self.weights[1:] - self.weights[0]).max(axis=0))
        return F.aggregate(features, F.lit(0.0), lambda a, f: a + F.get(table, f))

    def odds(self, features: Column) -> Column:
        """Log odds of all families, as one array."""
        size = len(self.families)
        table = doubles(self.weights.T.ravel())
        scale = F.sqrt(F.greatest(F.size(features), F.lit(1)).cast("double"))
        total = F.aggregate(
            features, F.array_repeat(F.lit(0.0), size), lambda a, f: F.zip_with(
                a, F.slice(table, f * size + 1, F.lit(size)), lambda x, y: x + y))
        return F.transform(total, lambda x: x / scale)

    def similarity(self, pairs: Column, family: str) -> Column:
        """Of the family's known texts and the distinct bigrams of a paragraph."""
        def share(held: list[int], whole: Column) -> Column:
            own = F.split(F.lit(",".join(map(str, held))), ",").cast("array<bigint>")
            return F.size(F.array_intersect(pairs, own)) / whole

        texts, short = self.templates[family], self.short[family]
        everything = sorted({p for t in texts + short for p in t})
        single = sorted(t[0] for t in short if len(t) == 1)
        return F.greatest(F.when(F.size(pairs) >= SHARED, share(everything, F.size(pairs))),
                          *[share(t, F.lit(len(t))) for t in texts if len(t) >= SHARED],
                          *[F.when(F.size(pairs) == 1, share(single, F.lit(1.0)))
                            for _ in single[:1]], F.lit(0.0))


def _probabilities(odds: Column) -> Column:
    shares = let(odds, lambda o: F.transform(o, lambda x: F.exp(x - F.array_max(o))))
    return let(shares, lambda s: F.transform(s, lambda x: x / F.aggregate(
        s, F.lit(0.0), lambda a, y: a + y)))


def _windows() -> list[dict]:
    rows = []
    for family, texts in [*TEMPLATES.items(), (NONE, OTHERS)]:
        for number, text in enumerate(texts):
            split = text.split()
            cuts = {tuple(split)} | {tuple(split[i:i + n]) for n in WINDOWS if n < len(split)
                                     for i in range(0, len(split) - n + STRIDE, STRIDE)}
            rows += [{"family": family, "template": number, "text": " ".join(c),
                      "whole": len(c) == len(split)}
                     for c in sorted(cuts) if len(c) >= min(WINDOWS) or len(c) == len(split)]
    # Never kept back; in a family, all short forms together weigh as much as a template.
    rows += [{"family": f, "template": -1, "text": t, "whole": True}
             for f, texts in SHORT.items() for t in texts]
    return rows + [{"family": UNKNOWN, "template": i, "text": t, "whole": True}
                   for i, t in enumerate(RIGHTS)]


def paragraphs(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(id_column, F.posexplode(F.split(F.col(text_column), "\n")).alias(
        "paragraph", "line"))


def _sparse(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features row after row, where each row starts, and the length of its vector."""
    sizes = np.array([len(r["features"]) for r in rows], int)
    flat = np.concatenate([np.zeros(0, int), *(r["features"] for r in rows)]).astype(int)
    return flat, np.cumsum(sizes) - sizes, np.sqrt(np.maximum(sizes, 1))


def _chances(weights: np.ndarray, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray
             ) -> np.ndarray:
    """Probabilities, families by rows."""
    odds = np.add.reduceat(weights[:, flat], starts, axis=1) / lengths if len(starts) else \
        np.zeros((len(weights), 0))
    shares = np.exp(odds - odds.max(axis=0, initial=-np.inf))
    return shares / shares.sum(axis=0)


def _fit(families: list[str], rows: list) -> np.ndarray:
    """Weights by accelerated proximal gradient steps over the sample."""
    counts = Counter((r["family"], r["template"]) for r in rows)
    texts = Counter(f for f, _ in counts)
    # "none" weighs as much as all other classes, these weigh the same, and in each every
    # template does, however many windows it has; of "none", the corpus weighs half.
    def share(family: str, template: int) -> float:
        if family != NONE:
            return 0.5 / (len(families) - 1) / texts[family]
        corpus = (NONE, -1) in counts
        return 0.25 if template < 0 else (0.25 / (texts[NONE] - 1) if corpus else 0.5 / texts[NONE])

    weight = np.array([share(r["family"], r["template"]) / counts[r["family"], r["template"]]
                       for r in rows])
    flat, starts, lengths = _sparse(rows)
    own = np.array([[r["family"] == f for r in rows] for f in families], float)
    of_row = np.repeat(np.arange(len(rows)), np.diff(np.append(starts, len(flat))))
    ahead = before = np.zeros((len(families), BUCKETS + 1))
    for step in range(1, STEPS + 1):
        wrong = (_chances(ahead, flat, starts, lengths) - own) * weight / lengths
        slope = np.stack([np.bincount(flat, w[of_row], BUCKETS + 1) for w in wrong])
        now = ahead - RATE * slope
        now = np.sign(now) * np.maximum(np.abs(now) - RATE * SPARSITY, 0)
        ahead, before = now + (step - 1) / (step + 2) * (now - before), now
    return before


def train(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id",
          text_column: str = "text", sample: int = SAMPLE) -> LicenseModel:
    families = [NONE, *sorted([*TEMPLATES, UNKNOWN])]
    kinds = {"template": TEMPLATES, "short": SHORT, "rights": {UNKNOWN: RIGHTS}}
    fixed = _table(spark, [{"kind": k, "family": f, "text": t} for k, known in kinds.items()
                           for f, texts in sorted(known.items()) for t in texts],
                   "kind string, family string, text string")
    known: dict[str, dict[str, list[list[int]]]] = {k: {f: [] for f in families} for k in kinds}
    for r in fixed.select("kind", "family", F.array_distinct(bigrams(words(F.col("text")))).alias(
            "p")).collect():
        known[r["kind"]][r["family"]].append(list(r["p"]))
    seen = sorted({p % SEEN for k in known.values() for texts in k.values() for t in texts
                   for p in t})
    model = LicenseModel(families, np.zeros((len(families), BUCKETS + 1)), 0.0, seen,
                         known["template"], known["short"])

    # At most ``sample`` texts of any length, chosen by hashes alone, and as many of their
    # paragraphs, of which at most LONGEST characters are learned from.
    texts = docs.select(F.xxhash64(id_column, text_column).alias("h"), F.col(text_column).alias(
        "text")).where(F.length("text") > 0)
    least = texts.select("h").distinct().orderBy("h").limit(sample)
    some = texts.join(F.broadcast(least), "h").select(F.col("h").alias("id"), "text")
    clean = paragraphs(some, "id", "text").select(
        F.substring("line", 1, LONGEST).alias("line")).distinct().where(let(
        words(F.col("line")), lambda w: (F.size(w) > 0) & (model.shared(bigrams(w)) == 0)
    )).orderBy(F.xxhash64("line"), "line").limit(sample)
    rows = _table(spark, _windows(), "family string, template int, text string, whole boolean").unionByName(
        clean.select(F.lit(NONE).alias("family"), F.lit(-1).alias("template"),
                     F.col("line").alias("text"), F.lit(False).alias("whole")))
    text = F.col("text")
    # At most ``sample`` rows besides those of the fixed paragraphs.
    last = {NONE: len(OTHERS) - 1} | {f: len(texts) - 1 for f, texts in TEMPLATES.items()}
    of_last = F.concat_ws(":", "family", "template").isin([f"{f}:{n}" for f, n in last.items()])
    of_corpus = (F.col("template") < 0) & ~F.col("whole")
    rows = rows.select("family", "template", (of_last | (of_corpus & (F.pmod(
        F.xxhash64("text"), F.lit(5)) == 0))).alias("kept_back"), _features(
        words(text), bigrams(words(text))).alias("features")).collect()
    learned = [r for r in rows if not r["kept_back"]]
    held = [r for r in rows if r["kept_back"]]
    chance = _chances(_fit(families, learned), *_sparse(held))
    # As many digits as a plan's constants keep, so that ``lead`` and ``odds`` add the same numbers.
    model.weights = np.round(_fit(families, rows), 4)
    found = [(p.max(), families[p.argmax()], r["family"]) for p, r in zip(chance.T, held)]
    right = sorted(((p, name == family) for p, name, family in found if name != NONE),
                   reverse=True)
    good = 0
    for i, (p, is_right) in enumerate(right, 1):
        good += is_right
        if good >= PRECISION * i:
            model.bound = p
    return model


def scan(docs: DataFrame, model: LicenseModel, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """Per finding: id, paragraph (number of the line, from 0), family, probability, similarity,
    confirmed."""
    lines = paragraphs(docs, id_column, text_column).select(
        id_column, "paragraph", words(F.col("line")).alias("words"))
    lines = lines.select(id_column, "paragraph", let(bigrams(F.col("words")), lambda p: F.struct(
        F.array_distinct(p).alias("pairs"), _features(F.col("words"), p).alias("features"))
    ).alias("l"))
    # Filtered as an array, so that the features are worked out once a line.
    lines = lines.select(id_column, "paragraph", F.inline(F.filter(
        F.array("l"), lambda l: model.lead(l.features) > -1e-6)))
    names = F.split(F.lit(",".join(model.families)), ",")
    found = let(_probabilities(model.odds(F.col("features"))), lambda p: F.struct(
        F.get(names, (F.array_position(p, F.array_max(p)) - 1).cast("int")).alias("best"),
        F.array_max(p).alias("probability")))
    # Filtered as an array, so that the scores are worked out once a line.
    best = lines.select(id_column, "paragraph", "pairs", F.inline(F.filter(
        F.array(found), lambda f: f.best != NONE)))
    similar = F.coalesce(*[F.when(F.col("best") == f, model.similarity(F.col("pairs"), f))
                           for f in model.families if f not in (NONE, UNKNOWN)], F.lit(0.0))
    sure = F.col("probability") >= F.lit(model.bound)
    return best.withColumn("similarity", similar).select(
        id_column, "paragraph", F.when(sure, F.col("best")).otherwise(UNKNOWN).alias("family"),
        "probability", "similarity", (sure & (F.col("similarity") >= SIMILAR)).alias("confirmed"))
