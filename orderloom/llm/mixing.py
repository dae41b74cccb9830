"""Mixing documents so that expected domain tokens match target weights.

A classifier learned from a labelled table gives every document a posterior over domains: a
naive Bayes model of words and word shapes, hashed to ``BUCKETS``, whose average log odds are
sharpened by the factor that has the least log loss on a kept-back fifth. Documents belong
softly to all domains; with n tokens and posterior p, one document adds n p to the totals.

Document rates r >= 0 (expected copies) then solve least squares: sum of r n p against target
weights times ``budget`` tokens. Projected gradient steps start from r = budget / tokens. They
are taken in the metric of tokens, with the residual whitened by H = sum of n p p' (slightly
damped), in which one is a safe step: r becomes max(0, r - p . H^-1 residual). The rates of a row follow from the few
multipliers H^-1 residual so far, so a step is one aggregation over narrow rows (tokens and
posteriors, written once) and nothing else is stored; it costs no shuffle of documents and no
group of them is gathered. Steps end at ``TOLERANCE`` of the budget or after ``STEPS``. Where the
targets cannot be met, as for a domain without documents, the rest is the least-squares rest;
where steps ended short of the targets, ``targets_met`` is false and a warning says by how much.

Whole copies come from rates by rounding with a hash of the row, so their expected number is the
rate. The sample for the classifier is bounded by ``SAMPLE`` labelled documents, in the order of
a hash; totals and rates cover all documents. NULL texts count as empty: no tokens, posterior of
the classes alone. Domains without labelled rows have posterior 0; without any labelled rows all
domains are equal. Repeated rows get equal rates. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_dir
from .batches import fresh
from .literals import doubles

BUCKETS = 4096
SAMPLE = 20_000
SHARPNESS = (0.0, 3.0, 10.0, 30.0, 100.0, 300.0)
STEPS, TOLERANCE, DAMPING = 40, 1e-6, 1e-4


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\\s+"), lambda w: w != "")


def _features(text: Column) -> Column:
    """Buckets of the words and of their shapes, where runs of one kind of letter are one."""
    shape = F.coalesce(text, F.lit(""))
    for kind, letter in (("\\p{Ll}+", "a"), ("\\p{Lu}+", "A"), ("\\p{N}+", "0")):
        shape = F.regexp_replace(shape, kind, letter)
    return F.concat(*[F.transform(_words(t), lambda w: F.pmod(
        F.xxhash64(w), F.lit(BUCKETS)).cast("int")) for t in (F.lower(text), shape)])


@dataclass
class DomainModel:
    domains: list[str]
    shares: list[float]
    weights: list[list[float]]
    sharpness: float = 0.0

    def averages(self, features: Column) -> list[Column]:
        """Average log likelihood of the features under each domain."""
        count = F.greatest(F.size(features), F.lit(1))

        def total(weights: list[float]) -> Column:
            values = doubles(weights)
            return F.aggregate(features, F.lit(0.0), lambda a, f: a + F.get(values, f))

        return [total(w) / count if any(w) else F.lit(0.0) for w in self.weights]

    def posterior(self, averages: list[Column], sharpness: float | None = None) -> list[Column]:
        sharp = self.sharpness if sharpness is None else sharpness
        odds = [F.lit(math.log(s)) + a * F.lit(sharp) if s > 0 else None
                for s, a in zip(self.shares, averages)]
        real = [o for o in odds if o is not None]
        most = F.greatest(*real) if len(real) > 1 else real[0]
        shares = [F.lit(0.0) if o is None else F.exp(o - most) for o in odds]
        total = sum(shares[1:], shares[0])
        return [s / total for s in shares]


def train(spark: SparkSession, docs: DataFrame, labelled: DataFrame, domains: list[str],
          id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE
          ) -> DomainModel:
    """``labelled`` has (id, domain); ids of several domains are not learned from."""
    ids = labelled.where(F.col("domain").isin(domains)).groupBy(F.col(id_column).alias("id")).agg(
        F.min("domain").alias("domain"), F.max("domain").alias("other")).where(
        F.col("domain") == F.col("other")).select("id", "domain").where(
        F.col("id").isNotNull()).orderBy(F.xxhash64("id"), "id").limit(sample)
    path = scratch_dir(spark, "mixing")
    # At most ``sample`` ids are broadcast.
    docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(
        F.broadcast(ids), "id").select(
        "domain", (F.pmod(F.xxhash64("id"), F.lit(5)) == 0).alias("kept_back"),
        _features(F.col("text")).alias("features")).write.parquet(path)
    rows = spark.read.parquet(path)
    known = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if not known:
        return DomainModel(domains, [1 / len(domains)] * len(domains), [[0.0]] * len(domains))
    # At most BUCKETS rows per domain.
    counts = {d: np.ones(BUCKETS) for d in domains}
    for r in rows.where(~F.col("kept_back")).select("domain", F.explode("features").alias("f")
                                                    ).groupBy("domain", "f").count().collect():
        counts[r["domain"]][r["f"]] += r["count"]
    logs = {d: np.log(c / c.sum()) for d, c in counts.items()}
    middle = np.mean([logs[d] for d in known], axis=0)
    model = DomainModel(
        domains, [known.get(d, 0) / sum(known.values()) for d in domains],
        [(logs[d] - middle).tolist() if d in known else [0.0] for d in domains])
    scored = rows.where("kept_back").select("domain", "features").select(
        "domain", *[a.alias(f"s{i}") for i, a in enumerate(model.averages(F.col("features")))])
    own = [F.col(f"s{i}") for i in range(len(domains))]

    def loss(sharp: float) -> Column:
        chance = model.posterior(own, sharp)
        right = sum((F.when(F.col("domain") == d, c).otherwise(0.0)
                     for d, c in zip(domains, chance)), F.lit(0.0))
        return F.sum(-F.log(F.greatest(right, F.lit(1e-9))))

    losses = scored.agg(*[loss(s).alias(f"l{i}") for i, s in enumerate(SHARPNESS)]).first()
    if losses[0] is not None:
        model.sharpness = SHARPNESS[min(range(len(SHARPNESS)), key=lambda i: losses[i])]
    return model


def memberships(docs: DataFrame, model: DomainModel, tokens: str, prefix: str,
                text_column: str = "text") -> DataFrame:
    """``docs`` with the number of words and one posterior column per domain."""
    features = fresh(docs, "features")
    averages = [fresh(docs, f"average{i}") for i in range(len(model.domains))]
    marked = docs.withColumn(features, _features(F.col(text_column)))
    marked = marked.select("*", *[a.alias(n) for n, a in zip(
        averages, model.averages(F.col(features)))])
    chance = model.posterior([F.col(a) for a in averages])
    return marked.select(*docs.columns, F.size(_words(F.col(text_column))).cast("long").alias(
        tokens), *[c.alias(f"{prefix}{d}") for d, c in zip(model.domains, chance)])


def rate(shares: list[str], start: float, multipliers: list[list[float]]) -> Column:
    """The rate of a row after the steps taken so far."""
    now = F.lit(float(start))
    for step in multipliers:
        move = sum((F.col(s) * F.lit(m) for s, m in zip(shares, step)), F.lit(0.0))
        now = F.greatest(F.lit(0.0), now - move)
    return now


def fit_rates(rows: DataFrame, tokens: str, shares: list[str], weights: list[float],
              budget: float | None = None) -> tuple[float, list[list[float]], bool]:
    """The starting rate, the multipliers of each step, and whether they meet the targets."""
    size = len(shares)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = rows.agg(F.sum(tokens).alias("n"), *[
        F.sum(F.col(tokens) * F.col(shares[i]) * F.col(shares[j])).alias(f"h{i}_{j}")
        for i, j in pairs]).first()
    total = float(sums["n"] or 0)
    budget = total if budget is None else float(budget)
    if not total:
        return 1.0, [], True
    metric = np.zeros((size, size))
    for i, j in pairs:
        metric[i, j] = metric[j, i] = sums[f"h{i}_{j}"]
    # Directions in which the posteriors hardly differ are left almost as they are.
    metric += DAMPING * np.trace(metric) * np.eye(size)
    whiten = np.linalg.inv(metric)
    target = budget * np.array(weights, float) / sum(weights)
    start, multipliers = budget / total, []
    # The last turn takes no step; it tells where the steps have led.
    for turn in range(STEPS + 1):
        now = rate(shares, start, multipliers)
        got = rows.select(now.alias("r"), tokens, *shares).agg(
            *[F.sum(F.col("r") * F.col(tokens) * F.col(s)) for s in shares]).first()
        rest = np.array([float(x) for x in got]) - target
        step = whiten @ rest
        # Nine digits: sums differ in the last ones between runs, rates shall not.
        step = [float(f"{m:.9g}") for m in step]
        met = bool(np.abs(rest).max() <= TOLERANCE * budget)
        if met or not any(step) or turn == STEPS:
            break
        multipliers.append(step)
    if not met:
        warnings.warn(f"targets missed by {np.abs(rest).max() / budget:.2g} of the tokens "
                      f"after {len(multipliers)} steps", stacklevel=2)
    return start, multipliers, met


def _copies(rate: Column, row: list[str]) -> Column:
    draw = F.shiftrightunsigned(F.xxhash64(*row), 11).cast("double") / F.lit(float(2 ** 53))
    return F.floor(rate + draw).cast("long")


def mix(spark: SparkSession, docs: DataFrame, model: DomainModel, targets: dict[str, float],
        budget: float | None = None, id_column: str = "doc_id", text_column: str = "text"
        ) -> DataFrame:
    """Per row: id, n_tokens, a posterior p_<domain> for each domain, rate, n_copies, and
    targets_met, the same in every row."""
    shares = [f"p_{d}" for d in model.domains]
    path = scratch_dir(spark, "mixing")
    memberships(docs.select(id_column, text_column), model, "n_tokens", "p_", text_column
                ).withColumn("draw", F.xxhash64(id_column, text_column)).drop(
        text_column).write.parquet(path)
    rows = spark.read.parquet(path)
    start, steps, met = fit_rates(rows, "n_tokens", shares,
                                  [targets[d] for d in model.domains], budget)
    return rows.withColumn("rate", rate(shares, start, steps)).withColumn(
        "n_copies", _copies(F.col("rate"), ["draw"])).drop("draw").withColumn(
        "targets_met", F.lit(met))


def resample(spark: SparkSession, docs: DataFrame, model: DomainModel, targets: dict[str, float],
             budget: float | None = None, id_column: str = "doc_id", text_column: str = "text"
             ) -> DataFrame:
    """``docs`` that the mixture takes, with their rate and n_copies (1 or more)."""
    tokens, prefix = fresh(docs, "n_tokens"), "p_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    shares = [f"{prefix}{d}" for d in model.domains]
    # Stored with the texts, so that these are worked through once; fitting reads the narrow columns.
    path = scratch_dir(spark, "mixing")
    marked = memberships(docs, model, tokens, prefix, text_column)
    draw = fresh(marked, "draw")
    marked.withColumn(draw, F.xxhash64(id_column, text_column)).write.parquet(path)
    rows = spark.read.parquet(path)
    start, steps, _ = fit_rates(rows, tokens, shares, [targets[d] for d in model.domains], budget)
    own, copies = fresh(docs, "rate"), fresh(docs, "n_copies")
    # A row's own hash is hashed once more, as in mix, so both draw alike.
    now = rate(shares, start, steps)
    return rows.withColumn(own, now).withColumn(copies, _copies(F.col(own), [draw])).where(
        F.col(copies) > 0).select(*docs.columns, own, copies)
