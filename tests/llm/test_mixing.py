"""Mixing against the same steps in numpy, and its expected totals."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import AWKWARD, documents

from orderloom.llm import mixing
from orderloom.llm.mixing import DomainModel, fit_rates, mix, rate, resample, train

TARGETS = {"a": 0.5, "b": 0.3, "c": 0.2}


def solve(n, p, weights, budget):
    r = np.full(len(n), budget / n.sum())
    metric = (p * n[:, None]).T @ p
    metric += mixing.DAMPING * np.trace(metric) * np.eye(p.shape[1])
    for _ in range(mixing.STEPS):
        rest = (r * n) @ p - budget * weights
        if np.abs(rest).max() <= mixing.TOLERANCE * budget:
            break
        r = np.maximum(0, r - p @ np.linalg.solve(metric, rest))
    return r


@pytest.mark.parametrize("weights", [(0.5, 0.3, 0.2), (0.15, 0.7, 0.15)])
def test_rates(spark, weights):
    draw = np.random.default_rng(4)
    n = draw.integers(0, 500, 300)
    p = draw.dirichlet([0.4, 0.2, 0.3], 300)
    rows = spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(n, p)],
                                 "n long, a double, b double, c double")
    start, steps, met = fit_rates(rows, "n", ["a", "b", "c"], list(weights))
    got = np.array([r[0] for r in rows.select(rate(["a", "b", "c"], start, steps)).collect()])
    assert got == pytest.approx(solve(n, p, np.array(weights), n.sum()), abs=1e-6)
    totals = (got * n) @ p / n.sum()
    assert (got >= 0).all() and totals == pytest.approx(weights, abs=1e-3)
    assert met == (np.abs(totals - np.array(weights)).max() <= mixing.TOLERANCE)


@pytest.mark.filterwarnings("ignore:targets missed")
def test_steps_that_end_short_say_so(spark):
    rows = spark.createDataFrame([(5, 1.0, 0.0), (7, 1.0, 0.0)], "n long, a double, b double")
    assert fit_rates(rows, "n", ["a", "b"], [1.0, 0.0])[2]
    with pytest.warns(UserWarning, match="targets missed by 0.5"):
        assert not fit_rates(rows, "n", ["a", "b"], [0.5, 0.5])[2]


def labelled(n):
    kinds = {"a": "alpha apple", "b": "beta BREAD 12", "c": "gamma!! glue%%"}
    return [(i, " ".join([kinds["abc"[i % 3]], "common words"] * (1 + i % 7))) for i in range(n)]


def test_documents_meet_the_targets(spark):
    rows = labelled(300)
    docs = documents(spark, rows)
    marks = spark.createDataFrame([(i, "abc"[i % 3]) for i, _ in rows[:150]] + [(0, "b"), (1, "other")],
                                  "doc_id long, domain string")
    model = train(spark, docs, marks, list(TARGETS))
    got = mix(spark, docs, model, TARGETS).collect()
    assert all(max("abc", key=lambda d: r[f"p_{d}"]) == "abc"[r["doc_id"] % 3] for r in got)
    tokens = sum(r["n_tokens"] for r in got)
    assert tokens == sum(len(t.split()) for _, t in rows)
    for domain, weight in TARGETS.items():
        own = sum(r["rate"] * r["n_tokens"] * r[f"p_{domain}"] for r in got)
        assert own / tokens == pytest.approx(weight, abs=1e-3)
    assert sum(r["n_copies"] * r["n_tokens"] for r in got) == pytest.approx(tokens, rel=0.1)
    assert all(abs(r["n_copies"] - r["rate"]) < 1 for r in got)
    assert len({r["targets_met"] for r in got}) == 1
    kept = resample(spark, docs, model, TARGETS)
    assert kept.columns == [*docs.columns, "rate", "n_copies"]
    copies = {r["doc_id"]: r["n_copies"] for r in got if r["n_copies"]}
    assert {r["doc_id"]: r["n_copies"] for r in kept.collect()} == copies


def test_posterior_is_naive_bayes(spark):
    model = DomainModel(["a", "b"], [0.25, 0.75], [[0.1] * mixing.BUCKETS, [-0.2] * mixing.BUCKETS], 10.0)
    row = spark.range(1).select(F.array(F.lit(3), F.lit(4)).alias("f"))
    got = row.select(*model.posterior(model.averages(F.col("f")))).first()
    odds = np.array([0.25 * np.exp(1.0), 0.75 * np.exp(-2.0)])
    assert tuple(got) == pytest.approx(tuple(odds / odds.sum()), rel=1e-5)


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD)
    for marks in ([], [(5, "a")], [(1, "a"), (7, "b")]):
        model = train(spark, docs, spark.createDataFrame(marks, "doc_id long, domain string"),
                      list(TARGETS))
        got = mix(spark, docs, model, TARGETS).collect()
        assert len(got) == len(AWKWARD)
        assert all(sum(r[f"p_{d}"] for d in TARGETS) == pytest.approx(1) for r in got)
        assert {r["n_tokens"] for r in got if r["doc_id"] in (2, 3, 4, 9)} == {0}
        none = documents(spark, [])
        assert mix(spark, none, model, TARGETS).collect() == []
        assert resample(spark, none, model, TARGETS).collect() == []
    clash = docs.withColumnRenamed("key", "p_a").withColumnRenamed("props", "rate").withColumnRenamed(
        "tags", "features")
    assert resample(spark, clash, model, TARGETS).columns == [*clash.columns, "rate_", "n_copies"]
