"""Toxicity: held-out accuracy, unseen spellings, awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import AWKWARD, documents

from orderloom.llm import toxicity
from orderloom.llm.queries import op3_toxicity
from orderloom.llm.toxicity import SubwordModel, fit, train

WORDS = "the of and river house green walking table paper music garden under bright".split()
BAD = "idiot moron worthless pathetic".split()


def corpus(seed, n):
    draw = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [draw.choice(WORDS) for _ in range(draw.randint(20, 60))]
        if i % 4 == 0:
            for _ in range(2):
                words.insert(draw.randrange(len(words)), draw.choice(BAD))
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return fit(*corpus(1, 600), 0.25)


def test_unseen_spellings_score_like_their_words(model):
    plain = "the river and the green house under music paper walking table " * 3
    texts = [plain + w for w in ("idiots", "morron", "worthles", "patheticc")]
    scores = model.scores([plain, *texts])
    assert scores[0] < 0.3 and (scores[1:] >= 0.3).sum() >= 2
    assert (scores[1:] > 100 * scores[0]).all()


def test_scores_do_not_depend_on_the_batch(model, monkeypatch):
    texts = corpus(2, 60)[0] + [None, "", "idiot", "x " * 9000 + "idiot"]
    whole = model.scores(texts)
    monkeypatch.setattr(toxicity, "_ROWS", 3)
    assert np.allclose(whole, model.scores(texts))
    assert np.allclose(whole, [model.scores([t])[0] for t in texts])
    assert ((whole >= 0) & (whole <= 1)).all()


def test_held_out_accuracy(model):
    texts, labels = corpus(3, 400)
    assert ((model.scores(texts) >= 0.3) == np.array(labels)).mean() > 0.97


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where(
        "held_out").select("toxic", "predicted").collect()
    hits = sum(r["toxic"] and r["predicted"] for r in rows)
    assert hits / sum(r["predicted"] for r in rows) > 0.7
    assert hits / sum(r["toxic"] for r in rows) > 0.45


@pytest.mark.parametrize("marks, score", [([], 0.0), ([(1, 1), (5, 1)], 1.0), ([(6, 0), (7, 0)], 0.0),
                                          ([(1, 0), (1, 1), (None, 1), (2, None)], 0.0)])
def test_few_labels_and_awkward_rows(spark, marks, score):
    docs = documents(spark, AWKWARD)
    labels = spark.createDataFrame([(i, 1, t, "x") for i, t in marks],
                                   "doc_id long, quality int, toxic int, text string")
    fitted = train(docs, labels, F.lit(True))
    got = docs.select(toxicity.toxicity(fitted, F.col("text")).alias("s")).collect()
    assert len(got) == len(AWKWARD) and all(abs(r["s"] - score) < 1e-6 for r in got)
    assert train(documents(spark, []), labels, F.lit(True)).scores([None]) is not None


def test_model_without_texts():
    assert isinstance(fit([], [], 0.5), SubwordModel)


def test_a_class_of_long_texts_only_is_learned(spark):
    texts, labels = corpus(2, 400)
    texts = [(t + " ") * 80 if y else t for t, y in zip(texts, labels)]
    assert min(len(t) for t, y in zip(texts, labels) if y) > toxicity.LONGEST
    marked = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    model = train(documents(spark, list(enumerate(texts))), marked, F.lit(True))
    scores = model.scores(texts)
    toxic = np.array(labels) == 1
    assert scores[toxic].mean() > 0.5 > scores[~toxic].mean()
