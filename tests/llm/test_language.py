"""Language: held-out accuracy, the kernel itself, awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import AWKWARD, documents

from orderloom.llm import language
from orderloom.llm.language import fit, train
from orderloom.llm.queries import op4_language_id

EN = ["the quick brown fox and the dog", "this is what they have done with it", "where there was a house"]
DE = ["der schnelle fuchs und der hund", "das ist was sie damit getan haben", "wo ein haus gewesen ist"]


def grams(text):
    found = set()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        marked = f" {word} "
        found |= {marked[i:i + n] for n in (1, 2, 3) for i in range(len(marked) - n + 1)} - {" "}
    return found


def test_kernel_counts_shared_grams():
    model = fit(EN + DE, ["en"] * 3 + ["de"] * 3)
    chosen = [DE[0], EN[0], DE[1], EN[1], DE[2], EN[2]]
    got = model.kernel(language._present(EN + ["Wörter, 12 ünd"]))
    for i, text in enumerate(EN + ["Wörter, 12 ünd"]):
        a = grams(text)
        want = [len(a & grams(t)) / np.sqrt(len(a) * len(grams(t))) for t in chosen]
        assert sorted(got[i]) == pytest.approx(sorted(want), abs=1e-5)


def test_batches_agree(monkeypatch):
    model = fit(EN + DE, ["en"] * 3 + ["de"] * 3)
    texts = EN + DE + [None, "", "12", "é" * 50, "the fox " * 3000]
    names, scores = model.predict(texts)
    monkeypatch.setattr(language, "_ROWS", 2)
    again, others = model.predict(texts)
    assert names == again and scores == pytest.approx(others)
    assert names[:6] == ["en"] * 3 + ["de"] * 3 and names[6:9] == ["und"] * 3
    assert names[10] == "en" and all(0 <= s <= 1 for s in scores)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op4_language_id(spark, sf).where("held_out").join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD)
    model = train(docs, F.lit(True))
    names, _ = model.predict([r[1] for r in AWKWARD])
    assert names == ["en" if r[1] and any(c.isalpha() for c in r[1]) else "und" for r in AWKWARD]
    nothing = train(documents(spark, []), F.lit(True))
    assert nothing.predict(["text", None]) == (["und", "und"], [0.0, 0.0])


def test_a_language_of_long_texts_only_is_learned(spark):
    rows = [(i, f"{EN[i % 3]} {i}", "s", "en") for i in range(30)]
    rows += [(100 + i, "12 " * 2000 + f"{DE[i % 3]} " * 300, "s", "de") for i in range(30)]
    model = train(documents(spark, rows), F.lit(True))
    assert model.predict(DE + EN)[0] == ["de"] * 3 + ["en"] * 3


def test_copies_count_once_and_large_languages_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "PER_LANGUAGE", 20)
    seen = {}
    monkeypatch.setattr(language, "fit", lambda texts, labels: seen.update(texts=texts, labels=labels))
    rows = [(i, "one text that is copied", "s", "en") for i in range(2000)]
    rows += [(i, f"text number {i}", "s", "en") for i in range(3000)]
    rows += [(i, f"ein text {i % 7}", "s", "de") for i in range(70)]
    train(documents(spark, rows), F.lit(True))
    assert len(set(seen["texts"])) == len(seen["texts"]) == 27
    assert seen["labels"] == ["de"] * 7 + ["en"] * 20
