"""The pipeline, stage by stage against brute force, and on awkward tables."""

import pytest
from pyspark.sql import functions as F
from rows import AWKWARD, documents
from test_simhash import group_of, plain_fingerprint

import corpus_pipeline
from orderloom.llm import mixing, stages, toxicity
from orderloom.llm.decontaminate import words_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What goes into each stage, and what comes out of the last."""
    base = tmp_path_factory.mktemp("pipeline")
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs[-1], SF).write.parquet(str(base / name))
        docs.append(spark.read.parquet(str(base / name)))
    return docs


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "mixing"]
    for docs in steps[1:-1]:
        assert docs.dtypes == steps[0].dtypes
    assert steps[-1].columns == [*steps[0].columns, "rate", "n_copies"]


def test_toxicity(spark, steps):
    model = toxicity.train(steps[0], spark.read.parquet(f"{SF}/labels.parquet"),
                           ~stages.held_out(4, 2))
    rows = steps[0].collect()
    want = {r["doc_id"] for r, s in zip(rows, model.scores([r["text"] for r in rows])) if s < 0.3}
    assert set(texts(steps[1])) == want
    assert len(want) > 0.85 * len(rows)


def test_near_copies(steps):
    before, after = texts(steps[2]), texts(steps[3])
    marks = {i: plain_fingerprint(t) for i, t in before.items()}
    root = group_of(marks.values(), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i in sorted(before):
        least.setdefault(root[marks[i]], i)
    assert after == {i: before[i] for i in least.values()}


def test_leaks(spark, steps):
    before, after = texts(steps[3]), texts(steps[4])
    windows = {tuple(w[i:i + 10]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()
               for w in [words_of(r["text"])] for i in range(len(w) - 9)}

    def leaks(text):
        words = words_of(text)
        return [i for i in range(len(words) - 9) if tuple(words[i:i + 10]) in windows]

    leaking = {i for i, t in before.items() if leaks(t)}
    assert leaking and all(after[i] == before[i] for i in before if i not in leaking)
    for i in leaking & set(after):
        hit = {p for at in leaks(before[i]) for p in range(at, at + 10)}
        assert words_of(after[i]) == [w for p, w in enumerate(words_of(before[i])) if p not in hit]


def test_mixing_takes_documents_by_rate(steps):
    rows = steps[-1].collect()
    assert all(abs(r["n_copies"] - r["rate"]) < 1 and r["n_copies"] >= 1 for r in rows)
    assert set(texts(steps[-1])) <= set(texts(steps[4]))


@pytest.mark.parametrize("rows", [[], AWKWARD])
def test_awkward_tables(spark, tmp_path, rows):
    spark.createDataFrame([(1, 1, 0), (5, 0, 1), (None, 1, 1)],
                          "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (2, ""), (None, "nothing like it")],
                          "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == [*documents(spark, []).columns, "rate", "n_copies"]
    assert (got.count() > 0) == bool(rows)


def test_near_copies_of_awkward_rows(spark):
    kept = stages.drop_near_copies(spark, documents(spark, AWKWARD), "").collect()
    assert sorted((r["doc_id"] for r in kept), key=repr) == sorted(
        [1, 2, 5, 6, 7, None, 10], key=repr)
