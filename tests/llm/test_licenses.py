"""Licence findings over a whole table, and awkward rows."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from rows import AWKWARD, documents

from orderloom.llm.license_texts import TEMPLATES
from orderloom.llm.licenses import UNKNOWN, scan, train

# Notices in the test documents and their families.
NOTICES = {"Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
           "Licensed under the Apache License, Version 2.0.": "apache",
           "This work is licensed under the GNU General Public License, version 3.": "gpl"}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(spark, docs):
    return train(spark, docs)


def test_whole_table(docs, model):
    want = {(r["doc_id"], i, NOTICES[line]) for r in docs.collect()
            for i, line in enumerate((r["text"] or "").split("\n")) if line in NOTICES}
    got = {(r["doc_id"], r["paragraph"], r["family"]) for r in scan(docs, model).collect()
           if r["confirmed"]}
    assert want and got == want


def test_templates_and_altered_templates(spark, model):
    rows = [(i, t) for i, t in enumerate(t for texts in TEMPLATES.values() for t in texts)]
    family = [f for f, texts in TEMPLATES.items() for _ in texts]
    found = {r["doc_id"]: r for r in scan(documents(spark, rows), model).collect()}
    right = [i for i, _ in rows if i in found and found[i]["family"] == family[i]
             and found[i]["confirmed"]]
    assert len(right) >= 0.8 * len(rows)
    wrong = [i for i in found if found[i]["family"] not in (family[i], UNKNOWN)]
    assert len(wrong) <= 0.05 * len(rows)


def test_other_paragraphs_are_not_confirmed(spark, model):
    rows = [(1, "She has a driving licence and the permission of the owner."),
            (2, "All rights reserved under the terms of a private license agreement."),
            (3, "The license of the software is under review, and the public is free to see it."),
            *AWKWARD[2:]]
    assert not [r for r in scan(documents(spark, rows), model).collect() if r["confirmed"]]


def test_awkward_rows(spark, model):
    text = "  released UNDER the mit   license\r\n\nother\n" + "word " * 50_000
    rows = [(1, text), (1, text), (None, text), *AWKWARD]
    got = scan(documents(spark, rows), model).where("confirmed").collect()
    assert [(r["doc_id"], r["paragraph"], r["family"]) for r in got] == [
        (1, 0, "mit"), (1, 0, "mit"), (None, 0, "mit")]
    assert scan(documents(spark, []), model).collect() == []


def test_no_python_on_the_executors(docs, model):
    plan = scan(docs, model)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "Exchange"))


def test_short_forms_and_rights_notices(spark, model):
    want = {"MIT License": ("mit", True), "Licensed under GPLv2": ("gpl", True),
            "License: GPL-3.0": ("gpl", True), "All rights reserved.": (UNKNOWN, False),
            "Proprietary and confidential.": (UNKNOWN, False),
            "Copyright (c) 2020 Foo. All rights reserved.": (UNKNOWN, False)}
    rows = list(enumerate(want))
    got = {rows[r["doc_id"]][1]: (r["family"], r["confirmed"])
           for r in scan(documents(spark, rows), model).collect()}
    assert got == want


def test_every_rights_notice_of_a_whole_table(docs, model):
    def is_notice(line):
        return line in NOTICES or line == "All rights reserved."

    want = {(r["doc_id"], i) for r in docs.collect()
            for i, line in enumerate((r["text"] or "").split("\n")) if is_notice(line)}
    got = {(r["doc_id"], r["paragraph"]) for r in scan(docs, model).collect()}
    assert want <= got and len(got) <= 1.2 * len(want)


def test_the_prefilter_loses_no_finding(docs, model):
    kept = scan(docs, model).select("doc_id", "paragraph", "family").collect()
    loose = replace(model)
    loose.lead = lambda features: F.lit(1.0)
    assert sorted(kept) == sorted(scan(docs, loose).select("doc_id", "paragraph", "family").collect())


def test_a_corpus_of_long_texts_teaches_the_same(spark, docs, model):
    long = docs.withColumn("text", F.concat_ws("\n", "text", F.expr("repeat('filler words\n', 900)")))
    assert long.where(F.length("text") <= 8000).isEmpty()
    other = train(spark, long)
    kept = {(r["doc_id"], r["paragraph"]) for r in scan(docs, model).collect()}
    got = {(r["doc_id"], r["paragraph"]) for r in scan(docs, other).collect()}
    assert kept <= got and len(got) <= 1.2 * len(kept)
