"""Evidence of types: sums decide as one pass over everything would."""

import random
from datetime import datetime
from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from orderloom.operators.clean import date_counts, infer_types, type_classes, type_counts
from orderloom.operators.evidence import Evidence
from orderloom.plans import batches
from orderloom.plans.types import folded, retype

CELLS = {"i": ["1", "-20", "+3"], "d": ["1", "2.5", "1e3"], "b": ["true", "FALSE"],
         "t": ["2024-01-01", "2024-01-01 10:00:00"], "s": ["1", "x", "true"], "e": [None],
         "o": ["1"] * 30 + ["x"]}
LATER = datetime(2024, 3, 1)


def test_parts_decide_as_the_whole(spark):
    draw = random.Random(5)
    rows = [(draw.randrange(7), *[None if draw.random() < 0.3 else draw.choice(v)
                                  for v in CELLS.values()]) for _ in range(200)]
    df = spark.createDataFrame(rows, ", ".join(["part int", *[f"{c} string" for c in CELLS]]))
    found = df.select("part", *type_classes(list(CELLS))).groupBy("part").agg(
        *type_counts(list(CELLS))).collect()
    assert len(found) == 7
    whole = {r["column_name"]: r for r in infer_types(df.drop("part")).collect()}
    for c in CELLS:
        said = reduce(add, (Evidence.of(r, c) for r in found), Evidence())
        assert said.narrowest("string") == whole[c]["inferred_type"]
        assert (said.n_values, said.fits["double"]) == (whole[c]["n_values"], whole[c]["n_double"])
    assert [whole[c]["inferred_type"] for c in CELLS] == [
        "bigint", "double", "boolean", "timestamp_ntz", "string", "string", "string"]


def test_values_that_were_not_tested_for_a_type_do_not_fit_it(spark):
    one = Evidence(2, {"bigint": 0, "date_text": 2})
    assert (one + Evidence(0, {})).fitting() == ["date_text"]
    assert (one + Evidence(1, {"bigint": 0})).fitting() == []
    assert Evidence().narrowest("none") == "none" and Evidence().fitting() == []
    row = spark.sql("select '03/04/2024' d, 'x' w").agg(*date_counts(["d", "w"])).first()
    assert Evidence.of(row, "d").fitting() == ["date_text"] and not Evidence.of(row, "w").fitting()
    assert Evidence.of(row, "absent") == Evidence()


def take_back(drops, name):
    log = drops.audit().read("ingestion_log").where(F.col("source_file") == name)
    batches.roll_back(drops.spark, drops.root, "sales", log.first()["batch_id"], LATER)


def test_types_are_narrow_again_after_a_roll_back(drops):
    drops.put("sales_1.csv", "id,amount,sale_date,code\n1,10,2024-01-02,7\n2,,2024-01-03,8\n")
    drops.load(pinned_types={("sales", "code"): "string"})
    drops.put("sales_2.csv", "id,amount,sale_date,extra\n3,1.5,01/05/2024,x\n")
    assert {r["status"] for r in drops.load(pinned_types={("sales", "code"): "string"}).values()} == {
        "SUCCESS"}
    pins = {("sales", "code"): "string"}
    assert retype(drops.spark, drops.root, "sales", LATER, pins) == {}
    assert dict(drops.table("sales").dtypes)["amount"] == "double"
    take_back(drops, "sales_2.csv")
    assert folded(drops.audit(), "sales")["amount"].fitting() == ["bigint", "double"]
    assert retype(drops.spark, drops.root, "sales", LATER, pins) == {
        "amount": ("double", "bigint"), "sale_date": ("date_text", "timestamp_ntz"),
        "extra": ("string", "unknown")}
    assert retype(drops.spark, drops.root, "sales", LATER, pins) == {}
    assert drops.rows("sales", "id", "amount", "sale_date", "code") == [
        (1, 10, datetime(2024, 1, 2), "7"), (2, None, datetime(2024, 1, 3), "8")]
    # Later files are measured against the types decided anew.
    drops.put("sales_3.csv", "id,amount,sale_date,code,extra\n4,9,2024-02-01,9,5\n")
    assert drops.load(pinned_types=pins)["sales_3.csv"]["status"] == "SUCCESS"
    assert drops.audit().active_schemas()["sales"][1]["extra"] == "bigint"


def test_files_without_evidence_are_named(drops):
    drops.put("sales_1.csv", "id\n1\n")
    drops.load()
    log = drops.audit().read("ingestion_log").first()
    drops.audit().append("ingestion_log", [
        tuple({**log.asDict(), "source_file": "sales_0.csv"}.values())])
    with pytest.raises(ValueError, match="sales_0.csv"):
        retype(drops.spark, drops.root, "sales", LATER)
    with pytest.raises(ValueError, match="no raw table"):
        retype(drops.spark, drops.root, "absent", LATER)
