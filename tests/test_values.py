"""Cell texts: dates, money, names, tokens."""

import random
from datetime import datetime
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from orderloom.functions.names import batch_id, looks_like_date, normalise_name, target_table
from orderloom.functions.values import money_sum, parse_date
from orderloom.operators.rollups import pivot_sum, sum_amounts

DATES = {
    "2018-01-02": datetime(2018, 1, 2),
    "2018-01-02 03:04:05": datetime(2018, 1, 2, 3, 4, 5),
    "2018-01-02T03:04:05.250": datetime(2018, 1, 2, 3, 4, 5, 250000),
    "2018": datetime(2018, 1, 1),
    "01/02/2018": datetime(2018, 1, 2),
    "13/02/2018": datetime(2018, 2, 13),
    "1/2/2018 3:04": datetime(2018, 1, 2, 3, 4),
    "1/2/2018 3:04:05 PM": datetime(2018, 1, 2, 15, 4, 5),
    "1/2/2018 12:04 am": datetime(2018, 1, 2, 0, 4),
    "31.12.2018": datetime(2018, 12, 31),
    "2018/3/4 23:59:59": datetime(2018, 3, 4, 23, 59, 59),
    "20180304": datetime(2018, 3, 4),
    "5 Jan 2018": datetime(2018, 1, 5),
    "05-JAN-2018 10:00:00": datetime(2018, 1, 5, 10),
    "January 5, 2018": datetime(2018, 1, 5),
    "Jan 5, 2018 9:30": datetime(2018, 1, 5, 9, 30),
    # 02:30 does not exist that day in New York; wall-clock text must not move.
    "3/11/2018 02:30": datetime(2018, 3, 11, 2, 30),
    "March 5, 2018" + " " * 60 + "10:00": datetime(2018, 3, 5, 10),
}
NOT_DATES = ["soon", "", "13/13/2018", "2018-02-30", "12:30", "good", "5", "31/02/2018",
             "Foo 5, 2018", "1/2/18", "x" * 1000, "1/2/2018 25:00"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = [(t,) for t in [*DATES, *NOT_DATES]]
        got = {r["t"]: r["d"] for r in spark.createDataFrame(texts, "t string")
               .select("t", parse_date(F.col("t")).alias("d")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {**DATES, **dict.fromkeys(NOT_DATES)}


def test_money_is_exact_in_any_order(spark):
    cents = [(0.1,), (0.2,), (0.3,), (-0.0,), (1e6 + 0.01,), (None,)] * 1000
    df = spark.createDataFrame(cents, "x double")
    assert df.repartition(7).agg(money_sum(F.col("x"))).first()[0] == 1000000610.0
    assert df.where("x is null").agg(money_sum(F.col("x"))).first()[0] is None


@pytest.mark.parametrize("amounts, total", [
    (["0.004"] * 1000, 4.0), (["4e-9"] * 1000, 4e-6), (["1e25", "5.0"], 1e25), (["1e298"], 1e298), (["1e300"], float("inf")),
    (["4e-10"], 4e-10), (["0.1"] * 3 + [None, "word"], 0.3), (["NaN", "1"], float("nan")),
    (["Infinity", "1"], float("inf")), (["-0.005"] * 7 + ["123456.789012345"], 123456.754012345),
    (["4194303.999999999", "-4194303.999999998"], 1e-9), (["8796093022207.99"] * 3, 26388279066623.97),
    (["9007199254740993", "-1"], 9007199254740991.0), ([None, "word"], None)])
def test_money_leaves_nothing_out(spark, amounts, total):
    df = spark.createDataFrame([(a,) for a in amounts], "x string").repartition(3)
    assert repr(df.agg(money_sum(F.col("x"))).first()[0]) == repr(total)


def test_rollups_sum_as_money_does(spark):
    draw = random.Random(3)
    cells = [(draw.randrange(9), draw.choice("abc"), draw.choice(
        [draw.randrange(10 ** 7) / 100, -draw.randrange(10 ** 9) / 1e9, None, 0.0]))
        for _ in range(3000)]
    df = spark.createDataFrame(cells, "k int, kind string, x double").repartition(5)
    got = {r["k"]: r for r in pivot_sum(df, "k", "kind", "x", {"a": "of_a", "z": "of_z"},
                                        "all").collect()}
    summed = {r["k"]: r["s"] for r in sum_amounts(df, "k", {"x": "s"}).collect()}
    for k in range(9):
        own = [(kind, Fraction(str(x))) for key, kind, x in cells if key == k and x is not None]
        assert got[k]["all"] == summed[k] == float(sum(x for _, x in own))
        assert got[k]["of_a"] == float(sum(x for kind, x in own if kind == "a"))
        assert got[k]["of_z"] == 0.0


def test_names(spark):
    df = spark.createDataFrame([("  Order ID ", "olive_2024_01.csv")], "c string, f string")
    row = df.select(normalise_name(F.col("c")), target_table(F.col("f")),
                    batch_id(F.col("f"))).first()
    assert row[0] == "order_id"
    assert row[1] == "olive"
    assert len(row[2]) == 8


def test_date_words():
    assert [n for n in ("order_date", "created_at", "updated_by", "sentiment", "price", "uptime")
            if looks_like_date(n)] == [
                "order_date", "created_at", "updated_by", "sentiment", "uptime"]
