"""Records put together from splits equal the whole-file reader's."""

import random

import pytest

from orderloom.sources.landing import CORRUPT, file_name
from orderloom.sources.spanning import read_spanning, store_lines, unclosed_files

COLUMNS = ["id", "text", "n"]


def _cell(rng):
    body = "".join(rng.choice(['a', 'bc', ',', '\n', '""', ' ', '\n\n', 'é', '""\n']) for _ in
                   range(rng.randint(0, 12)))
    return f'"{body}"'


def _stray(rng):
    return rng.choice(['5" pipe', 'a"b"c', '"x"y', '"x"y"z', '"p"" q"r', 'w""', '"v" '])


def _file(seed, rows, stray=False):
    rng = random.Random(seed)
    lines = ["id,text,n"]
    for i in range(rows):
        cell = _cell(rng) if rng.random() < .6 else "plain"
        if stray and rng.random() < .3:
            cell = _stray(rng)
        lines.append(f"{i},{cell},{rng.randint(0, 9)}")
        if rng.random() < .1:
            lines.append("")
        if rng.random() < .05:
            lines.append(f"{i},short")
    return "\n".join(lines) + "\n"


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def _whole(spark, paths):
    """Spark's own reader, one task per file."""
    schema = ", ".join(f"{c} string" for c in [*COLUMNS, CORRUPT])
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').option("columnNameOfCorruptRecord", CORRUPT).csv(paths)
            .withColumn("_source_file", file_name()))


def _bag(df):
    return sorted((r["_source_file"], r["id"] or "", r["text"] or "", r["n"] or "",
                   r[CORRUPT] is not None) for r in df.collect())


@pytest.mark.parametrize("stray", [False, True])
def test_equals_the_whole_file_reader(spark, tmp_path, small_splits, stray):
    paths = []
    for seed in range(6):
        path = tmp_path / f"part{seed}.csv"
        path.write_text(_file(seed, 60, stray), encoding="utf-8", newline="")
        paths.append(str(path))
    assert spark.read.text(paths).rdd.getNumPartitions() > 20
    lines = store_lines(spark, paths, str(tmp_path / "lines"))
    assert unclosed_files(lines) == set()
    want = _bag(_whole(spark, paths))
    assert _bag(read_spanning(lines, COLUMNS)) == want
    assert len(want) > 200


def test_unclosed_quotes_are_found_at_the_end_of_the_file(spark, tmp_path):
    files = {"unclosed.csv": 'id,text,n\n1,"never,2\n' + "2,x,3\n" * 200,
             "last.csv": 'id,text,n\n1,"a\nb",2\n2,"x',
             "good.csv": 'id,text,n\n1,"a\nb",2\n' + "2,x,3\n" * 200,
             "long.csv": 'id,text,n\n1,"' + "a\n" * 50_000 + '",2\n\n\n'}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    paths = [str(tmp_path / name) for name in files]
    lines = store_lines(spark, paths, str(tmp_path / "lines"))
    assert unclosed_files(lines) == {"unclosed.csv", "last.csv"}


def test_line_breaks_in_cells_are_kept_as_they_are(drops):
    drops.put("reviews.csv", 'id,text,n\r\n1,"a\r\nb",2\r\n2,c,3\r\n')
    drops.put("stray.csv", 'id,text,n\n1,5" pipe,2\n2,"a\nb",3\n')
    log = drops.load()
    assert {r["status"] for r in log.values()} == {"SUCCESS"}
    assert drops.rows("reviews", "id", "text", "n") == [(1, "a\r\nb", 2), (2, "c", 3)]
    assert drops.rows("stray", "id", "text") == [(1, '5" pipe'), (2, "a\nb")]


def test_old_line_ends_are_not_taken_for_one_header(drops):
    drops.put("old.csv", 'id,text\r1,"a\nb"\r2,c\r')
    assert drops.load()["old.csv"]["message"] == "the first record is not the first line"


def test_header_over_two_lines_fails(drops):
    drops.put("wide.csv", 'id,"te\nxt"\n1,x\n')
    assert drops.load()["wide.csv"]["status"] == "FAILED"
