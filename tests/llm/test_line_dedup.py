"""Boilerplate lines against counting in Python."""

from collections import Counter

from rows import AWKWARD, documents

from orderloom.llm.line_dedup import drop_boilerplate


def brute(rows, max_ratio, min_pages):
    pages, having = Counter(), Counter()
    for r in rows:
        site, text = r[2] if len(r) > 2 else "s", r[1]
        pages[site] += 1
        for line in {x.strip(" \t\r") for x in (text or "").split("\n")} - {""}:
            having[site, line] += 1
    out = []
    for r in rows:
        site, text = r[2] if len(r) > 2 else "s", r[1]
        bad = {line for (s, line), n in having.items()
               if s == site and n >= min_pages and n > max_ratio * pages[site]}
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if x.strip(" \t\r") not in bad]
        out.append((r[0], None if text is None else "\n".join(kept), len(lines),
                    len(lines) - len(kept)))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    got = drop_boilerplate(spark, documents(spark, rows), "source", n_lines="lines",
                           n_dropped="dropped", **options)
    return sorted((tuple(r) for r in got.select("doc_id", "text", "lines", "dropped").collect()),
                  key=repr)


def test_ratio_is_that_of_the_site(spark):
    rows = [(i, f"menu\nstory {i}\n\n menu \t\nmenu", "a") for i in range(10)]
    rows += [(100 + i, f"story {i}\n" + ("menu" if i < 3 else "rest"), "b") for i in range(40)]
    rows += [(200, "menu", None), (201, "menu", None), (202, "menu", None), (203, "menu", "tiny")]
    for ratio, least in ((0.1, 3), (0.05, 3), (0.05, 5), (0.9, 1), (1.0, 1), (0.0, 1)):
        assert run(spark, rows, max_ratio=ratio, min_pages=least) == brute(rows, ratio, least)


def test_the_ratio_decides_on_sites_of_any_size(spark):
    rows = [(i, f"story {i}\nfooter", "four") for i in range(4)]
    rows += [(10 + i, f"tale {i}\nfooter", "two") for i in range(2)]
    rows += [(20, "alone\nfooter", "one")]
    rows += [(1000 + i, f"note {i}" + "\nshared" * (i < 2) + "\nmenu" * (i < 3), "wide")
             for i in range(120)]
    got = run(spark, rows)
    assert got == brute(rows, 0.02, 2)
    texts = {i: text for i, text, _, _ in got}
    assert [texts[i] for i in (0, 3, 10, 20)] == ["story 0", "story 3", "tale 0", "alone\nfooter"]
    assert texts[1000] == "note 0\nshared"


def test_awkward_rows(spark):
    assert run(spark, AWKWARD, max_ratio=0.1, min_pages=2) == brute(AWKWARD, 0.1, 2)
    assert run(spark, [], max_ratio=0.1) == []


def test_other_columns_pass(spark):
    docs = documents(spark, AWKWARD).withColumnRenamed("key", "site_key").withColumnRenamed(
        "props", "lines")
    got = drop_boilerplate(spark, docs, "source", max_ratio=0.1, min_pages=2)
    assert got.dtypes == docs.dtypes
    assert {tuple(r["tags"]) for r in got.collect()} == {("x",)}
