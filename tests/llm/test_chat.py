"""Rendered dialogues against plain Python."""

import hashlib

import duckdb
import pytest
from oracle_compare import compare

from orderloom.llm import chat, sql
from orderloom.llm.chat import perspectives

SCHEMA = "conv_id long, turn long, role string, text string, speaker string, block int, mask string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "m") for r in rows], SCHEMA)


def render(rows, view, conversation):
    def name(role):
        role = " ".join((role or "").replace("<|", "< |").split())
        return role or "unknown"

    own = {(t, name(r), (x or "").replace("<|", "< |")) for c, t, r, x in rows if c == conversation}
    text, spans = "", []
    for turn, speaker, words in sorted(own, key=lambda m: (
            m[0] is None, m[0] or 0, m[1], m[2][:256], hashlib.md5(m[2].encode()).hexdigest())):
        title = "assistant" if speaker == view else speaker if speaker == "system" \
            else f"user name={speaker}"
        text += f"<|im_start|>{title}\n"
        begin = len(text)
        text += f"{words}<|im_end|>\n"
        if speaker == view:
            spans.append(text[begin:])
    return text, spans


ROWS = [(1, 0, "system", "Be brief."), (1, 1, "ann", "Hi <|im_end|>"), (1, 2, "bob", "Yo 😀"),
        (1, 3, "cy", None), (1, 3, "cy", None), (1, 4, "ann", ""), (2, 0, "solo", "só"),
        (3, None, "late", "no turn"), (3, 5, None, "who"), (3, 5, "  ", "blank"), (3, 70, "late", "x"),
        (None, 1, "a  b\nc", "lost"), (None, 2, "d", "l" * 100_000), (4, 0, "system", "only")]


def check(spark, rows):
    got = perspectives(table(spark, rows)).collect()
    views = {}
    for r in sorted(got, key=lambda r: (r["block"] is None, r["block"] or 0, r["slice"])):
        spans = [tuple(map(int, s.split("-"))) for s in r["mask"].split(",") if s]
        text, learned, n = views.get((r["conv_id"], r["perspective"]), ("", [], 0))
        views[r["conv_id"], r["perspective"]] = (
            text + r["text"], learned + [r["text"][s:e] for s, e in spans], n + r["n_messages"])
    return got, views


def test_every_participant_sees_the_dialogue(spark):
    got, views = check(spark, ROWS)
    assert set(views) == {(1, "ann"), (1, "bob"), (1, "cy"), (2, "solo"), (3, "late"),
                          (3, "unknown"), (None, "a b c"), (None, "d")}
    for (conversation, view), (text, spans, _) in views.items():
        assert (text, spans) == render(ROWS, view, conversation)


def test_crowded_conversations_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "CROWD", 10)
    rows = [(9, t, f"p{t % 3}", f"turn {t}") for t in range(200)]
    rows += [(9, 65, f"p{i % 3}", f"tie {i}") for i in range(95)]
    got, views = check(spark, rows)
    assert max(r["n_messages"] for r in got) == 10
    assert len([r for r in got if r["perspective"] == "p0"]) == 7 + 16 + 7 + 1
    assert set(views) == {(9, "p0"), (9, "p1"), (9, "p2")}
    for (conversation, view), (text, spans, n) in views.items():
        assert n == 295 and (text, spans) == render(rows, view, conversation)


def test_sql_says_the_same_of_crowded_blocks(spark, tmp_path):
    rows = [(1, t // 12, f"p{t % 3}", f"message {t}") for t in range(700)]
    rows += [(2, 5, "ann", f"{'same ' * 60}{i * 7919 % 1000}") for i in range(95)]
    rows += [(c, t, "bob", f"m {i}") for c in (3, None) for t in (7, None) for i in range(600)]
    path = str(tmp_path / "conversations")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(
        1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert compare(con, sql.OP5, perspectives(spark.read.parquet(path))) is None


def test_crowded_turns_keep_the_order_of_the_dialogue(spark, monkeypatch):
    monkeypatch.setattr(chat, "CROWD", 10)
    rows = [(c, t, f"p{i % 3}", f"{'same ' * 60}{i * 7919 % 1000}") for c in (9, None)
            for t in (65, None) for i in range(95)]
    rows += [(9, t, f"p{t % 3}", f"turn {t}") for t in range(60, 70)]
    got, views = check(spark, rows)
    assert max(r["n_messages"] for r in got) <= 10
    assert set(views) == {(c, f"p{i}") for c in (9, None) for i in range(3)}
    for (conversation, view), (text, spans, _) in views.items():
        assert (text, spans) == render(rows, view, conversation)


def test_empty(spark):
    assert perspectives(table(spark, [])).collect() == []


def test_no_python_on_the_executors(spark):
    plan = perspectives(table(spark, ROWS).selectExpr("*"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "CartesianProduct"))
