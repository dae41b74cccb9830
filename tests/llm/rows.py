"""Small tables with the awkward rows every operator has to take."""

from __future__ import annotations

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, "
          "key string, n_tokens long, tags array<string>, props map<string,string>")
LONG = "lorem ipsum dolor " * 40_000


def documents(spark, rows):
    """Documents (doc_id, text[, source[, lang]]) with further columns of clashing names."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s",
             None if r[1] is None else len(r[1]), 0.5, "k", 7, ["x"], {"a": "b"}) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


AWKWARD = [
    (1, "A plain text of a few words.\nAnd a second line."),
    (1, "A plain text of a few words.\nAnd a second line."),   # a repeated row
    (2, None), (3, ""), (4, " \n\t "), (5, "one"), (6, LONG),
    (None, "A row without id."), (None, None), (7, "Ünïcödé ß 漢字 😀 é"),
    (8, "A plain text of a few words.\nAnd a second line."),   # a copy
    (9, None, None), (10, "12 34 %% !!", None),
]
