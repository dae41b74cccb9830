"""What the command line prints, and what it writes."""

from orderloom import __main__ as cli


def test_left_out_rows_are_counted_or_written(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "SHOWN", 3)
    cli._report(spark.range(5), None)
    assert "2 more rows" in capsys.readouterr().out
    cli._report(spark.range(5), str(tmp_path / "out"), "all")
    assert spark.read.parquet(str(tmp_path / "out/all")).count() == 5


def test_ingest_settings():
    args = cli._arguments(["ingest", "--root", "r", "--pin", "t.zip=string", "--keep-tokens", "t.code",
                           "--spanning", "t=no", "--batch-from-content", "--table-map", "a_=t"])
    options = cli._ingest_options(args)
    assert options.pinned_types == {("t", "zip"): "string"}
    assert options.keep_tokens == {("t", "code")} and options.spanning == {"t": False}
    assert options.batch_from_content and not options.count_duplicates
    assert options.tables == {"a_": "t"}
