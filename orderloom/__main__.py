"""Command line: ``spark-submit`` or ``python -m orderloom <command> --root ...``.

The session comes from the launcher; each command is one step a scheduler can call.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from .plans import batches
from .plans.daily import (DailyOptions, Models, build_models, check_models, create_views,
                          run_daily)
from .plans.ingest import IngestOptions, ingest
from .plans.quality import source_freshness
from .plans.types import retype
from .session import SETTINGS
from .streaming.arrivals import load_arrivals, utc_now

SHOWN = 1000


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="orderloom", description=__doc__)
    parser.add_argument("command", choices=["ingest", "build", "check", "daily", "freshness",
                                            "history", "rollback", "retype", "reprocess",
                                            "arrivals", "sql"])
    parser.add_argument("--root", required=True, help="warehouse folder, shared by all executors")
    parser.add_argument("--landing", help="folder of CSV drops")
    parser.add_argument("--prefix", default="", help="text before orders_dataset and its like")
    parser.add_argument("--run-ts", type=datetime.fromisoformat, help="UTC time of the run")
    parser.add_argument("--table-map", action="append", default=[], metavar="PREFIX=TABLE")
    parser.add_argument("--pin", action="append", default=[], metavar="TABLE.COLUMN=TYPE",
                        help="type of a column, ahead of inference")
    parser.add_argument("--keep-tokens", action="append", default=[], metavar="TABLE.COLUMN",
                        help="column whose NA, null and the like are real values")
    parser.add_argument("--spanning", action="append", default=[], metavar="TABLE=yes|no",
                        help="whether records of a table may span lines")
    parser.add_argument("--amount", action="append", default=[], metavar="COLUMN",
                        help="raw column whose amounts must be summed exactly, instead of "
                        "the usual three")
    parser.add_argument("--batch-from-content", action="store_true")
    parser.add_argument("--count-duplicates", action="store_true")
    parser.add_argument("--output", help="folder for the full result, as Parquet")
    parser.add_argument("--fail-on-error", action="store_true")
    parser.add_argument("--publish-on-failure", action="store_true")
    parser.add_argument("--full-refresh", action="store_true")
    parser.add_argument("--late-inputs", action="store_true")
    parser.add_argument("--shuffle-partitions", help="about shuffled bytes / 256 MiB; AQE merges "
                        "small ones", default=None)
    parser.add_argument("--table", help="raw table, for rollback and retype")
    parser.add_argument("--batch", help="batch id, for rollback and reprocess")
    parser.add_argument("--file", action="append", default=[], help="file meant by rollback")
    parser.add_argument("--reload", action="store_true", help="load rolled-back files again")
    parser.add_argument("--query", help="statement, for sql")
    return parser.parse_args(argv)


def _pair(text: str) -> tuple[str, str]:
    table, _, column = text.rpartition(".")
    return table, column


def _ingest_options(args: argparse.Namespace) -> IngestOptions:
    return IngestOptions(
        tables=dict(pair.split("=", 1) for pair in args.table_map),
        pinned_types={_pair(column): kind for column, kind in
                      (pin.split("=", 1) for pin in args.pin)},
        keep_tokens=frozenset(map(_pair, args.keep_tokens)),
        spanning={table: answer == "yes" for table, answer in
                  (pair.split("=", 1) for pair in args.spanning)},
        **({"amounts": frozenset(args.amount)} if args.amount else {}),
        batch_from_content=args.batch_from_content, count_duplicates=args.count_duplicates)


def _report(rows: DataFrame, output: str | None, name: str = "") -> None:
    """The full result to the folder, if one is given; else the first rows, and how many more."""
    if output:
        rows.write.mode("errorifexists").parquet(f"{output.rstrip('/')}/{name}".rstrip("/"))
        return
    rows.show(SHOWN, truncate=False)
    total = rows.count()
    if total > SHOWN:
        print(f"{total - SHOWN} more rows; --output writes them all")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _arguments(argv)
    if spark is None:
        builder = SparkSession.builder.appName("orderloom")
        for key, value in SETTINGS.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", args.shuffle_partitions)
    run_ts = args.run_ts or utc_now()
    files = _ingest_options(args)
    options = DailyOptions(
        source_prefix=args.prefix, ingest=files, fail_on_error=args.fail_on_error,
        publish_on_failure=args.publish_on_failure, full_refresh=args.full_refresh,
        late_inputs=args.late_inputs)

    if args.command == "ingest":
        status = ingest(spark, args.landing, args.root, run_ts, files)
        _report(status, args.output)
        bad = not status.where(F.col("status") == "FAILED").isEmpty()
        return int(bad and args.fail_on_error)
    if args.command == "build":
        models = Models(spark, args.root, args.prefix, staged=True)
        build_models(models, options)
        models.tables.publish(run_ts)
    elif args.command == "check":
        results = check_models(Models(spark, args.root, args.prefix), run_ts)
        _report(results, args.output)
        return int(not results.where(F.col("status") != "pass").isEmpty())
    elif args.command == "daily":
        result = run_daily(spark, args.landing, args.root, run_ts, options)
        for name in ("files", "checks", "freshness"):
            _report(getattr(result, name), args.output, name)
        return int(not result.published)
    elif args.command == "freshness":
        _report(source_freshness(Models(spark, args.root, args.prefix).raw, run_ts), args.output)
    elif args.command == "history":
        _report(batches.history(spark, args.root), args.output)
    elif args.command == "rollback":
        print(batches.roll_back(spark, args.root, args.table, args.batch, run_ts, args.reload,
                                args.file))
    elif args.command == "retype":
        print(retype(spark, args.root, args.table, run_ts, files.pinned_types))
    elif args.command == "reprocess":
        models = Models(spark, args.root, args.prefix, staged=True)
        batches.reprocess(models, args.batch)
        models.tables.publish(run_ts)
    elif args.command == "arrivals":
        load_arrivals(spark, args.landing, args.root, files).awaitTermination()
    elif args.command == "sql":
        create_views(spark, args.root, args.prefix)
        _report(spark.sql(args.query), args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
