"""Command-line jobs: build the curated layer, correct days of it, compact what
streams added to it, refresh a dashboard view.

    spark-submit plantlens/plans/job.py curate  --source DIR --format csv --out DIR
    spark-submit plantlens/plans/job.py correct --source DIR --format csv --out DIR --days 2026-08-03
    spark-submit plantlens/plans/job.py compact --out DIR
    spark-submit plantlens/plans/job.py refresh --source DIR --format parquet \\
        --curated --out DIR --factory F1 --start 2026-08-01 --end 2026-08-31

The session comes from the cluster (``SparkSession.builder.getOrCreate()``);
the job sets no configuration of its own. ``curate`` loads with quarantine
(``plans.load``) and prints what it counted. ``refresh`` publishes every
result of the view below ``--out`` (``plans.refresh.published`` reads it) and
prints the manifest (one row per result).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from plantlens.operators import Filters, clean
from plantlens.plans.compact import compact
from plantlens.plans.correct import replace_days
from plantlens.plans.load import TooManyRejected, load_counts, load_curated
from plantlens.plans.refresh import refresh
from plantlens.sources import load, load_cells, parquet


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="plantlens")
    sub = p.add_subparsers(dest="command", required=True)
    curate = sub.add_parser("curate", help="clean once, write the curated layer and the quarantine")
    view = sub.add_parser("refresh", help="write every result of one dashboard view")
    days = sub.add_parser("correct", help="replace days of the curated layer's readings and events")
    fold = sub.add_parser("compact", help="fold what streams added into the curated layer")
    days.add_argument("--days", nargs="+", default=None, help="YYYY-MM-DD ...; default: all days of the source")
    for cmd in (curate, days, view):
        cmd.add_argument("--source", required=True, help="input folder")
        cmd.add_argument("--format", default="csv", choices=("csv", "parquet"))
    for cmd in (curate, days, fold, view):
        cmd.add_argument("--out", required=True, help="output folder")
        cmd.add_argument("--time-zone", default="UTC",
                         help="zone of the dates; the session must have it (default UTC)")
    curate.add_argument("--max-rejected", type=float, default=None,
                        help="share of a table's rows above which nothing is published")
    view.add_argument("--curated", action="store_true",
                      help="--source is a curated layer (with its aggregate layer)")
    for name in ("factory", "production_line", "model", "machine_id", "status"):
        view.add_argument(f"--{name.replace('_', '-')}", dest=name, default=None)
    view.add_argument("--start", default=None, help="first day, YYYY-MM-DD")
    view.add_argument("--end", default=None, help="last day, YYYY-MM-DD")
    return p


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"plantlens-{args.command}").getOrCreate()
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone != args.time_zone:
        raise SystemExit(f"the session's time zone is {zone}, not {args.time_zone}: dates would differ")
    if args.command == "curate":
        try:
            loaded = load_curated(spark, load_cells(spark, args.source, args.format), args.out, args.max_rejected)
        except TooManyRejected as refused:
            raise SystemExit(f"not published: {refused}") from refused
        load_counts(spark, args.out, loaded.version).where("rows > 0").show(1000, truncate=False)
        return
    if args.command == "correct":
        rows = clean(load(spark, args.source, args.format))
        replace_days(spark, args.out, rows.sensors, rows.maintenance, args.days)
        return
    if args.command == "compact":
        compact(spark, args.out)
        return
    if args.curated:
        tables = parquet.read_tables(spark, args.source, with_aggregates=True)
    else:
        tables = clean(load(spark, args.source, args.format))
    filters = Filters(
        factory=args.factory,
        production_line=args.production_line,
        model=args.model,
        machine_id=args.machine_id,
        status=args.status,
        start_date=args.start,
        end_date=args.end,
    )
    refresh(spark, tables, filters, args.out).show(truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
