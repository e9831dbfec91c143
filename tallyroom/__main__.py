"""Command line of the jobs; run it with ``spark-submit`` or ``python -m tallyroom``.

    daily      --tables T --out O --date 2024-01-04 [--excluded id,id | --excluded-table NAME]
    range      --tables T --out O --date 2024-01-01 --last-date 2024-01-31 [--excluded ...]
    crossings  --tables T --out O --as-of "2024-01-05 00:00:00"
    roster     --tables T --store S --date 2024-01-31 [--sheet in.csv] [--export-sheet out.csv]
               [--prefer sheet|current] [--recall]

``T`` is a folder with one table per name, or a catalog schema with ``--format table``.
An exported sheet names its version, and importing it merges its edits with what was stored since;
``--prefer`` says whose value a cell takes that both sides changed (they are listed in ``conflicts``).
``--recall`` gives users who come back the notes they had.
``--partition-date COLUMN`` (daily, crossings) names the column of the UTC day by which the event
tables are laid out. Each result is written as Parquet under ``O/<day>/<name>``; intermediate
tables go to ``spark.checkpoint.dir`` and are deleted at the end.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tallyroom.plans import crossings_report, daily_report, range_report, refresh_roster
from tallyroom.plans.stages import stage_scope
from tallyroom.sources import read_sheet_csv, read_table, read_tables, sheet_base
from tallyroom.sources.roster_store import SHEET_ORDER, write_sheet_csv


def _write(results: dict[str, DataFrame], folder: str) -> None:
    for name, df in results.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def _excluded(spark: SparkSession, args: argparse.Namespace) -> list[str] | DataFrame:
    if args.excluded_table:
        return read_table(spark, args.tables, "internal_users", args.format, args.excluded_table)
    return [user for user in args.excluded.split(",") if user]


def _daily(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = read_tables(
        spark, args.tables, ("logins", "purchases", "box_events"), args.format
    )
    report = daily_report(
        **tables, report_date=args.date, excluded=_excluded(spark, args), partition_date=args.partition_date
    )
    _write(report.results(), f"{args.out}/{args.date}")


def _range(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = read_tables(
        spark, args.tables, ("logins", "purchases", "box_events"), args.format
    )
    report = range_report(
        **tables, first_day=args.date, last_day=args.last_date, excluded=_excluded(spark, args),
        partition_date=args.partition_date,
    )
    _write(report.results(), f"{args.out}/{args.date}--{args.last_date}")


def _crossings(spark: SparkSession, args: argparse.Namespace) -> None:
    names = ("user_crm", "vendor_pricing", "internal_users", "purchases")
    tables = read_tables(spark, args.tables, names, args.format)
    report = crossings_report(**tables, as_of=args.as_of, partition_date=args.partition_date)
    _write(report.results(), f"{args.out}/{args.as_of[:10]}")


def _roster(spark: SparkSession, args: argparse.Namespace) -> None:
    names = ("user_crm", "orders_created", "vendor_pricing", "internal_users")
    tables = read_tables(spark, args.tables, names, args.format)
    edited = {}
    if args.sheet:
        sheet = read_sheet_csv(spark, args.sheet)
        edited = {"roster_prev": sheet, "sheet_order": SHEET_ORDER, "sheet_base": sheet_base(sheet), "prefer": args.prefer}
    refresh = refresh_roster(**tables, store=args.store, today=args.date, recall=args.recall, **edited)
    results = refresh.results()
    del results["roster"]  # already published
    _write(results, f"{args.store}/summaries/{refresh.version}")
    if args.export_sheet:
        write_sheet_csv(refresh.roster, args.export_sheet, refresh.version)
    print(refresh.version)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyroom", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    daily = jobs.add_parser("daily")
    daily.set_defaults(run=_daily)
    several = jobs.add_parser("range")
    several.add_argument("--last-date", required=True)
    several.set_defaults(run=_range)
    for job in (daily, several):
        job.add_argument("--date", required=True)
        job.add_argument("--excluded", default="")
        job.add_argument("--excluded-table")
    crossings = jobs.add_parser("crossings")
    crossings.add_argument("--as-of", required=True)
    crossings.set_defaults(run=_crossings)
    roster = jobs.add_parser("roster")
    roster.add_argument("--date", required=True)
    roster.add_argument("--store", required=True)
    roster.add_argument("--sheet")
    roster.add_argument("--export-sheet")
    roster.add_argument("--recall", action="store_true")
    roster.add_argument("--prefer", choices=("sheet", "current"), default="sheet")
    roster.set_defaults(run=_roster)
    for job in (daily, several, crossings, roster):
        job.add_argument("--tables", required=True)
        job.add_argument("--format", default="parquet")
    for job in (daily, several, crossings):
        job.add_argument("--out", required=True)
        job.add_argument("--partition-date")
    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName(f"tallyroom-{args.job}")
    spark = builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    with stage_scope(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
