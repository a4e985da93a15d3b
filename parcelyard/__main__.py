"""``python -m parcelyard``: refresh a store, print its reports, delete old versions."""

from __future__ import annotations

import argparse
import sys

from parcelyard import session
from parcelyard.plans.refresh import Snapshot, prune, publish, write_rejects_csv
from parcelyard.plans.reports import REPORTS
from parcelyard.sources.raw import read_csv_tables
from parcelyard.sources.store import ContractDrift, ContractViolation, LostRace


def refresh(args: argparse.Namespace) -> int:
    spark = session.build()
    code, folder = 0, None
    try:
        live = publish(spark, read_csv_tables(spark, args.raw), args.store)
        folder = live.folder
        print(live)
    except ContractViolation as broken:
        code, folder = 3, broken.folder
        print(broken, file=sys.stderr)
    except (ContractDrift, LostRace) as refused:
        code = 2
        print(refused, file=sys.stderr)
    if args.rejects_csv and folder:
        write_rejects_csv(spark.read.parquet(f"{folder}/rejects"), args.rejects_csv)
    return code


def report(args: argparse.Namespace) -> int:
    needle = args.match.lower()
    chosen = {n: r for n, r in REPORTS.items() if needle in n or needle in r.title.lower()}
    if not chosen:
        print(f"Nothing matches {args.match!r}. Try --list.", file=sys.stderr)
        return 1
    if args.list:
        for name, one in chosen.items():
            print(f"{name:<32} {one.title}")
        return 0
    tables = Snapshot(session.build(), args.store).tables()
    for name, one in chosen.items():
        print(f"\n{one.title} [{name}]\n{one.question}\n")
        # Printed are the first lines; a report may have as many as there are spellings.
        one.build(tables).show(args.lines, truncate=False)
    return 0


def old_versions(args: argparse.Namespace) -> int:
    for folder in prune(session.build(), args.store, args.keep):
        print("deleted", folder)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="parcelyard")
    commands = parser.add_subparsers(required=True)
    load = commands.add_parser("refresh", help="load a folder of CSV files into a store")
    load.add_argument("raw")
    load.add_argument("store")
    load.add_argument("--rejects-csv", help="also write the rejects as CSV to this folder")
    load.set_defaults(run=refresh)
    tell = commands.add_parser("report", help="print the reports whose name or title matches")
    tell.add_argument("store")
    tell.add_argument("match", nargs="?", default="")
    tell.add_argument("--list", action="store_true", help="only the names")
    tell.add_argument("--lines", type=int, default=200, help="most lines to print of a report")
    tell.set_defaults(run=report)
    drop = commands.add_parser("prune", help="delete old versions of a store")
    drop.add_argument("store")
    drop.add_argument("--keep", type=int, required=True, help="newest versions to keep")
    drop.set_defaults(run=old_versions)
    args = parser.parse_args(argv)
    return args.run(args)


if __name__ == "__main__":
    sys.exit(main())
