"""Command line of the jobs: ``python -m dockpulse JOB ...`` or ``spark-submit dockpulse/__main__.py JOB ...``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from dockpulse.config import REQUIRED, Warehouse
from dockpulse.plans import backfill, cleanup, enrich, gold, ingest, quality, silver
from dockpulse.session import build_session
from dockpulse.sources.boundaries import scan_boundaries


def _day(text: str) -> str:
    if len(text) != 10 or text[4] != "-" or text[7] != "-":
        raise argparse.ArgumentTypeError(f"{text!r} is not YYYY-MM-DD")
    return text


def _hour(text: str) -> int:
    if not text.isdigit() or int(text) > 23:
        raise argparse.ArgumentTypeError(f"{text!r} is not an hour")
    return int(text)


def _setting(text: str) -> tuple[str, str]:
    name, sign, value = text.partition("=")
    if not sign:
        raise argparse.ArgumentTypeError(f"{text!r} is not name=value")
    return name, value


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dockpulse")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *, lake: bool = True, warehouse: bool = True, **more: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, **more)
        if lake:
            sub.add_argument("--bronze", required=True, help="folder of the Bronze lake")
        if warehouse:
            sub.add_argument("--target", choices=sorted(REQUIRED), default="parquet")
            sub.add_argument("--warehouse", help="folder of a parquet target")
            sub.add_argument("--set", type=_setting, action="append", default=[], metavar="NAME=VALUE", help="setting of another target")
        return sub

    sub = job("silver", help="load a day or an hour of Bronze")
    sub.add_argument("date", type=_day)
    sub.add_argument("hour", type=_hour, nargs="?")
    sub.add_argument("--boundaries")

    sub = job("gold", lake=False, help="build the Gold tables")
    sub.add_argument("--full", action="store_true", help="rebuild everything")
    sub.add_argument("--days", type=_day, nargs="*", default=[], help="further days to rebuild")

    sub = job("backfill", help="load the days that Silver lacks")
    sub.add_argument("--from", dest="start", type=_day)
    sub.add_argument("--to", dest="end", type=_day)
    sub.add_argument("--dry-run", action="store_true")
    sub.add_argument("--skip-gold", action="store_true")
    sub.add_argument("--days-per-run", type=int, default=1)
    sub.add_argument("--boundaries")

    sub = job("enrich", lake=False, help="resolve the districts of stored stations")
    sub.add_argument("boundaries")
    sub.add_argument("--dry-run", action="store_true")

    sub = job("cleanup", warehouse=False, help="remove unreadable files and repeated snapshots")
    sub.add_argument("date", type=_day, nargs="?")
    sub.add_argument("hour", type=_hour, nargs="?")
    sub.add_argument("--dry-run", action="store_true")

    sub = job("quality", warehouse=False, help="report on the newest snapshot and apply the gate")
    sub.add_argument("--reports", required=True)
    sub.add_argument("--gate", type=float, default=quality.PASS_GATE_PCT)

    sub = job("ingest", warehouse=False, help="add landed payloads to the lake")
    sub.add_argument("landing")
    sub.add_argument("--instant", help="time of the poll, ISO-8601 with offset; now by default")
    sub.add_argument("--lines", action="store_true", help="one payload a line instead of one a file")
    sub.add_argument("--quarantine", help="folder for payloads that give no station; without it one of them fails the run")
    return top


def warehouse_of(args: argparse.Namespace) -> Warehouse:
    settings = dict(args.set)
    if args.warehouse:
        settings["root"] = args.warehouse.rstrip("/")
    return Warehouse(args.target, settings)


def run(spark: SparkSession, args: argparse.Namespace) -> object:
    if args.job == "silver":
        return silver.run(spark, warehouse_of(args), args.bronze, args.date, args.hour, args.boundaries)
    if args.job == "gold":
        days = [date.fromisoformat(day) for day in args.days]
        return gold.run(spark, warehouse_of(args), incremental=not args.full, days=days)
    if args.job == "backfill":
        return backfill.run(
            spark, warehouse_of(args), args.bronze, args.start, args.end, not args.dry_run, args.days_per_run,
            not args.skip_gold, args.boundaries,
        )
    if args.job == "enrich":
        found = enrich.run(spark, warehouse_of(args), scan_boundaries(spark, args.boundaries), args.dry_run)
        return {"checked": found.checked, "to_update": found.to_update}
    if args.job == "cleanup":
        return cleanup.clean(spark, args.bronze, args.date, args.hour, args.dry_run)
    if args.job == "quality":
        return quality.run(spark, args.bronze, args.reports, gate=args.gate).asDict(recursive=True)
    instant = F.lit(args.instant).cast("timestamp") if args.instant else F.current_timestamp()
    return ingest.run(spark, args.landing, args.bronze, instant, args.lines, args.quarantine)


def main(argv: list[str] | None = None) -> int:
    """Settings are checked before Spark starts; 1 when a group of a backfill failed."""
    top = parser()
    args = top.parse_args(argv)
    if hasattr(args, "target"):
        try:
            warehouse_of(args)
        except ValueError as error:
            top.error(str(error))
    result = run(build_session(f"dockpulse-{args.job}"), args)
    print(result)
    return int(bool(getattr(result, "failed", None)))
