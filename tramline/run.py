"""Command line of the nightly run and backfills, fit for spark-submit.

    python -m tramline.run nightly --warehouse W --snapshots S --schedules D --date 2024-01-12
    python -m tramline.run backfill --warehouse W --snapshots S --schedules D --first 20240101 --last 20240131
    python -m tramline.run schedule --warehouse W --schedules D [--date 2024-01-05]
    python -m tramline.run raw --warehouse W --snapshots S --feed alerts --first 20240110 --last 20240110 [--stride 5]

Days are written YYYY-MM-DD or YYYYMMDD.
"""

from __future__ import annotations

import argparse
import re
from collections.abc import Sequence
from datetime import date

from tramline.plans import daily
from tramline.plans.raw import RAW_BUILDERS
from tramline.session import build_session


def day(text: str) -> date:
    """A day in either spelling; anything else is refused."""
    found = re.fullmatch(r"(\d{4})(-?)(\d{2})\2(\d{2})", text.strip())
    if not found:
        raise argparse.ArgumentTypeError(f"{text!r} is no day: write YYYY-MM-DD or YYYYMMDD")
    try:
        return date(int(found[1]), int(found[3]), int(found[4]))
    except ValueError as error:
        raise argparse.ArgumentTypeError(f"{text!r} is no day: {error}") from None


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="python -m tramline.run", description="Load snapshots and schedules, build facts and marts.")
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name: str, *needs: str) -> argparse.ArgumentParser:
        added = steps.add_parser(name)
        for need in ("warehouse", *needs):
            kind = day if need in ("first", "last") else str
            added.add_argument(f"--{need}", required=True, type=kind)
        return added

    step("nightly", "snapshots", "schedules").add_argument("--date", type=day, default=None, help="day of the run, today by default")
    step("backfill", "snapshots", "schedules", "first", "last")
    step("schedule", "schedules").add_argument("--date", type=day, default=None, help="day of collection, the newest by default")
    raw = step("raw", "snapshots", "first", "last")
    raw.add_argument("--feed", required=True, choices=sorted(RAW_BUILDERS))
    raw.add_argument("--stride", type=int, default=None, help="every n-th file of an hour")
    step("build", "first", "last")
    return parser


def main(argv: Sequence[str] | None = None) -> int:
    """Exit code 0, or 1 when there is no schedule to load."""
    asked = arguments().parse_args(argv)
    if getattr(asked, "first", None) and asked.first > asked.last:
        arguments().error("--first is after --last")
    warehouse = daily.Warehouse(build_session(f"tramline {asked.step}"), asked.warehouse)
    if asked.step == "nightly":
        daily.nightly(warehouse, asked.snapshots, asked.schedules, asked.date or date.today())
    elif asked.step == "schedule":
        return 0 if daily.load_schedule(warehouse, asked.schedules, asked.date) else 1
    elif asked.step == "raw":
        daily.load_raw(warehouse, asked.snapshots, asked.feed, asked.first, asked.last, asked.stride)
    elif asked.step == "build":
        daily.build_facts(warehouse, asked.first, asked.last)
        daily.build_marts(warehouse, asked.first, asked.last)
    else:
        if not daily.load_schedule(warehouse, asked.schedules):
            return 1
        for feed in RAW_BUILDERS:
            daily.load_raw(warehouse, asked.snapshots, feed, asked.first, asked.last)
        daily.build_facts(warehouse, asked.first, asked.last)
        daily.build_marts(warehouse, asked.first, asked.last)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
