"""The nightly run and backfills: snapshot files and schedule folders to marts, as Parquet tables.

Steps are idempotent: raw and fact tables replace the days they cover, alert
facts keep the newest state whatever the order of runs, marts replace their days.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.checks import constraint_report
from tramline.plans import facts, marts
from tramline.plans.raw import RAW_BUILDERS
from tramline.schemas import TABLES, conform
from tramline.sinks.state import LatestState
from tramline.sinks.tables import clear_days, replace_days, replace_partitions, write_dimensions
from tramline.sources.schedule import build_dimensions, find_version
from tramline.sources.snapshots import decode_snapshots, read_snapshot_files

TRIP_UPDATE_STRIDE = 5
CHECKED_TABLES = ("fact_vehicle_positions", "fact_trip_updates", "fact_alerts", "fact_alerts_routes", "fact_alerts_active_periods",
                  "metric_on_time", "metric_occupancy_route_hour", "metric_alerts_by_day", "metric_alerts_by_day_stops",
                  "metric_service_delivered")
ALERT_TABLES = ("fact_alerts", "fact_alerts_routes", "fact_alerts_active_periods")


class Warehouse:
    """Names and paths of the tables under one folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def read(self, table: str) -> DataFrame:
        if table in ALERT_TABLES:
            return self.state(table).read()
        if table.startswith("dim_"):
            return self.spark.read.parquet(self.path(table))
        return self.spark.read.schema(TABLES[table][0]).parquet(self.path(table))

    def state(self, table: str) -> LatestState:
        layout, _, keys, _ = TABLES[table]
        return LatestState(self.spark, self.path(table), layout, keys)


def days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def load_schedule(warehouse: Warehouse, schedule_base: str, day: date | None = None) -> bool:
    """Load the schedule collected on ``day``, or the newest one; False when there is none."""
    folder = find_version(warehouse.spark, schedule_base, day)
    if folder is None:
        return False
    write_dimensions(build_dimensions(warehouse.spark, folder), warehouse.base)
    return True


def load_raw(warehouse: Warehouse, snapshot_base: str, feed: str, first: date, last: date,
             stride: int | None = None) -> None:
    """Decode the snapshots of a range of days into the raw table of the feed.

    The days are deleted first, so hours and days that now hold no rows don't keep old ones; a
    failed load is run again.
    """
    stride = stride or (TRIP_UPDATE_STRIDE if feed == "trip_updates" else 1)
    files = read_snapshot_files(warehouse.spark, snapshot_base, feed, first, last, stride)
    table = f"raw_{feed}"
    clear_days(warehouse.spark, warehouse.path(table), "service_date", days_between(first, last))
    if files is None:
        return
    replace_partitions(RAW_BUILDERS[feed](decode_snapshots(files, feed)), warehouse.path(table), TABLES[table][1])


def build_facts(warehouse: Warehouse, first: date, last: date) -> None:
    """All five fact tables for the days of a range."""
    versions = warehouse.read("dim_static_versions")
    days = days_between(first, last)
    for table, build in (
        ("fact_vehicle_positions", facts.fact_vehicle_positions),
        ("fact_trip_updates", facts.fact_trip_updates),
    ):
        rows = build(warehouse.read(table.replace("fact_", "raw_")), versions, first, last)
        replace_days(conform(rows, TABLES[table][0]), warehouse.path(table), "trip_start_date", days)
    alerts = warehouse.read("raw_alerts")
    warehouse.state("fact_alerts").merge(facts.fact_alerts(alerts, versions, first, last))
    warehouse.state("fact_alerts_routes").merge(facts.fact_alerts_routes(alerts, first, last))
    warehouse.state("fact_alerts_active_periods").merge(facts.fact_alerts_active_periods(alerts, first, last))


def build_marts(warehouse: Warehouse, first: date, last: date) -> None:
    """All five marts for the days of a range."""
    read, days = warehouse.read, days_between(first, last)
    positions, routes = read("fact_vehicle_positions"), read("dim_routes")
    alert_facts = (read("fact_alerts_active_periods"), read("fact_alerts_routes"), read("fact_alerts"))
    built = {
        "metric_on_time": marts.mart_on_time(positions, read("dim_stop_times"), routes, first, last),
        "metric_occupancy_route_hour": marts.mart_occupancy_route_hour(positions, routes, first, last),
        "metric_alerts_by_day": marts.mart_alerts_by_day(*alert_facts, routes, first, last),
        "metric_alerts_by_day_stops": marts.mart_alerts_by_day_stops(*alert_facts, read("dim_stops"), first, last),
        "metric_service_delivered": marts.mart_service_delivered(
            read("fact_trip_updates"), read("dim_trips"), routes, read("dim_stop_times"), read("dim_calendar"),
            read("dim_calendar_dates"), read("dim_static_versions"), first, last),
    }
    for table, rows in built.items():
        layout, (day, *_), _, _ = TABLES[table]
        replace_days(conform(rows, layout), warehouse.path(table), day, days)


def checked_columns(table: str) -> tuple[str, list[str], list[str]]:
    """Column that a table's days are read by, declared keys and required columns."""
    _, partitions, keys, required = TABLES[table]
    return (partitions or ["snapshot_timestamp"])[0], list(keys), list(required)


def check_days(warehouse: Warehouse, first: date, last: date) -> DataFrame:
    """(table_name, rule, violations) of a range's fact and mart rows; raw rows without a schedule version are a rule too.

    Tables by day read the days of the range only, which their keys contain. Of the alert tables the rows that arrived for the
    range are read for missing values; their keys are unique by construction, as a read keeps one row per key.
    """
    reports = []
    for table in CHECKED_TABLES:
        day, keys, required = checked_columns(table)
        if table in ALERT_TABLES:
            rows, keys = warehouse.state(table).arrived(first, last + timedelta(days=1)), []
        else:
            rows = warehouse.read(table).where(F.col(day).between(F.lit(first), F.lit(last)))
        reports.append(constraint_report(rows, keys, required).select(F.lit(table).alias("table_name"), "rule", "violations"))
    oldest = warehouse.read("dim_static_versions").agg(F.min("feed_start_date")).scalar()
    for table in ("raw_vehicle_positions", "raw_trip_updates"):
        early = warehouse.read(table).where(F.col("service_date").between(F.lit(first), F.date_add(F.lit(last), 1)) & F.col("trip_start_date").between(F.lit(first), F.lit(last))
                                            & F.coalesce(F.col("trip_start_date") < oldest, F.lit(True)))
        reports.append(early.agg(F.lit(table).alias("table_name"), F.lit("has a schedule version").alias("rule"), F.count("*").alias("violations")))
    return reduce(DataFrame.unionByName, reports)


def write_checks(warehouse: Warehouse, first: date, last: date, run_day: date) -> None:
    """Stores the report of a range under ``run_day``; a missing required value stops the run after the report is stored."""
    path = warehouse.path("load_checks")
    replace_partitions(check_days(warehouse, first, last).withColumn("run_day", F.lit(run_day)), path, ["run_day"])
    report = warehouse.spark.read.parquet(path).where((F.col("run_day") == F.lit(run_day)) & F.col("rule").startswith("not null") & (F.col("violations") > 0))
    broken = [f"{r.table_name}: {r.rule} ({r.violations})" for r in report.collect()]  # one row per declared rule at most
    if broken:
        raise ValueError("required values are missing: " + ", ".join(sorted(broken)))


def nightly(warehouse: Warehouse, snapshot_base: str, schedule_base: str, run_day: date) -> None:
    """Everything one night does: load the day before, build facts and marts of two days before, check them."""
    loaded, built = facts.load_day(run_day), facts.fact_day(run_day)
    load_schedule(warehouse, schedule_base, loaded)
    for feed in RAW_BUILDERS:
        load_raw(warehouse, snapshot_base, feed, loaded, loaded)
    build_facts(warehouse, built, built)
    build_marts(warehouse, built, built)
    write_checks(warehouse, built, built, run_day)
