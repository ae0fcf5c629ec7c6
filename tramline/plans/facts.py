"""Raw tables to facts.

Every function takes a range of days, so a nightly run passes one day and a
backfill passes many and still makes one pass. Rows are cut by ``service_date``
(the partition column of the raw tables) before anything else.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.text import first_translation, not_deleted
from tramline.functions.times import boundary_hours, utc_wall_time
from tramline.operators.latest import first_per_key
from tramline.operators.nested import explode_array
from tramline.operators.versions import link_version
from tramline.schemas import (
    FACT_ALERTS, FACT_ALERTS_ACTIVE_PERIODS, FACT_ALERTS_ROUTES, FACT_TRIP_UPDATES,
    FACT_VEHICLE_POSITIONS, columns_of,
)

FACT_LAG_DAYS = 2
LOAD_LAG_DAYS = 1
OVERNIGHT_LAST_HOUR = 5


def fact_day(run_day: date) -> date:
    """The trip day whose facts and marts a run on ``run_day`` builds."""
    return run_day - timedelta(days=FACT_LAG_DAYS)


def load_day(run_day: date) -> date:
    """The snapshot day that a run on ``run_day`` loads."""
    return run_day - timedelta(days=LOAD_LAG_DAYS)


def _days(df: DataFrame, first: date, last: date) -> DataFrame:
    """Trips that began in the range, seen on their own day or the day after."""
    return df.where(
        F.col("service_date").between(F.lit(first), F.lit(last + timedelta(days=1)))
        & F.col("trip_start_date").between(F.lit(first), F.lit(last))
    )


def fact_vehicle_positions(raw: DataFrame, versions: DataFrame, first: date, last: date) -> DataFrame:
    """Positions of trips begun in the range: same day, or next day up to 05:59."""
    same_day = F.col("service_date") == F.col("trip_start_date")
    overnight = (F.col("service_date") == F.date_add("trip_start_date", 1)) & F.col("hour").between(
        0, OVERNIGHT_LAST_HOUR)
    kept = _days(raw, first, last).where(not_deleted() & (same_day | overnight))
    return link_version(kept, versions, "trip_start_date").select(*columns_of(FACT_VEHICLE_POSITIONS))


def valid_trip_updates(raw: DataFrame) -> DataFrame:
    """Updates of a known trip on its day or the day after."""
    in_window = F.col("service_date").between(F.col("trip_start_date"), F.date_add("trip_start_date", 1))
    return raw.where(in_window & F.col("trip_id").isNotNull() & not_deleted())


def fact_trip_updates(raw: DataFrame, versions: DataFrame, first: date, last: date) -> DataFrame:
    """Final state of each trip: its last update of the trip day or the day after.

    The bulky stop lists are left out before the shuffle.
    """
    columns = columns_of(FACT_TRIP_UPDATES)
    kept = valid_trip_updates(_days(raw, first, last)).select(*[c for c in columns if c != "static_version_date"])
    final = first_per_key(kept, ["trip_start_date", "trip_id"], [
        F.col("snapshot_timestamp").desc_nulls_first(),
        F.col("ingested_at").desc_nulls_first(),
        F.col("entity_id").desc_nulls_first(),
    ])
    return link_version(final, versions, "trip_start_date").select(*columns)


def _alert_slice(raw: DataFrame, first: date | None, last: date | None) -> DataFrame:
    kept = raw.where(not_deleted())
    if first is not None:
        kept = kept.where(F.col("service_date") >= F.lit(first))
    if last is not None:
        kept = kept.where(F.col("service_date") <= F.lit(last))
    return kept


def _newest(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Newest snapshot per key; equal stamps are settled by the other columns in order."""
    rest = [F.col(c).asc_nulls_first() for c in columns if c not in keys and c != "snapshot_timestamp"]
    return first_per_key(df, keys, [F.col("snapshot_timestamp").desc_nulls_first(), *rest])


def fact_alerts(raw: DataFrame, versions: DataFrame, first: date | None = None,
                last: date | None = None) -> DataFrame:
    """Newest state of each alert in the slice, texts unwrapped, linked to the version of its day."""
    texts = ["effect_detail", "cause_detail", "header_text", "description_text", "url"]
    columns = columns_of(FACT_ALERTS)
    flat = _alert_slice(raw, first, last).select(
        "service_date", *[c for c in columns if c not in texts and c != "static_version_date"],
        *[first_translation(c).alias(c) for c in texts],
    )
    newest = _newest(flat, ["entity_id"], [c for c in columns if c != "static_version_date"])
    return link_version(newest, versions, "service_date").select(*columns)


def fact_alerts_routes(raw: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Newest row per (alert, route, stop); entities that miss either id are left out."""
    columns = columns_of(FACT_ALERTS_ROUTES)
    rows = explode_array(_alert_slice(raw, first, last), "informed_entity",
                         ["entity_id", "snapshot_timestamp"], "e")
    flat = rows.select(
        "entity_id", "snapshot_timestamp",
        *[F.col(f"e.{c}").alias(c) for c in ("route_id", "stop_id", "route_type", "direction_id", "agency_id")],
    ).where(F.col("route_id").isNotNull() & F.col("stop_id").isNotNull())
    return _newest(flat, ["entity_id", "route_id", "stop_id"], columns)


def fact_alerts_active_periods(raw: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Newest row per (alert, period index); alerts without periods have none.

    Rows are picked by the stamps as they are; times, whose order is that of the stamps, are computed for the picked ones.
    """
    columns = columns_of(FACT_ALERTS_ACTIVE_PERIODS)
    rows = explode_array(_alert_slice(raw, first, last), "active_period",
                         ["entity_id", "snapshot_timestamp"], "p", index="period_index")
    stamps = rows.select("entity_id", "snapshot_timestamp", "period_index", "p.start", "p.end")
    newest = _newest(stamps, ["entity_id", "period_index"], stamps.columns)
    start, end = utc_wall_time("start"), utc_wall_time("end")
    return newest.select(
        "entity_id", "snapshot_timestamp", "period_index",
        start.alias("active_start"), end.alias("active_end"),
        boundary_hours(start, end).alias("duration_hours"),
        F.col("end").isNull().alias("is_open_ended"),
    ).select(*columns)
