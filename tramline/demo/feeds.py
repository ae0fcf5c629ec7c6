"""Raw rows packed into feed messages, the input of the decode queries.

Each Arrow batch of a task becomes feed messages of its own, one per snapshot
time, so packing needs no shuffle and no group is gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.times import wall_epoch
from tramline.sources import feed_spec

_FILES = "service_date date, hour int, path string, content binary"


def _pack(rows: DataFrame, fill: Callable) -> DataFrame:
    """(service_date, hour, snapshot, ...) rows to one message per snapshot and batch."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        message = feed_spec.message_class()
        for batch in batches:
            feeds = {}
            for row in batch.itertuples(index=False):
                key = (row.service_date, int(row.hour), int(row.snapshot))
                if key not in feeds:
                    feeds[key] = message()
                    feeds[key].header.gtfs_realtime_version = "2.0"
                    feeds[key].header.timestamp = key[2]
                fill(feeds[key].entity.add(), row)
            yield pd.DataFrame(
                [(day, hour, f"snapshot_{stamp}.pb", feed.SerializeToString())
                 for (day, hour, stamp), feed in feeds.items()],
                columns=["service_date", "hour", "path", "content"])

    return rows.mapInPandas(encode, _FILES)


def _set(target, field: str, value) -> None:
    """Set a field unless the value is missing."""
    if value is not None and value == value:
        kind = target.DESCRIPTOR.fields_by_name[field]
        if kind.enum_type is not None:
            value = kind.enum_type.values_by_name[value].number
        elif not isinstance(value, (str, bool)):
            value = int(value)
        setattr(target, field, value)


def _fill_vehicle(entity, row) -> None:
    entity.id = row.entity_id
    _set(entity, "is_deleted", None if row.is_deleted is None else bool(row.is_deleted))
    vehicle = entity.vehicle
    for field, value in (("trip_id", row.trip_id), ("route_id", row.route_id), ("direction_id", row.direction_id),
                         ("start_date", row.start_date), ("schedule_relationship", row.trip_schedule_rel)):
        _set(vehicle.trip, field, value)
    _set(vehicle.vehicle, "id", row.vehicle_id)
    for field, value in (("current_stop_sequence", row.current_stop_sequence), ("stop_id", row.stop_id),
                         ("current_status", row.current_status), ("occupancy_status", row.occupancy_status),
                         ("occupancy_percentage", row.occupancy_percentage), ("timestamp", row.position)):
        _set(vehicle, field, value)


def encode_vehicle_snapshots(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        "service_date", "hour", wall_epoch("snapshot_timestamp").alias("snapshot"), "entity_id", "is_deleted",
        "trip_id", "route_id", "direction_id", F.date_format("trip_start_date", "yyyyMMdd").alias("start_date"),
        "trip_schedule_rel", "vehicle_id", "current_stop_sequence", "stop_id", "current_status", "occupancy_status",
        "occupancy_percentage", wall_epoch("position_timestamp").alias("position"))
    return _pack(rows, _fill_vehicle)


def _fill_trip_update(entity, row) -> None:
    entity.id = row.entity_id
    update = entity.trip_update
    for field, value in (("trip_id", row.trip_id), ("start_date", row.start_date),
                         ("schedule_relationship", row.relation)):
        _set(update.trip, field, value)
    _set(update, "delay", row.delay)
    for i in range(int(row.delay) % 3):
        stop = update.stop_time_update.add()
        stop.stop_sequence = i + 1
        stop.arrival.time = int(row.snapshot) + 60 * i


def encode_trip_updates(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        "service_date", "hour", wall_epoch("snapshot_timestamp").alias("snapshot"), "entity_id", "trip_id",
        F.date_format("trip_start_date", "yyyyMMdd").alias("start_date"),
        F.nullif(F.trim("trip_schedule_rel"), F.lit("")).alias("relation"), "delay")
    return _pack(rows, _fill_trip_update)


def _fill_alert(entity, row) -> None:
    entity.id = row.entity_id
    for field, value in (("cause", row.cause), ("effect", row.effect), ("severity_level", row.severity_level)):
        _set(entity.alert, field, value)
    translation = entity.alert.header_text.translation.add()
    translation.text, translation.language = row.header, "en"


def encode_alerts(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        "service_date", "hour", wall_epoch("snapshot_timestamp").alias("snapshot"), "entity_id", "cause", "effect",
        "severity_level", F.concat(F.lit("Alert "), "entity_id").alias("header"))
    return _pack(rows, _fill_alert)
