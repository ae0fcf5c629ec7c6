"""Snapshot trees made of the test tables: feed entities with every field, one message per poll and slot.

A poll is ten minutes; a slot is a range of a million keys, which bounds a message whatever the size of the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.times import wall_epoch
from tramline.session import HUGE, at_most
from tramline.sources import feed_codec, feed_spec
from tramline.sources.snapshot_tree import BATCH, SCHEMA, write_tree

POLL = 600
SLOT = 1_000_000
RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
AT_ONCE = 2_000  # entities that are handed to Python and made bytes together; larger batches of nested rows take Spark twice the time

c = F.col


def messages(entities: DataFrame) -> DataFrame:
    """(service_date, hour, stamp, slot, entity) to files, one feed message per group; entities are bytes before they are gathered."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], feed_codec.entity_fields(batch.column(4))],
                                             names=["service_date", "hour", "stamp", "slot", "field"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fields, done, size = None, [], [], 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *now, field in zip(*columns):
                if now != key and fields:
                    done.append(file_of(*key, fields))
                    size += len(done[-1][-1])
                    if size > BATCH:
                        yield pa.RecordBatch.from_pylist([dict(zip(kinds_of_files.names, row)) for row in done], kinds_of_files)
                        done, size = [], 0
                    fields = []
                key = now
                fields.append(field)
        if fields:
            done.append(file_of(*key, fields))
            yield pa.RecordBatch.from_pylist([dict(zip(kinds_of_files.names, row)) for row in done], kinds_of_files)

    def file_of(day: date, hour: int | None, stamp: int, slot: int, fields: list[bytes]) -> tuple:
        feed = feed_spec.message_class()()
        feed.header.gtfs_realtime_version, feed.header.timestamp = "2.0", stamp
        second = stamp % 86_400
        name = f"snapshot_{day:%Y%m%d}_{second // 3600:02}{second // 60 % 60:02}{second % 60:02}_{slot:08}.pb"
        return day, hour, name, b"".join([feed.SerializeToString(), *fields])

    kinds_of_files = pa.schema([("service_date", pa.date32()), ("hour", pa.int32()), ("path", pa.string()), ("content", pa.binary())])
    keys = ["service_date", "hour", "stamp", "slot"]
    packed = entities.select(*keys, "entity").mapInArrow(pack, ", ".join(f"{k} {dict(entities.dtypes)[k]}" for k in keys) + ", field binary")
    return packed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(gather, SCHEMA)


def write_entities(entities: DataFrame, base: str, feed: str) -> None:
    with at_most(entities.sparkSession, {RECORDS: AT_ONCE, HUGE: 8000}):
        write_tree(messages(entities), f"{base}/{feed}")


def day_range(rows: DataFrame, column: str = "service_date") -> tuple[date, date]:
    """First and last day of a table."""
    found = rows.agg(F.min(column).alias("first"), F.max(column).alias("last")).first()
    return found["first"], found["last"]


def _entity(payload: str, fields: Column) -> Column:
    return F.struct(c("entity_id").alias("id"), "is_deleted", fields.alias(payload)).cast(feed_spec.entity_type(payload))


def _typed(kind: str, **fields: Column) -> Column:
    """A struct of a message type; fields that aren't named are missing."""
    layout = feed_spec.spark_type(kind)
    return F.struct(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in layout.fields])


def _absent(kind: str) -> Column:
    return F.lit(None).cast(feed_spec.spark_type(kind))


def _start_date() -> Column:
    return F.date_format("trip_start_date", "yyyyMMdd")


def position_entities(positions: DataFrame) -> DataFrame:
    """Raw vehicle positions (``roles.raw_vehicle_positions``) as entities, the fields they lack made from their ids."""
    e = c("entity_id").cast("bigint")
    carriages = F.array(
        _typed("CarriageDetails", id=F.lit("c1"), occupancy_status=F.lit("EMPTY"), occupancy_percentage=e % 101, carriage_sequence=F.lit(1)),
        _typed("CarriageDetails", id=F.lit("c2"), label=F.lit("x"), carriage_sequence=F.lit(2)))
    vehicle = _typed(
        "VehiclePosition",
        trip=_typed("TripDescriptor", trip_id=c("trip_id"), start_date=_start_date(), schedule_relationship=c("trip_schedule_rel"),
                    start_time=F.when(e % 4 != 0, F.concat(F.lpad(c("hour").cast("string"), 2, "0"), F.lit(":00:00"))),
                    route_id=c("route_id"), direction_id=c("direction_id")),
        position=_typed("Position", latitude=c("latitude"), longitude=c("longitude"), bearing=e % 360, odometer=e * 0.5, speed=c("speed")),
        current_stop_sequence=c("current_stop_sequence"), current_status=c("current_status"), timestamp=wall_epoch("position_timestamp"),
        congestion_level=F.when(e % 5 == 0, "RUNNING_SMOOTHLY").when(e % 5 == 1, "STOP_AND_GO").when(e % 5 == 2, "CONGESTION"),
        stop_id=c("stop_id"), vehicle=_typed("VehicleDescriptor", id=c("vehicle_id"), label=F.concat(F.lit("L"), "trip_id")),
        occupancy_status=c("occupancy_status"), occupancy_percentage=c("occupancy_percentage"),
        multi_carriage_details=F.when(e % 4 == 0, carriages))
    at = wall_epoch("snapshot_timestamp")
    return positions.select("service_date", "hour", (at - at % POLL).alias("stamp"), F.floor(e / SLOT).alias("slot"),
                            _entity("vehicle", vehicle).alias("entity"))


def update_entities(updates: DataFrame) -> DataFrame:
    """Raw trip updates as entities; the days of a month share its first day, so that polls hold several trips."""
    trip = c("trip_id").cast("bigint")
    second = wall_epoch("snapshot_timestamp") % 86_400
    month = F.trunc("service_date", "month")
    stamp = wall_epoch(month.cast("timestamp_ntz")) + second - second % POLL
    stop = lambda i: _typed(
        "StopTimeUpdate", stop_sequence=i, stop_id=F.concat(F.lit("S"), i.cast("string")),
        arrival=_typed("StopTimeEvent", delay=i * 10, time=c("stamp") + i * 60),
        departure=F.when(i != 1, _typed("StopTimeEvent", time=c("stamp") + i * 60 + 30)).otherwise(_absent("StopTimeEvent")),
        schedule_relationship=F.when(i == 2, "SKIPPED"))
    stops = F.transform(F.filter(F.array(F.lit(1), F.lit(2)), lambda i: i <= c("delay") % 3), stop)
    update = _typed(
        "TripUpdate",
        trip=_typed("TripDescriptor", trip_id=c("trip_id"), start_date=_start_date(), route_id=c("route_id"), direction_id=c("direction_id"),
                    schedule_relationship=F.nullif(F.trim("trip_schedule_rel"), F.lit("")),
                    modified_trip=F.when(trip % 7 == 0, _typed("ModifiedTrip", modifications_id=F.concat(F.lit("m"), "trip_id")))
                    .otherwise(_absent("ModifiedTrip"))),
        stop_time_update=stops,
        vehicle=_typed("VehicleDescriptor", id=F.concat(F.lit("v"), "trip_id"), label=F.lit("bus"), license_plate=F.when(trip % 2 == 0, "P 1"),
                       wheelchair_accessible=F.when(trip % 3 == 0, "WHEELCHAIR_ACCESSIBLE")),
        timestamp=c("stamp") - 7, delay=c("delay"),
        trip_properties=F.when(trip % 5 == 0, _typed("TripProperties", trip_id=F.concat(F.lit("p"), "trip_id"), shape_id=F.lit("sh")))
        .otherwise(_absent("TripProperties")))
    return (updates.withColumn("stamp", stamp)
            .select(month.alias("service_date"), F.floor(second / 3600).cast("int").alias("hour"), "stamp",
                    F.floor(trip / SLOT).alias("slot"), _entity("trip_update", update).alias("entity")))


def alert_entities(alerts: DataFrame) -> DataFrame:
    """Raw alerts of lines (``entity_id`` begins with the order) as entities, each in two polls in a row; the second one is milder."""
    order = F.split("entity_id", "-")[0].cast("bigint")
    second = wall_epoch("snapshot_timestamp") % 86_400
    first = wall_epoch(F.trunc("service_date", "month").cast("timestamp_ntz")) + second - second % POLL
    alert = F.struct(
        *[c(f) for f in ("active_period", "informed_entity", "cause", "effect", "url", "header_text", "description_text", "tts_header_text",
                         "tts_description_text")],
        F.when(c("again") == 1, "INFO").otherwise(c("severity_level")).alias("severity_level"),
        c("url").alias("cause_detail"), c("effect_detail"))
    stamp = first + c("again") * POLL
    at = F.timestamp_seconds("stamp").cast("timestamp_ntz")
    return (alerts.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("stamp", stamp)
            .select(F.to_date(at).alias("service_date"), F.hour(at).alias("hour"), "stamp", F.floor(order / SLOT).alias("slot"),
                    _entity("alert", alert).alias("entity")))


def flat(items: Column | str, *fields: Callable[[Column], Column]) -> Column:
    """A list of structs as text: fields by comma, missing ones '-', items by bar."""
    return F.array_join(F.transform(items, lambda x: F.concat_ws(",", *[F.coalesce(f(x).cast("string"), F.lit("-")) for f in fields])), "|")
