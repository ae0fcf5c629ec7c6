"""Versioned schedule folders: <base>/v_YYYYMMDD_HHMMSS/*.txt, CSV with a header row."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.times import gtfs_date, gtfs_seconds


@dataclass(frozen=True)
class Cast:
    """How a text column of a schedule file becomes a dimension column."""

    source: str
    kind: str = "string"
    name: str | None = None

    def column(self) -> Column:
        raw = F.col(self.source)
        cast = {"string": raw, "date": gtfs_date(raw), "seconds": gtfs_seconds(raw)}.get(self.kind)
        return (raw.try_cast(self.kind) if cast is None else cast).alias(self.name or self.source)


def _text(names: str) -> list[Cast]:
    return [Cast(n) for n in names.split()]


def _typed(kind: str, names: str) -> list[Cast]:
    return [Cast(n, kind) for n in names.split()]


# File -> columns of the dimension table and their types.
DIMENSIONS: dict[str, list[Cast]] = {
    "feed_info": _typed("date", "feed_start_date feed_end_date") + _text(
        "feed_version feed_publisher_name feed_publisher_url feed_lang feed_contact_email feed_id"),
    "agency": _text(
        "agency_id agency_name agency_url agency_timezone agency_lang agency_phone agency_fare_url"),
    "routes": _text("route_id agency_id route_short_name route_long_name route_desc")
    + _typed("int", "route_type") + _text("route_url route_color route_text_color")
    + _typed("int", "route_sort_order") + _text("route_fare_class line_id listed_route network_id"),
    "stops": _text("stop_id stop_code stop_name stop_desc platform_code platform_name")
    + _typed("double", "stop_lat stop_lon") + _text("zone_id stop_url level_id")
    + _typed("int", "location_type") + _text("parent_station") + _typed("int", "wheelchair_boarding")
    + _text("stop_address municipality on_street at_street") + _typed("int", "vehicle_type"),
    "trips": _text("trip_id route_id service_id trip_headsign trip_short_name")
    + _typed("int", "direction_id") + _text("block_id shape_id")
    + _typed("int", "wheelchair_accessible bikes_allowed trip_route_type") + _text("route_pattern_id"),
    "stop_times": _text("trip_id") + _typed("int", "stop_sequence")
    + _text("stop_id arrival_time departure_time")
    + [Cast("arrival_time", "seconds", "arrival_seconds"), Cast("departure_time", "seconds", "departure_seconds")]
    + _text("stop_headsign") + _typed("int", "pickup_type drop_off_type timepoint") + _text("checkpoint_id")
    + _typed("int", "continuous_pickup continuous_drop_off"),
    "calendar": _text("service_id")
    + _typed("boolean", "monday tuesday wednesday thursday friday saturday sunday")
    + _typed("date", "start_date end_date"),
    "calendar_dates": _text("service_id") + _typed("date", "date") + _typed("int", "exception_type")
    + _text("holiday_name"),
}


#: Files of short codes, numbers and times, whose values never hold a line break; they can be read in splits.
ONE_LINE_ROWS = ("stop_times", "calendar", "calendar_dates", "shapes")


def read_schedule_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; quotes are escaped by doubling and may hold line breaks, except in ``ONE_LINE_ROWS``."""
    lines = path.rsplit("/", 1)[-1].removesuffix(".txt") not in ONE_LINE_ROWS
    return (
        spark.read.option("header", True).option("inferSchema", False)
        .option("quote", '"').option("escape", '"').option("multiLine", lines).csv(path)
    )


def cast_dimension(rows: DataFrame, table: str) -> DataFrame:
    """Typed columns of one dimension; columns the file lacks become NULL."""
    missing = [c.source for c in DIMENSIONS[table] if c.source not in rows.columns]
    if missing:
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in dict.fromkeys(missing)})
    return rows.select(*[c.column() for c in DIMENSIONS[table]])


def build_dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The eight dimension tables of one schedule folder, each row stamped with its feed_start_date.

    The stamp is a scalar subquery on feed_info, so no value travels through
    the driver and every table stays one lazy plan.
    """
    folder = folder.rstrip("/")
    stamp = folder.split("/")[-1]
    raw_info = read_schedule_csv(spark, f"{folder}/feed_info.txt")
    info = cast_dimension(raw_info, "feed_info").withColumns({
        "collection_date": F.try_to_date(F.lit(stamp.split("_")[1]), "yyyyMMdd"),
        "collected_at": F.to_timestamp_ntz(F.lit(stamp[2:]), F.lit("yyyyMMdd_HHmmss")),
        "ingested_at": F.current_timestamp(),
    })
    start = info.agg(F.first("feed_start_date")).scalar()
    tables = {"static_versions": info}
    for table in DIMENSIONS:
        if table == "feed_info":
            continue
        typed = cast_dimension(read_schedule_csv(spark, f"{folder}/{table}.txt"), table)
        tables[table] = typed.select(start.alias("feed_start_date"), "*", F.current_timestamp().alias("ingested_at"))
    return tables


def list_versions(spark: SparkSession, base: str) -> DataFrame | None:
    """Schedule folders under ``base`` as (folder, name, collection_date, collected_at); None without any."""
    try:
        files = spark.read.format("binaryFile").load(f"{base.rstrip('/')}/v_*/feed_info.txt")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    folder = F.regexp_extract("path", r"^(.*/v_\d{8}_\d{6})/feed_info\.txt", 1)
    named = files.select(folder.alias("folder")).where(F.col("folder") != "").distinct()
    name = F.element_at(F.split("folder", "/"), -1)
    return named.select(
        "folder", name.alias("name"),
        F.try_to_date(F.substring(name, 3, 8), "yyyyMMdd").alias("collection_date"),
        F.to_timestamp_ntz(F.substring(name, 3, 15), F.lit("yyyyMMdd_HHmmss")).alias("collected_at"),
    )


def find_version(spark: SparkSession, base: str, day: date | None = None) -> str | None:
    """Folder collected on ``day`` (the earliest that day), or the newest of all when ``day`` is None."""
    versions = list_versions(spark, base)
    if versions is None:
        return None
    if day is not None:
        versions = versions.where(F.col("collection_date") == F.lit(day))
    order = F.col("name").asc() if day is not None else F.col("name").desc()
    row = versions.orderBy(order).select("folder").first()
    return row.folder if row else None


def read_live_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """stops, trips and shapes for the live view: trimmed text, unreadable shape points left out."""
    folder = folder.rstrip("/")

    def text(name: str, *columns: str, absent: dict[str, str] = {}) -> DataFrame:  # noqa: B006 - never changed
        rows = read_schedule_csv(spark, f"{folder}/{name}.txt")
        rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns])
        return rows.select(*[
            F.trim(F.coalesce(F.col(c), F.lit(""))).alias(c) if c in rows.columns else F.lit(absent.get(c, "")).alias(c)
            for c in columns
        ])

    # A file without the sequence column puts every point at 0.
    shapes = text("shapes", "shape_id", "shape_pt_sequence", "shape_pt_lat", "shape_pt_lon", absent={"shape_pt_sequence": "0"})
    return {
        "stops": text("stops", "stop_id", "stop_name").where((F.col("stop_id") != "") & (F.col("stop_name") != "")),
        "trips": text("trips", "trip_id", "route_id", "direction_id", "shape_id", "trip_headsign"),
        "shapes": shapes.select(
            "shape_id", F.col("shape_pt_sequence").try_cast("int").alias("seq"),
            F.col("shape_pt_lat").try_cast("double").alias("lat"),
            F.col("shape_pt_lon").try_cast("double").alias("lon"),
        ).where(F.col("seq").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()),
    }
