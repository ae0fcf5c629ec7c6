"""Table layouts: column order and types of the raw, fact and mart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TRANSLATED = "STRUCT<translation: ARRAY<STRUCT<text: STRING, language: STRING>>>"
_TRIP = (
    "STRUCT<trip_id: STRING, start_time: STRING, start_date: STRING, schedule_relationship: STRING, "
    "route_id: STRING, direction_id: INT, modified_trip: STRUCT<modifications_id: STRING, "
    "affected_trip_id: STRING, start_time: STRING, start_date: STRING>>"
)

_SNAPSHOT_HEAD = (
    "service_date DATE, hour INT, snapshot_timestamp TIMESTAMP_NTZ, ingested_at TIMESTAMP_NTZ, "
    "gtfs_realtime_version STRING, entity_id STRING, is_deleted BOOLEAN"
)
_TRIP_HEAD = (
    "trip_id STRING, route_id STRING, direction_id INT, trip_start_time STRING, trip_start_date DATE, "
    "trip_schedule_rel STRING"
)

RAW_VEHICLE_POSITIONS = (
    f"{_SNAPSHOT_HEAD}, {_TRIP_HEAD}, vehicle_id STRING, vehicle_label STRING, "
    "multi_carriage_details ARRAY<STRUCT<id: STRING, label: STRING, occupancy_status: STRING, "
    "occupancy_percentage: INT, carriage_sequence: INT>>, "
    "latitude DOUBLE, longitude DOUBLE, bearing DOUBLE, odometer DOUBLE, speed DOUBLE, "
    "current_stop_sequence INT, stop_id STRING, current_status STRING, congestion_level STRING, "
    "occupancy_status STRING, occupancy_percentage INT, position_timestamp TIMESTAMP_NTZ"
)
RAW_ALERTS = (
    f"{_SNAPSHOT_HEAD}, cause STRING, effect STRING, severity_level STRING, "
    "active_period ARRAY<STRUCT<start: BIGINT, end: BIGINT>>, "
    "informed_entity ARRAY<STRUCT<agency_id: STRING, route_id: STRING, route_type: INT, "
    f"trip: {_TRIP}, stop_id: STRING, direction_id: INT>>, "
    + ", ".join(f"{c} {_TRANSLATED}" for c in (
        "url", "header_text", "description_text", "tts_header_text", "tts_description_text",
        "cause_detail", "effect_detail"))
)
_TRIP_UPDATE_TAIL = (
    "vehicle_id STRING, vehicle_label STRING, vehicle_license_plate STRING, wheelchair_accessible STRING, "
    "trip_update_timestamp TIMESTAMP_NTZ, delay INT"
)
_MODIFIED = "modified_trip STRUCT<modifications_id: STRING, affected_trip_id: STRING, start_time: STRING, start_date: STRING>"
_PROPERTIES = "trip_properties STRUCT<trip_id: STRING, start_date: STRING, start_time: STRING, shape_id: STRING>"
RAW_TRIP_UPDATES = (
    f"{_SNAPSHOT_HEAD}, {_TRIP_HEAD}, {_MODIFIED}, {_TRIP_UPDATE_TAIL}, "
    "stop_time_update ARRAY<STRUCT<stop_sequence: INT, "
    "arrival: STRUCT<delay: INT, time: BIGINT, uncertainty: INT>, "
    "departure: STRUCT<delay: INT, time: BIGINT, uncertainty: INT>, "
    f"stop_id: STRING, schedule_relationship: STRING>>, {_PROPERTIES}"
)

FACT_VEHICLE_POSITIONS = f"{RAW_VEHICLE_POSITIONS}, static_version_date DATE"
FACT_TRIP_UPDATES = (
    f"{_SNAPSHOT_HEAD}, {_TRIP_HEAD}, {_MODIFIED}, {_TRIP_UPDATE_TAIL}, {_PROPERTIES}, static_version_date DATE"
)
FACT_ALERTS = (
    "entity_id STRING, snapshot_timestamp TIMESTAMP_NTZ, cause STRING, effect STRING, severity_level STRING, "
    "effect_detail STRING, cause_detail STRING, header_text STRING, description_text STRING, url STRING, "
    "gtfs_realtime_version STRING, ingested_at TIMESTAMP_NTZ, static_version_date DATE"
)
FACT_ALERTS_ROUTES = (
    "entity_id STRING, snapshot_timestamp TIMESTAMP_NTZ, route_id STRING, stop_id STRING, route_type INT, "
    "direction_id INT, agency_id STRING"
)
FACT_ALERTS_ACTIVE_PERIODS = (
    "entity_id STRING, snapshot_timestamp TIMESTAMP_NTZ, period_index INT, active_start TIMESTAMP_NTZ, "
    "active_end TIMESTAMP_NTZ, duration_hours DOUBLE, is_open_ended BOOLEAN"
)

METRIC_ON_TIME = (
    "service_date DATE, trip_start_date DATE, hour INT, trip_id STRING, route_id STRING, route_name STRING, "
    "route_type INT, direction_id INT, stop_id STRING, stop_sequence INT, actual_arrival_ts TIMESTAMP_NTZ, "
    "actual_arrival_seconds INT, scheduled_arrival_time STRING, scheduled_arrival_seconds INT, "
    "arrival_delay_seconds INT, is_on_time BOOLEAN, occupancy_status STRING, occupancy_percentage INT, "
    "static_version_date DATE"
)
METRIC_OCCUPANCY_ROUTE_HOUR = (
    "service_date DATE, hour INT, route_id STRING, route_name STRING, snapshot_count BIGINT, "
    "avg_occupancy_pct DOUBLE, pct_snapshots_reporting DOUBLE, pct_empty DOUBLE, pct_many_seats DOUBLE, "
    "pct_few_seats DOUBLE, pct_standing_room DOUBLE, pct_crushed_standing DOUBLE, pct_full DOUBLE, "
    "pct_no_data_occupancy DOUBLE"
)
METRIC_ALERTS_BY_DAY = (
    "alert_date DATE, route_id STRING, route_name STRING, alert_count BIGINT, severe_count BIGINT, "
    "warning_count BIGINT, info_count BIGINT"
)
METRIC_ALERTS_BY_DAY_STOPS = (
    "alert_date DATE, stop_name STRING, stop_lat DOUBLE, stop_lon DOUBLE, alert_count BIGINT, "
    "severe_count BIGINT, warning_count BIGINT, info_count BIGINT"
)
METRIC_SERVICE_DELIVERED = (
    "service_date DATE, trip_start_date DATE, route_id STRING, route_name STRING, direction_id INT, "
    "scheduled_trips BIGINT, delivered_trips BIGINT, canceled_trips BIGINT, no_rt_data_trips BIGINT, "
    "added_trips BIGINT, pct_delivered DOUBLE, static_version_date DATE"
)
RECENT_SNAPSHOT = (
    "snapshot_ts STRING, snapshot_unix BIGINT, feed_timestamp BIGINT, feed_age_seconds BIGINT, "
    "entity_id STRING, vehicle_id STRING, vehicle_label STRING, route_id STRING, trip_id STRING, "
    "direction_id INT, latitude DOUBLE, longitude DOUBLE, bearing DOUBLE, speed_mps DOUBLE, "
    "current_stop_sequence INT, stop_id STRING, status STRING, vehicle_timestamp BIGINT, "
    "vehicle_age_seconds BIGINT"
)

# table -> (layout, partition columns, key, required columns)
TABLES: dict[str, tuple[str, list[str], list[str], list[str]]] = {
    "raw_vehicle_positions": (RAW_VEHICLE_POSITIONS, ["service_date", "hour"], [], []),
    "raw_alerts": (RAW_ALERTS, ["service_date"], [], ["service_date", "ingested_at", "entity_id"]),
    "raw_trip_updates": (RAW_TRIP_UPDATES, ["service_date", "hour"], [], []),
    "fact_vehicle_positions": (
        FACT_VEHICLE_POSITIONS, ["trip_start_date"], ["service_date", "entity_id", "snapshot_timestamp"],
        ["service_date", "snapshot_timestamp", "entity_id", "static_version_date"]),
    "fact_trip_updates": (
        FACT_TRIP_UPDATES, ["trip_start_date"], ["trip_start_date", "trip_id"],
        ["service_date", "snapshot_timestamp", "entity_id", "trip_id", "trip_start_date", "static_version_date"]),
    "fact_alerts": (FACT_ALERTS, [], ["entity_id"], ["entity_id", "snapshot_timestamp", "static_version_date"]),
    "fact_alerts_routes": (
        FACT_ALERTS_ROUTES, [], ["entity_id", "route_id", "stop_id"],
        ["entity_id", "snapshot_timestamp", "route_id", "stop_id"]),
    "fact_alerts_active_periods": (
        FACT_ALERTS_ACTIVE_PERIODS, [], ["entity_id", "period_index"],
        ["entity_id", "snapshot_timestamp", "period_index", "active_start", "is_open_ended"]),
    "metric_on_time": (
        METRIC_ON_TIME, ["trip_start_date"], ["service_date", "trip_id", "stop_sequence"],
        ["service_date", "trip_id", "stop_sequence", "static_version_date"]),
    "metric_occupancy_route_hour": (
        METRIC_OCCUPANCY_ROUTE_HOUR, ["service_date"], ["service_date", "hour", "route_id"],
        ["service_date", "hour", "route_id"]),
    "metric_alerts_by_day": (METRIC_ALERTS_BY_DAY, ["alert_date"], ["alert_date", "route_id"], []),
    "metric_alerts_by_day_stops": (
        METRIC_ALERTS_BY_DAY_STOPS, ["alert_date"], ["alert_date", "stop_name"], []),
    "metric_service_delivered": (
        METRIC_SERVICE_DELIVERED, ["trip_start_date"], ["trip_start_date", "route_id", "direction_id"],
        ["service_date", "trip_start_date", "route_id"]),
}


def columns_of(layout: str) -> list[str]:
    """Column names of a layout string."""
    depth, names, start = 0, [], True
    for token in layout.replace(",", " , ").replace("<", " < ").replace(">", " > ").split():
        if token in "<>":
            depth += 1 if token == "<" else -1
        elif token == "," and depth == 0:
            start = True
        elif start:
            names.append(token)
            start = False
    return names


def conform(df: DataFrame, layout: str) -> DataFrame:
    """``df`` with the columns and types of ``layout``, by name; absent columns become NULL."""
    schema = df.sparkSession.createDataFrame([], layout).schema
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create every table that is not there yet, partitioned by its date column."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, (layout, partitions, _, _) in TABLES.items():
        by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        at = f"LOCATION '{location.rstrip('/')}/{table}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({layout}) USING parquet {by} {at}")
