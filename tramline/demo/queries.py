"""Registered queries: every operator of the library over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.demo import roles, trees
from tramline.demo.feeds import encode_vehicle_snapshots, encode_trip_updates, encode_alerts
from tramline.functions import rates, times
from tramline.functions import text as texts
from tramline.operators import checks, latest, merge, sampling
from tramline.operators.versions import link_version
from tramline.plans import daily, dashboards, facts, live, marts, raw
from tramline.schemas import FACT_ALERTS, TABLES, columns_of, conform
from tramline.session import HUGE, at_most, scratch_dir
from tramline.sinks import tables as sinks
from tramline.sinks.state import LatestState
from tramline.sources import schedule
from tramline.sources.recent import read_recent
from tramline.sources.snapshots import decode_snapshots, read_snapshot_files
from tramline.streaming import jobs, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ONE_EVENT_DAY = date(2024, 1, 10)
ONE_ALERT_DAY = date(1998, 6, 1)
AS_OF = 896_659_200  # 1998-06-01 00:00:00 UTC
DIGITS = 9

c = F.col


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    """Sums of doubles depend on their order in the last bits; results are compared to 9 digits."""
    return df.withColumns({x: F.round(x, digits) for x in columns})


# ---------------------------------------------------------------- shared inputs


def _new_positions(spark: SparkSession, sf: str) -> DataFrame:
    return facts.fact_vehicle_positions(
        roles.raw_vehicle_positions(spark, sf), roles.event_versions(spark, sf), *roles.event_days(spark, sf))


def _new_updates(spark: SparkSession, sf: str) -> DataFrame:
    return facts.fact_trip_updates(
        roles.raw_trip_updates(spark, sf), roles.order_versions(spark, sf), *roles.trip_days(spark, sf))


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    return roles.stored(spark, sf, "fact_vehicle_positions", lambda: _new_positions(spark, sf))


def _updates(spark: SparkSession, sf: str) -> DataFrame:
    return roles.stored(spark, sf, "fact_trip_updates", lambda: _new_updates(spark, sf))


def _alert_facts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows, versions = roles.raw_alerts(spark, sf), roles.order_versions(spark, sf)
    with at_most(spark, {HUGE: 8000}):  # as in ``build_session``: the JVM would interpret this one's generated method
        periods = roles.stored(spark, sf, "fact_alerts_active_periods", lambda: facts.fact_alerts_active_periods(rows))
    return (
        periods,
        roles.stored(spark, sf, "fact_alerts_routes", lambda: facts.fact_alerts_routes(rows)),
        roles.stored(spark, sf, "fact_alerts", lambda: facts.fact_alerts(rows, versions)),
    )


def _on_time(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mart_on_time(
        _positions(spark, sf), roles.event_stop_times(spark, sf), roles.event_routes(spark, sf), *roles.event_days(spark, sf))


def _occupancy(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mart_occupancy_route_hour(_positions(spark, sf), roles.event_routes(spark, sf), *roles.event_days(spark, sf))


def _alerts_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mart_alerts_by_day(*_alert_facts(spark, sf), roles.order_routes(spark, sf), *roles.alert_days(spark, sf))


def _alerts_by_stop(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mart_alerts_by_day_stops(*_alert_facts(spark, sf), roles.order_stops(spark, sf), *roles.alert_days(spark, sf))


def _services(spark: SparkSession, sf: str) -> DataFrame:
    return marts.active_services(
        roles.calendar(spark, sf), roles.calendar_dates(spark, sf), roles.order_versions(spark, sf), *roles.trip_days(spark, sf))


def _scheduled(spark: SparkSession, sf: str) -> DataFrame:
    return marts.scheduled_trips(
        roles.order_trips(spark, sf), roles.order_routes(spark, sf), roles.order_stop_times(spark, sf),
        _services(spark, sf))


def _delivered(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mart_service_delivered(
        _updates(spark, sf), roles.order_trips(spark, sf), roles.order_routes(spark, sf),
        roles.order_stop_times(spark, sf), roles.calendar(spark, sf), roles.calendar_dates(spark, sf),
        roles.order_versions(spark, sf), *roles.trip_days(spark, sf))


def _newest_stamp(entities: DataFrame) -> Column:
    return entities.agg(F.max("feed_timestamp")).scalar() + 60


def _vehicles(spark: SparkSession, sf: str) -> DataFrame:
    entities = roles.vehicle_entities(spark, sf)
    return live.live_vehicles(
        live.newest_per_vehicle(entities), roles.stops_once(spark, sf), roles.live_trips(spark, sf),
        _newest_stamp(entities))


# ---------------------------------------------------------------- latest rows


@query
def latest_snapshot_dedupe(spark, sf):
    rows = roles.raw_alerts(spark, sf).select(
        "service_date", "entity_id", "snapshot_timestamp", "severity_level", "cause", "effect")
    return latest.latest_snapshot_per_key(
        rows, ["service_date", "entity_id"], [c("severity_level").asc(), c("cause").asc(), c("effect").asc()])


@query
def hourly_trip_state(spark, sf):
    rows = roles.raw_trip_updates(spark, sf).select(
        "service_date", "hour", "trip_id", "trip_start_date", "snapshot_timestamp", "entity_id", "trip_schedule_rel")
    return latest.latest_snapshot_per_key(
        rows, ["service_date", "hour", "trip_id", "trip_start_date"], [c("entity_id").desc()])


@query
def final_trip_state(spark, sf):
    return _new_updates(spark, sf).select(
        "trip_start_date", "trip_id", "snapshot_timestamp", "ingested_at", "entity_id", "trip_schedule_rel")


@query
def earliest_stop_event(spark, sf):
    return marts.stop_arrivals(_positions(spark, sf)).select(
        "trip_start_date", "trip_id", "stop_sequence", "actual_arrival_ts", "actual_arrival_seconds", "stop_id")


@query
def first_scheduled_stop(spark, sf):
    return marts.first_departures(roles.order_stop_times(spark, sf))


# ---------------------------------------------------------------- facts and versions


@query
def fact_vehicle_positions(spark, sf):
    return _new_positions(spark, sf).drop(
        "multi_carriage_details", "trip_start_time", "vehicle_label", "bearing", "odometer", "congestion_level")


@query
def fact_trip_updates(spark, sf):
    return _new_updates(spark, sf).select(
        "service_date", "hour", "snapshot_timestamp", "ingested_at", "gtfs_realtime_version", "entity_id",
        "is_deleted", "trip_id", "route_id", "direction_id", "trip_start_date", "trip_schedule_rel",
        "trip_update_timestamp", "delay", "static_version_date")


@query
def asof_static_version(spark, sf):
    days = roles.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_sub(F.to_date("l_shipdate"), 400).alias("day"))
    return link_version(days, roles.order_versions(spark, sf), "day", required=False)


# ---------------------------------------------------------------- on-time performance


@query
def mart_on_time(spark, sf):
    return _on_time(spark, sf)


@query
def on_time_by_day(spark, sf):
    return rounded(dashboards.on_time_trend(_on_time(spark, sf), *roles.event_days(spark, sf)), "on_time_pct", "early_pct", "late_pct")


@query
def on_time_by_hour(spark, sf):
    trend = dashboards.on_time_trend(_on_time(spark, sf), ONE_EVENT_DAY, ONE_EVENT_DAY)
    return rounded(trend, "on_time_pct", "early_pct", "late_pct")


@query
def worst_routes(spark, sf):
    worst = dashboards.least_punctual_routes(_on_time(spark, sf), *roles.event_days(spark, sf))
    return rounded(worst, "on_time_pct", "early_pct", "late_pct")


# ---------------------------------------------------------------- occupancy


@query
def mart_occupancy_route_hour(spark, sf):
    return rounded(_occupancy(spark, sf), "avg_occupancy_pct")


_OCCUPANCY_MEANS = ["avg_occupancy_pct", *marts.OCCUPANCY_SHARES, "pct_no_data_occupancy"]


@query
def occupancy_rollup_day(spark, sf):
    return rounded(dashboards.occupancy_trend(_occupancy(spark, sf), *roles.event_days(spark, sf)), *_OCCUPANCY_MEANS)


@query
def occupancy_rollup_hour(spark, sf):
    trend = dashboards.occupancy_trend(
        _occupancy(spark, sf), ONE_EVENT_DAY, ONE_EVENT_DAY, routes=["NATION_3", "NATION_18", "92", "87"])
    return rounded(trend, *_OCCUPANCY_MEANS)


@query
def crowded_routes(spark, sf):
    return rounded(dashboards.crowded_routes(_occupancy(spark, sf), *roles.event_days(spark, sf)), "avg_occupancy_pct")


@query
def route_options(spark, sf):
    return dashboards.route_options(_occupancy(spark, sf))


# ---------------------------------------------------------------- service delivered


@query
def active_services(spark, sf):
    return _services(spark, sf)


@query
def scheduled_trips(spark, sf):
    return _scheduled(spark, sf)


@query
def trip_delivery(spark, sf):
    return marts.trip_delivery(_scheduled(spark, sf), _updates(spark, sf), *roles.trip_days(spark, sf))


@query
def added_trip_counts(spark, sf):
    return marts.added_trip_counts(_updates(spark, sf), *roles.trip_days(spark, sf))


@query
def mart_service_delivered(spark, sf):
    return _delivered(spark, sf)


@query
def service_delivered_daily(spark, sf):
    return dashboards.service_trend(_delivered(spark, sf), *roles.trip_days(spark, sf))


# ---------------------------------------------------------------- alerts


@query
def alert_entities_exploded(spark, sf):
    return facts.fact_alerts_routes(roles.raw_alerts(spark, sf))


@query
def alert_periods_exploded(spark, sf):
    return rounded(facts.fact_alerts_active_periods(roles.raw_alerts(spark, sf)), "duration_hours")


@query
def alert_text(spark, sf):
    return facts.fact_alerts(roles.raw_alerts(spark, sf), roles.order_versions(spark, sf))


def _two_loads(rows: DataFrame, build: Callable[[DataFrame], DataFrame], table: str) -> DataFrame:
    """A first load of the older half of the days, then of all days, the later one merged into the first."""
    layout, _, keys, _ = TABLES[table]
    cut = F.lit(ONE_ALERT_DAY)
    first = build(rows.where(c("service_date") < cut))
    second = build(rows.where(c("service_date") >= cut))
    return merge.merge_latest(conform(second, layout), conform(first, layout), keys)


@query
def fact_alerts_upsert(spark, sf):
    versions = roles.order_versions(spark, sf)
    return _two_loads(roles.raw_alerts(spark, sf), lambda r: facts.fact_alerts(r, versions), "fact_alerts")


@query
def alert_routes_upsert(spark, sf):
    return _two_loads(roles.raw_alerts(spark, sf), facts.fact_alerts_routes, "fact_alerts_routes")


@query
def alert_periods_upsert(spark, sf):
    merged = _two_loads(roles.raw_alerts(spark, sf), facts.fact_alerts_active_periods, "fact_alerts_active_periods")
    return rounded(merged, "duration_hours")


@query
def alerts_active_on_day(spark, sf):
    periods, _, _ = _alert_facts(spark, sf)
    return marts.alert_days(periods, ONE_ALERT_DAY, ONE_ALERT_DAY)


@query
def mart_alerts_by_day(spark, sf):
    return _alerts_by_day(spark, sf)


@query
def mart_alerts_by_stop(spark, sf):
    return rounded(_alerts_by_stop(spark, sf), "stop_lat", "stop_lon")


@query
def alerts_by_route(spark, sf):
    names = ["NATION_3", "NATION_18", "92"]
    return dashboards.alerts_by_route(_alerts_by_day(spark, sf), *roles.alert_days(spark, sf), routes=names)


@query
def alert_daily_totals(spark, sf):
    return dashboards.daily_alert_totals(_alerts_by_day(spark, sf), *roles.alert_days(spark, sf))


@query
def alert_max_daily_total(spark, sf):
    return dashboards.highest_daily_total(_alerts_by_day(spark, sf), *roles.alert_days(spark, sf))


@query
def top_alert_routes(spark, sf):
    return dashboards.top_alert_routes(_alerts_by_day(spark, sf), *roles.alert_days(spark, sf), severities=["SEVERE", "WARNING"])


@query
def alert_hotspots(spark, sf):
    return rounded(dashboards.alert_hotspots(_alerts_by_stop(spark, sf), *roles.alert_days(spark, sf)), "stop_lat", "stop_lon")


@query
def top_alert_stops(spark, sf):
    return rounded(dashboards.top_alert_stops(_alerts_by_stop(spark, sf), *roles.alert_days(spark, sf)), "stop_lat", "stop_lon")


# ---------------------------------------------------------------- live view


@query
def live_vehicles(spark, sf):
    return _vehicles(spark, sf)


@query
def live_routes(spark, sf):
    return live.live_routes(_vehicles(spark, sf))


@query
def one_vehicle(spark, sf):
    return live.one_vehicle(_vehicles(spark, sf), "v12")


@query
def fleet_summary(spark, sf):
    return live.fleet_summary(_vehicles(spark, sf), fresh_only=True)


@query
def feed_freshness(spark, sf):
    feeds = {
        "alerts": roles.alert_entity_rows(spark, sf).select("feed_timestamp"),
        "trip_updates": roles.trip_update_entities(spark, sf).select("feed_timestamp"),
        "vehicle_positions": roles.vehicle_entities(spark, sf).select("feed_timestamp"),
    }
    return live.feed_freshness(feeds, 1_706_700_000)


@query
def upcoming_stops(spark, sf):
    return live.upcoming_stops(
        roles.order_vehicles(spark, sf), roles.trip_update_entities(spark, sf), roles.stops_once(spark, sf), AS_OF)


@query
def live_alerts(spark, sf):
    alerts = live.live_alerts(roles.alert_entity_rows(spark, sf), AS_OF)
    return alerts.withColumn("routes_affected", F.array_join("routes_affected", ","))


@query
def live_alerts_shown(spark, sf):
    alerts = live.live_alerts(roles.alert_entity_rows(spark, sf), AS_OF, route_id="SL1")
    shown = live.alerts_shown(alerts, [c("alert_id").asc()])
    return shown.withColumn("routes_affected", F.array_join("routes_affected", ","))


@query
def load_quality(spark, sf):
    rows = live.recent_rows(roles.vehicle_entities(spark, sf), 1_706_700_000)
    return live.load_quality(rows)


# ---------------------------------------------------------------- labels and shapes


@query
def direction_labels(spark, sf):
    return live.direction_labels(roles.live_trips(spark, sf))


@query
def selected_shapes(spark, sf):
    return live.selected_shapes(roles.live_trips(spark, sf))


@query
def route_shapes(spark, sf):
    lines = live.route_shapes(roles.live_trips(spark, sf), roles.shapes(spark, sf))
    points = F.transform("coordinates", lambda p: F.concat_ws(
        " ", F.round(p[0]).cast("bigint"), F.round(p[1] * 1000).cast("bigint")))
    return lines.withColumn("coordinates", F.array_join(points, ","))


@query
def map_bounds(spark, sf):
    lines = live.route_shapes(roles.live_trips(spark, sf), roles.shapes(spark, sf), route_id="SL1")
    shown = live.vehicles_of_route(_vehicles(spark, sf), "SL1")
    return rounded(live.map_bounds(lines, shown), "min_lon", "min_lat", "max_lon", "max_lat")


# ---------------------------------------------------------------- scalar functions


@query
def gtfs_time_seconds(spark, sf):
    rows = roles.order_stop_times(spark, sf).withColumn(
        "clock", F.when(c("stop_sequence") % 5 == 0, "").otherwise(c("departure_time")))
    return rows.select("trip_id", "stop_sequence", "clock", times.gtfs_seconds("clock").alias("clock_seconds"))


@query
def eastern_wall_time(spark, sf):
    epoch = times.wall_epoch("l_shipdate") + c("l_partkey") * 7 % 86400
    return roles.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", epoch.alias("epoch"),
        times.utc_wall_time(epoch).alias("utc_ts"), times.local_wall_time(epoch).alias("eastern_ts"))


@query
def scalar_cleanup(spark, sf):
    user, at = c("user_id"), times.wall_epoch("ts")
    route = roles.bus_id(user % 25)
    speed = F.floor("value") / 10.0
    return roles.table(spark, sf, "events").select(
        "event_id", texts.is_bus_route(route).alias("is_bus"),
        texts.schedule_relation(F.when(user % 4 == 0, " ").when(user % 4 == 1, "ADDED ")).alias("relation"),
        times.iso_utc(at).alias("iso_text"), times.compact_zulu(at).alias("compact_text"),
        times.age_seconds(at, 1_705_000_000).alias("age"), rates.mph(speed).alias("speed_mph"),
        times.gtfs_date(F.date_format("ts", "yyyyMMdd")).alias("parsed_day"),
        F.date_format("ts", "E").alias("day_name"),
        texts.enum_label(user % 5, {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}).alias("status_text"),
        texts.enum_label(user % 5, {0: "INCOMING_AT", 1: "STOPPED_AT"}, "NO_DATA").alias("status_or_default"),
        times.minute_boundaries("ts", roles.plus_seconds(c("ts"), user * 13)).alias("minutes_crossed"),
        times.seconds_since_midnight("ts", F.date_sub(F.to_date("ts"), 1)).alias("trip_seconds"),
        rates.is_on_time(F.when(user % 7 != 0, user % 600 - 200)).alias("on_time"),
    )


@query
def route_order(spark, sf):
    """Place of each route name in rider order and in dashboard order; there are at most 25 distinct names."""
    from pyspark.sql import Window

    ids = roles.table(spark, sf, "events").select(roles.bus_id(c("user_id") % 25).alias("route_id")).where(
        c("route_id").isNotNull()).distinct()
    rider = Window.orderBy(texts.route_sort_key("route_id"))
    board = Window.orderBy(*texts.route_name_order("route_id"))
    return ids.select("route_id", F.row_number().over(rider).alias("rider_place"),
                      F.row_number().over(board).alias("dashboard_place"))


# ---------------------------------------------------------------- sources


@query
def file_stride_sample(spark, sf):
    """Every 5th line of each ship month, lines standing for snapshot files."""
    files = roles.table(spark, sf, "lineitem").select(
        F.trunc(F.to_date("l_shipdate"), "month").alias("month"), "l_shipdate", "l_orderkey", "l_linenumber",
        "l_partkey", "l_suppkey")
    order = [c(x).asc() for x in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return sampling.every_nth(files, ["month"], c("l_shipdate"), order, 5).drop("month")


@query
def protobuf_vehicle_positions(spark, sf):
    files = encode_vehicle_snapshots(roles.raw_vehicle_positions(spark, sf))
    return raw.raw_vehicle_positions(decode_snapshots(files, "vehicle_positions")).select(
        "service_date", "hour", "snapshot_timestamp", "gtfs_realtime_version", "entity_id", "is_deleted", "trip_id",
        "route_id", "direction_id", "trip_start_date", "trip_schedule_rel", "vehicle_id", "current_stop_sequence",
        "stop_id", "current_status", "occupancy_status", "occupancy_percentage", "position_timestamp")


@query
def protobuf_trip_updates(spark, sf):
    files = encode_trip_updates(roles.raw_trip_updates(spark, sf))
    return raw.raw_trip_updates(decode_snapshots(files, "trip_updates")).select(
        "service_date", "hour", "snapshot_timestamp", "trip_id", "trip_start_date", "entity_id", "trip_schedule_rel",
        "delay", F.size("stop_time_update").alias("stop_count"))


@query
def protobuf_alerts(spark, sf):
    files = encode_alerts(roles.raw_alerts(spark, sf))
    rows = decode_snapshots(files, "alerts")
    flat = raw.raw_alerts(rows)
    return flat.groupBy("service_date").agg(
        F.count("*").alias("alert_count"), F.max("snapshot_timestamp").alias("last_snapshot"))


def _from_tree(spark: SparkSession, entities: DataFrame, feed: str, stride: int = 1) -> DataFrame:
    """The raw table of a feed whose snapshot tree is written first and read back as files."""
    base = scratch_dir(spark, "rt")
    trees.write_entities(entities, base, feed)
    files = read_snapshot_files(spark, base, feed, *trees.day_range(entities), stride)
    return raw.RAW_BUILDERS[feed](decode_snapshots(files, feed)).drop("ingested_at")


@query
def raw_positions_from_files(spark, sf):
    """Every file of every hour, every column of the raw table; the carriages as text."""
    rows = _from_tree(spark, trees.position_entities(roles.raw_vehicle_positions(spark, sf)), "vehicle_positions")
    carriages = trees.flat("multi_carriage_details", *[lambda x, f=f: x[f] for f in (
        "id", "label", "occupancy_status", "occupancy_percentage", "carriage_sequence")])
    return rows.withColumn("carriages", carriages).drop("multi_carriage_details")


@query
def raw_updates_from_files(spark, sf):
    """Every fifth file of each hour, every column of the raw table; nested ones as text."""
    rows = _from_tree(spark, trees.update_entities(roles.raw_trip_updates(spark, sf)), "trip_updates", daily.TRIP_UPDATE_STRIDE)
    stops = trees.flat(
        "stop_time_update", lambda x: x.stop_sequence, lambda x: x.arrival.delay, lambda x: x.arrival.time, lambda x: x.arrival.uncertainty,
        lambda x: x.departure.time, lambda x: x.stop_id, lambda x: x.schedule_relationship)
    return rows.withColumns({
        "stops": stops, "modification": c("modified_trip.modifications_id"), "property_trip": c("trip_properties.trip_id"),
        "property_shape": c("trip_properties.shape_id")}).drop("stop_time_update", "modified_trip", "trip_properties")


@query
def raw_alerts_from_files(spark, sf):
    """The newest snapshot of each alert and day, every column of the raw table; lists and texts flattened."""
    lines = roles.wide_table(spark, sf, "lineitem")
    rows = roles.raw_alerts_of(lines, F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    found = _from_tree(spark, trees.alert_entities(rows), "alerts")
    told = {f: trees.flat(f"{f}.translation", lambda x: x.text, lambda x: x.language) for f in (
        "url", "header_text", "description_text", "tts_header_text", "tts_description_text", "cause_detail", "effect_detail")}
    lists = {
        "active_period": trees.flat("active_period", lambda x: x.start, lambda x: x.end),
        "informed_entity": trees.flat("informed_entity", *[lambda x, f=f: x[f] for f in (
            "agency_id", "route_id", "route_type", "stop_id", "direction_id")], lambda x: x.trip.trip_id),
    }
    return found.withColumns(told | lists)


@query
def raw_day_reload(spark, sf):
    """A range of days loaded twice: the second time with other entities, without some hours and without whole days."""
    base = [scratch_dir(spark, "rt") for _ in range(2)]
    entities = trees.position_entities(roles.raw_vehicle_positions(spark, sf))
    even = c("entity.id").cast("bigint") % 2 == 0
    there = ~c("hour").between(3, 5) & (F.dayofmonth("service_date") != 10)
    trees.write_entities(entities.where(even), base[0], "vehicle_positions")
    trees.write_entities(entities.where(~even & there), base[1], "vehicle_positions")
    first, last = trees.day_range(entities)
    warehouse = daily.Warehouse(spark, scratch_dir(spark, "warehouse"))
    daily.load_raw(warehouse, base[0], "vehicle_positions", first, last)
    daily.load_raw(warehouse, base[1], "vehicle_positions", first, first + timedelta(days=15))
    return warehouse.read("raw_vehicle_positions").select("service_date", "hour", "entity_id", "snapshot_timestamp")


@query
def csv_dims_roundtrip(spark, sf):
    """Stop times written as a schedule folder of text files and read back as a typed dimension."""
    folder = f"{scratch_dir(spark, 'schedule')}/v_20240105_020012"
    info = roles.table(spark, sf, "region").groupBy().agg(F.count("*").alias("n")).select(
        F.lit("20240101").alias("feed_start_date"), F.lit("20240331").alias("feed_end_date"),
        F.concat(F.lit('winter, "second" '), c("n")).alias("feed_version"))
    lines = roles.order_stop_times(spark, sf).select(
        "trip_id", "stop_sequence", F.concat(F.lit('stop "'), c("stop_sequence"), F.lit('", north')).alias("stop_id"),
        c("departure_time").alias("arrival_time"), "departure_time",
        F.when(c("stop_sequence") % 2 == 0, "x").otherwise(c("stop_sequence").cast("string")).alias("timepoint"))
    for name, rows in (("feed_info", info), ("stop_times", lines)):
        rows.write.option("header", True).option("quote", '"').option("escape", '"').csv(f"{folder}/{name}.txt")
    tables = {"feed_info": schedule.read_schedule_csv(spark, f"{folder}/feed_info.txt")}
    start = schedule.cast_dimension(tables["feed_info"], "feed_info").agg(F.first("feed_start_date")).scalar()
    typed = schedule.cast_dimension(schedule.read_schedule_csv(spark, f"{folder}/stop_times.txt"), "stop_times")
    return typed.select(start.alias("feed_start_date"), "trip_id", "stop_sequence", "stop_id", "departure_time",
                        "arrival_seconds", "departure_seconds", "timepoint")


@query
def static_version_discovery(spark, sf):
    """Schedule folders named after the quarters of the orders, listed back with their parsed stamps."""
    base = scratch_dir(spark, "versions")
    info = roles.order_versions(spark, sf).withColumn("feed_version", F.lit("quarter"))
    # One folder per version: their number is bounded by the quarters of the calendar.
    for (start,) in info.select("feed_start_date").collect():
        folder = f"{base}/v_{start:%Y%m%d}_020012/feed_info.txt"
        info.where(c("feed_start_date") == F.lit(start)).write.option("header", True).csv(folder)
    return schedule.list_versions(spark, base).drop("folder")


# ---------------------------------------------------------------- sinks and checks


@query
def partition_replace(spark, sf):
    """A mart written twice, the second time with one day emptied and others changed."""
    path = scratch_dir(spark, "mart")
    rows = roles.table(spark, sf, "events").groupBy(F.to_date("ts").alias("service_date"), "event_type").agg(
        F.count("*").alias("n"))
    sinks.replace_partitions(rows, path, ["service_date"])
    gone, changed = date(2024, 1, 5), date(2024, 1, 6)
    again = rows.where(c("service_date") != F.lit(gone)).withColumn("n", -c("n"))
    sinks.replace_days(again, path, "service_date", [gone, changed])
    return spark.read.schema(rows.schema).parquet(path)


@query
def upsert_state(spark, sf):
    """Three loads in wrong order into a stored latest-wins table, the last one twice."""
    layout, _, keys, _ = TABLES["fact_alerts_routes"]
    ties = [c(x).asc_nulls_first() for x in ("route_type", "direction_id", "agency_id")]
    state = LatestState(spark, scratch_dir(spark, "state"), layout, keys, ties)
    rows = roles.raw_alerts(spark, sf)
    year = F.year("service_date")
    for part in (year >= 1999, year.between(1997, 1998), year < 1997, year < 1997):
        state.merge(facts.fact_alerts_routes(rows.where(part)))
    return state.read()


@query
def ndjson_roundtrip(spark, sf):
    path = scratch_dir(spark, "recent")
    rows = live.recent_rows(roles.vehicle_entities(spark, sf), c("feed_timestamp") + 2)
    sinks.write_recent(rows.where(c("verdict") == "kept").drop("verdict"), path)
    return rounded(read_recent(spark, path), "latitude", "longitude", "bearing", "speed_mps")


@query
def key_checks(spark, sf):
    positions = _positions(spark, sf)
    _, _, keys, required = TABLES["fact_vehicle_positions"]
    lines = roles.order_stop_times(spark, sf)
    report = checks.constraint_report(positions, keys, required)
    other = checks.constraint_report(lines, ["feed_start_date", "trip_id", "stop_sequence"], ["departure_time"])
    missing = checks.orphans(
        roles.raw_vehicle_positions(spark, sf).select(F.trunc("trip_start_date", "week").alias("feed_start_date")),
        roles.event_versions(spark, sf), "feed_start_date", "feed_start_date",
    ).select(F.concat(F.lit("orphan "), c("feed_start_date").cast("string")).alias("rule"),
             c("row_count").alias("violations"))
    return report.unionByName(other).unionByName(missing)


@query
def nightly_checks(spark, sf):
    """The nightly report over a warehouse of facts, marts and raw rows, some positions stored twice."""
    warehouse = daily.Warehouse(spark, scratch_dir(spark, "warehouse"))
    positions, (periods, alert_routes, alerts) = _positions(spark, sf), _alert_facts(spark, sf)
    tables = {
        "raw_vehicle_positions": roles.raw_vehicle_positions(spark, sf), "raw_trip_updates": roles.raw_trip_updates(spark, sf),
        "fact_vehicle_positions": positions.unionByName(positions.where(c("entity_id").cast("bigint") % 100 == 7)),
        "fact_trip_updates": _updates(spark, sf), "metric_on_time": _on_time(spark, sf), "metric_occupancy_route_hour": _occupancy(spark, sf),
        "metric_alerts_by_day": _alerts_by_day(spark, sf), "metric_alerts_by_day_stops": _alerts_by_stop(spark, sf),
        "metric_service_delivered": _delivered(spark, sf),
    }
    for name, rows in tables.items():
        conform(rows, TABLES[name][0]).write.parquet(warehouse.path(name))
    roles.event_versions(spark, sf).write.parquet(warehouse.path("dim_static_versions"))
    for name, rows in (("fact_alerts", alerts), ("fact_alerts_routes", alert_routes), ("fact_alerts_active_periods", periods)):
        warehouse.state(name).merge(rows)
    ranges = [roles.event_days(spark, sf), roles.trip_days(spark, sf), roles.alert_days(spark, sf)]
    return daily.check_days(warehouse, min(r[0] for r in ranges), max(r[1] for r in ranges))


# ---------------------------------------------------------------- streams


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.table_stream(spark, sf, "events.parquet")


def _stream_columns(events: DataFrame) -> DataFrame:
    return events.select(
        c("ts"), F.to_date("ts").alias("service_date"), F.hour("ts").alias("hour"), c("event_id"),
        c("user_id").cast("string").alias("vehicle_id"), (c("user_id") % 25).cast("string").alias("route_id"),
        F.concat(F.lit("S"), (c("event_id") % 400).cast("string")).alias("stop_id"),
        F.when(c("event_type") != "error", F.least(F.floor("value"), F.lit(100)).cast("int"))
        .alias("occupancy_percentage"),
        F.date_sub(F.to_date("ts"), F.when(c("event_id") % 3 == 0, 1).otherwise(0)).alias("trip_start_date"),
        (c("event_id") % 50 == 0).alias("is_deleted"),
    )


def _finish(stream_query) -> None:
    stream_query.awaitTermination()


def _arrivals(rows: DataFrame, batch: Column, n: int) -> list[DataFrame]:
    """``rows`` in the ``n`` parts that ``batch`` (0 to n - 1) deals them to."""
    path = scratch_dir(rows.sparkSession, "arrivals")
    rows.withColumn("arrival", batch).write.partitionBy("arrival").parquet(path)
    stored = rows.sparkSession.read.schema(T.StructType([*rows.schema.fields, T.StructField("arrival", T.IntegerType())])).parquet(path)
    return [stored.where(c("arrival") == i).drop("arrival") for i in range(n)]


def _by_days(rows: DataFrame, day: str, days: int, n: int) -> Column:
    """Number of the stretch of ``days`` days, from the first day of the table, that a row lies in; the last takes the rest."""
    first = rows.agg(F.min(F.to_date(day))).scalar()
    return F.greatest(F.lit(0), F.least(F.floor(F.datediff(F.to_date(day), first) / days), F.lit(n - 1))).cast("int")


@query
def stream_hourly_counts(spark, sf):
    folder = scratch_dir(spark, "hourly")
    state = LatestState(spark, f"{folder}/state", "hour_start timestamp, route_id string, snapshot_count bigint, report_count bigint, "
                        "avg_occupancy_pct double, batch bigint", ["hour_start", "route_id"], newest="batch")
    rows = _stream_columns(roles.table(spark, sf, "events"))

    def start():
        events = jobs.with_event_time(jobs.table_stream(spark, f"{folder}/in"), "ts", "1 day")
        return jobs.updates_to_state(jobs.hourly_occupancy(events), state, folder)

    jobs.run_arrivals([{f"{folder}/in": part} for part in _arrivals(rows, _by_days(rows, "ts", 10, 3), 3)], start)
    found = state.read().drop("batch").withColumn("hour_start", c("hour_start").cast("timestamp_ntz"))
    return rounded(found, "avg_occupancy_pct")


@query
def stream_latest_state(spark, sf):
    """Vehicles over four arrivals; the state of one that is silent for ten days is freed, its row stays in the table."""
    folder = scratch_dir(spark, "latest")
    layout = "vehicle_id string, ts timestamp_ntz, event_id bigint, route_id string, occupancy_percentage int"
    state = LatestState(spark, f"{folder}/state", layout, ["vehicle_id"], [c("event_id").desc()], newest="ts")
    rows = _stream_columns(roles.table(spark, sf, "events")).select("vehicle_id", "ts", "event_id", "route_id", "occupancy_percentage")

    def start():
        events = jobs.with_event_time(jobs.table_stream(spark, f"{folder}/in"), "ts", "1 hour")
        return jobs.updates_to_state(stateful.latest_rows(events, "vehicle_id", "ts", "event_id", 10), state, folder, keyed=True)

    jobs.run_arrivals([{f"{folder}/in": part} for part in _arrivals(rows, _by_days(rows, "ts", 8, 4), 4)], start)
    return state.read()


@query
def stream_final_trips(spark, sf):
    """Final state of every trip whose two days are over, out of six arrivals; rows that come more than a year late are dropped."""
    folder = scratch_dir(spark, "finals")
    rows = facts.valid_trip_updates(roles.raw_trip_updates(spark, sf)).drop("modified_trip", "stop_time_update", "trip_properties")
    stretch = _by_days(rows, "service_date", 122, 6)
    late = (stretch <= 2) & (c("trip_id").cast("bigint") % 50 == 7) & (c("delay") % 2 == 0)

    def start():
        updates = jobs.with_event_time(jobs.table_stream(spark, f"{folder}/in"), "snapshot_timestamp", "1 hour")
        return jobs.append_to_table(stateful.final_trips(updates), folder, keyed=True)

    jobs.run_arrivals([{f"{folder}/in": part} for part in _arrivals(rows, F.when(late, 5).otherwise(stretch), 6)], start)
    return spark.read.parquet(f"{folder}/rows").select(
        "trip_start_date", "trip_id", "snapshot_timestamp", "ingested_at", "entity_id", "trip_schedule_rel")


@query
def stream_dropped_rows(spark, sf):
    """Vehicles seen per day over four arrivals; rows of the first days that come with the last arrival are dropped and counted."""
    folder = scratch_dir(spark, "dropped")
    rows = _stream_columns(roles.table(spark, sf, "events"))
    stretch = _by_days(rows, "ts", 8, 4)
    late = (stretch == 0) & (c("event_id") % 40 == 3)

    def start():
        events = jobs.with_event_time(jobs.table_stream(spark, f"{folder}/in"), "ts", "2 days")
        return jobs.append_to_table(jobs.drop_repeats(events, ["service_date", "vehicle_id"]).select("service_date", "vehicle_id"), folder)

    progress = jobs.run_arrivals([{f"{folder}/in": part} for part in _arrivals(rows, F.when(late, 3).otherwise(stretch), 4)], start)
    return spark.read.parquet(f"{folder}/rows").agg(
        F.count("*").alias("rows_kept"), F.lit(jobs.rows_dropped(progress)).cast("bigint").alias("rows_dropped"))


@query
def stream_vehicle_updates(spark, sf):
    """Vehicle rows with every update of the vehicle within six hours, or alone; both sides arrive in four parts."""
    folder = scratch_dir(spark, "interval")
    rows = roles.table(spark, sf, "events").select("event_id", c("user_id").cast("string").alias("vehicle_id"), "ts", "event_type")
    parts = _arrivals(rows, _by_days(rows, "ts", 8, 4), 4)
    vehicles = [p.where("event_type <> 'click'").drop("event_type") for p in parts]
    updates = [p.where("event_type = 'click'").select("vehicle_id", c("ts").alias("update_ts"), c("event_id").alias("update_id")) for p in parts]

    def start():
        left = jobs.table_stream(spark, f"{folder}/vehicles").withColumn("at", c("ts").cast("timestamp")).withWatermark("at", "1 hour")
        right = jobs.table_stream(spark, f"{folder}/updates").withColumn("update_at", c("update_ts").cast("timestamp")).withWatermark(
            "update_at", "2 hours")
        return jobs.append_to_table(stateful.join_intervals(left, right, ["vehicle_id"], "at", "update_at", "6 hours", "6 hours"), folder)

    jobs.run_arrivals([{f"{folder}/vehicles": v, f"{folder}/updates": u} for v, u in zip(vehicles, updates)], start)
    settled = rows.agg(F.date_trunc("day", F.max("ts")) - F.expr("INTERVAL 3 DAYS")).scalar()
    return spark.read.parquet(f"{folder}/rows").where(c("ts") < settled).select("event_id", "vehicle_id", "ts", "update_id", "update_ts")


@query
def stream_enrich_as_of(spark, sf):
    """Positions with the route name of their week's schedule; versions are loaded while the stream runs."""
    folder = scratch_dir(spark, "as-of")
    rows = _stream_columns(roles.table(spark, sf, "events")).select("event_id", "route_id", "trip_start_date", "service_date")
    stretch = _by_days(rows, "service_date", 8, 4)
    names = roles.event_routes(spark, sf).select(
        "feed_start_date", "route_id", F.coalesce("route_short_name", "route_id").alias("route_name"))
    first = rows.agg(F.min("service_date")).scalar()
    loaded = F.greatest(F.lit(0), F.least(F.floor(F.datediff("feed_start_date", first) / 8), F.lit(3))).cast("int")
    dims = f"{folder}/dims"
    parts = zip(_arrivals(names, loaded, 4), _arrivals(rows, stretch, 4))

    def start():
        return jobs.enrich_as_of(jobs.table_stream(spark, f"{folder}/in"), lambda: spark.read.parquet(dims).select("feed_start_date").distinct(),
                                 lambda: spark.read.parquet(dims), folder)

    jobs.run_arrivals([{dims: d, f"{folder}/in": p} for d, p in parts], start)
    return spark.read.parquet(f"{folder}/rows/batch=*").select("event_id", "trip_start_date", "static_version_date", "route_id", "route_name")


@query
def stream_dedupe(spark, sf):
    folder = scratch_dir(spark, "dedupe")
    events = jobs.with_event_time(_stream_columns(_event_stream(spark, sf)), "ts", "60 days")
    _finish(jobs.append_to_table(
        jobs.drop_repeats(events, ["service_date", "vehicle_id"]).select("service_date", "vehicle_id"), folder))
    return spark.read.parquet(f"{folder}/rows")


@query
def stream_late_data(spark, sf):
    folder = scratch_dir(spark, "late")
    kept = jobs.on_time_arrivals(_stream_columns(_event_stream(spark, sf)))
    _finish(jobs.append_to_table(kept.select("event_id", "service_date", "trip_start_date", "hour"), folder))
    return spark.read.parquet(f"{folder}/rows")


@query
def stream_enrich(spark, sf):
    folder = scratch_dir(spark, "enrich")
    names = roles.table(spark, sf, "nation").select(
        (c("n_nationkey") + 2).cast("string").alias("route_id"), c("n_name").alias("route_name"))
    rows = jobs.enrich(_stream_columns(_event_stream(spark, sf)), names, roles.stops_once(spark, sf))
    _finish(jobs.append_to_table(rows.select("event_id", "route_id", "route_name", "stop_id", "stop_name"), folder))
    return spark.read.parquet(f"{folder}/rows")


@query
def stream_alert_merge(spark, sf):
    """Alert snapshots merged batch by batch into the stored latest-wins table."""
    folder = scratch_dir(spark, "alertstream")
    layout, _, keys, _ = TABLES["fact_alerts"]
    versions = roles.order_versions(spark, sf)
    ties = [c(x).asc_nulls_first() for x in columns_of(FACT_ALERTS) if x not in ("entity_id", "snapshot_timestamp")]
    state = LatestState(spark, f"{folder}/state", layout, keys, ties)
    stream = jobs.table_stream(spark, sf, "lineitem.parquet")

    def prepare(batch: DataFrame) -> DataFrame:
        return facts.fact_alerts(roles.raw_alerts_of(batch), versions)

    _finish(jobs.merge_into_state(stream, prepare, state, folder))
    return state.read()


@query
def stream_feed_lag(spark, sf):
    """Newest stamp and lag after the last batch of the vehicle stream."""
    folder = scratch_dir(spark, "lag")
    stamps = _event_stream(spark, sf).select(times.wall_epoch("ts").alias("feed_timestamp"))
    newest = stamps.groupBy().agg(F.max("feed_timestamp").alias("feed_timestamp")).withColumn("feed", F.lit("vehicle_positions"))
    state = LatestState(spark, f"{folder}/state", "feed string, feed_timestamp bigint, batch bigint", ["feed"], newest="batch")
    _finish(jobs.updates_to_state(newest, state, folder))
    return jobs.feed_lag(state.read(), 1_706_700_000)
