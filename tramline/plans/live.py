"""The live view: what is true at one moment, from the newest feed entities and the schedule.

Inputs are decoded entities (see ``sources.snapshots``) with ``feed_timestamp``
and, for trip updates, an ``entity_index`` that gives the order in the feed.
``as_of`` is the moment in epoch seconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.rates import mph
from tramline.functions.text import bus_routes_of, is_bus_route, rider_text, route_sort_key, touches_bus
from tramline.functions.times import age_seconds, iso_utc, iso_zulu
from tramline.operators.latest import first_per_key, top_overall
from tramline.operators.nested import ordered_lines

FRESH_SECONDS = 90
UPCOMING_STOPS = 8
SHAPES_PER_DIRECTION = 3
ALERTS_SHOWN = 6


def newest_feed(entities: DataFrame) -> DataFrame:
    """Entities of the newest snapshot."""
    return entities.where(F.col("feed_timestamp") == entities.agg(F.max("feed_timestamp")).scalar())


def newest_per_vehicle(entities: DataFrame) -> DataFrame:
    """The newest entity per entity id, for feeds that publish changes only."""
    keyed = entities.withColumn("__id", F.col("entity.id"))
    order = [F.col("entity.vehicle.timestamp").desc_nulls_last(), F.col("feed_timestamp").desc_nulls_last(),
             F.xxhash64("entity")]  # equal stamps: the same row on every run
    return first_per_key(keyed, ["__id"], order).drop("__id")


# ---------------------------------------------------------------- direction labels and shapes


def trip_headsigns(trips: DataFrame) -> DataFrame:
    """Headsign of each bus trip that has one, one row per trip."""
    named = trips.where(is_bus_route("route_id") & (F.col("trip_id") != "") & (F.col("trip_headsign") != ""))
    return named.groupBy("trip_id").agg(F.max("trip_headsign").alias("headsign"))


def direction_labels(trips: DataFrame) -> DataFrame:
    """Most common headsign per bus route and direction; equal counts go to the first by text."""
    counts = (
        trips.where(is_bus_route("route_id") & (F.col("trip_headsign") != ""))
        .groupBy("route_id", "direction_id", "trip_headsign").agg(F.count("*").alias("n"))
    )
    best = first_per_key(counts, ["route_id", "direction_id"], [F.col("n").desc(), F.col("trip_headsign").asc()])
    return best.select("route_id", "direction_id", F.col("trip_headsign").alias("direction_label"))


def selected_shapes(trips: DataFrame, per_direction: int = SHAPES_PER_DIRECTION) -> DataFrame:
    """The most used shapes of each bus route and direction, with label and trip count.

    A shape picked for several directions keeps one of them, the last by
    (route, direction).
    """
    counts = (
        trips.where(is_bus_route("route_id") & (F.col("shape_id") != ""))
        .groupBy("route_id", "direction_id", "shape_id").agg(F.count("*").alias("trip_count"))
    )
    top = first_per_key(counts, ["route_id", "direction_id"],
                        [F.col("trip_count").desc(), F.col("shape_id").asc()], n=per_direction)
    one = first_per_key(top, ["shape_id"], [F.col("route_id").desc(), F.col("direction_id").desc()])
    label = F.coalesce("direction_label", F.concat(F.lit("Direction "), "direction_id"))
    return one.join(direction_labels(trips), ["route_id", "direction_id"], "left").withColumn("direction_label", label)


def shape_points(shapes: DataFrame, selected: DataFrame) -> DataFrame:
    """Points of the selected shapes only."""
    return shapes.join(selected.select("shape_id"), "shape_id", "left_semi")


def route_shapes(trips: DataFrame, shapes: DataFrame, route_id: str | None = None) -> DataFrame:
    """Line features of the selected shapes, by direction and falling trip count; an unknown route has none."""
    selected = selected_shapes(trips)
    if route_id is not None:
        selected = selected.where(F.col("route_id") == route_id)
    lines = ordered_lines(shape_points(shapes, selected), ["shape_id"]).where(F.size("coordinates") >= 2)
    return lines.join(selected, "shape_id").select(
        "shape_id", "route_id", "direction_id", "direction_label", "trip_count", "coordinates"
    ).orderBy("route_id", "direction_id", F.col("trip_count").desc(), "shape_id")


def shape_geojson(lines: DataFrame) -> DataFrame:
    """One GeoJSON LineString feature text per shape."""
    properties = F.struct("shape_id", "route_id", "direction_id", "direction_label", "trip_count")
    return lines.select("route_id", "shape_id", _feature("LineString", F.col("shape_id"), F.col("coordinates"),
                                                         properties).alias("feature"))


def _feature(kind: str, feature_id: Column, coordinates: Column, properties: Column) -> Column:
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"), feature_id.alias("id"),
        F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry"),
        properties.alias("properties"),
    ), {"ignoreNullFields": "false"})


# ---------------------------------------------------------------- vehicles


def live_vehicles(entities: DataFrame, stops: DataFrame, trips: DataFrame, as_of: Column | int) -> DataFrame:
    """Current bus positions with names, labels, speed, age and freshness, newest first."""
    v = "entity.vehicle."
    text = F.lit("")
    has_vehicle = F.col(v + "vehicle").isNotNull()
    updated = F.coalesce(F.nullif(F.col(v + "timestamp"), F.lit(0)), F.nullif("feed_timestamp", F.lit(0)))
    buses = entities.where(
        F.col("entity.vehicle").isNotNull()
        & F.col(v + "position.latitude").isNotNull() & F.col(v + "position.longitude").isNotNull()
        & is_bus_route(v + "trip.route_id")
    ).select(
        F.when(has_vehicle, F.coalesce(v + "vehicle.id", text)).otherwise(F.col("entity.id")).alias("vehicle_id"),
        F.when(has_vehicle, F.coalesce(v + "vehicle.label", text)).otherwise(text).alias("vehicle_label"),
        F.col(v + "trip.route_id").alias("route_id"),
        F.coalesce(v + "trip.trip_id", text).alias("trip_id"),
        F.col(v + "trip.direction_id").alias("direction_id"),
        F.coalesce(v + "current_status", F.lit("IN_TRANSIT_TO")).alias("status"),
        F.coalesce(v + "stop_id", text).alias("stop_id"),
        F.col(v + "current_stop_sequence").alias("current_stop_sequence"),
        mph(F.col(v + "position.speed")).alias("speed_mph"),
        updated.alias("updated_timestamp"),
        F.col(v + "position.latitude").cast("double").alias("latitude"),
        F.col(v + "position.longitude").cast("double").alias("longitude"),
    )
    labels = direction_labels(trips).withColumnRenamed("direction_id", "__direction")
    named = (
        buses.withColumn("__direction", F.coalesce(F.col("direction_id").cast("string"), text))
        .join(stop_names(stops), "stop_id", "left")
        .join(trip_headsigns(trips), "trip_id", "left")
        .join(labels, ["route_id", "__direction"], "left")
    )
    age = age_seconds("updated_timestamp", as_of)
    fallback = F.concat(F.lit("Direction "), F.col("direction_id").cast("string"))
    return named.select(
        "vehicle_id", "vehicle_label", "route_id", "trip_id", "direction_id",
        F.coalesce("headsign", "direction_label", fallback, text).alias("direction_label"),
        "status", "stop_id", F.coalesce("stop_name", text).alias("stop_name"), "current_stop_sequence",
        "speed_mph", iso_utc("updated_timestamp").alias("updated_at"), "updated_timestamp",
        age.alias("age_seconds"), F.coalesce(age <= FRESH_SECONDS, F.lit(False)).alias("is_fresh"),
        "latitude", "longitude",
    ).orderBy(F.col("updated_timestamp").desc_nulls_last(), "vehicle_id")


def stop_names(stops: DataFrame) -> DataFrame:
    """One name per stop id."""
    named = stops.where((F.col("stop_id") != "") & (F.col("stop_name") != ""))
    return named.groupBy("stop_id").agg(F.max("stop_name").alias("stop_name"))


def vehicles_of_route(vehicles: DataFrame, route_id: str | None) -> DataFrame:
    return vehicles.where(F.col("route_id") == route_id) if route_id else vehicles


def one_vehicle(vehicles: DataFrame, vehicle_id: str) -> DataFrame:
    """The vehicle with this id, or no row when it is not visible."""
    return top_overall(vehicles.where(F.col("vehicle_id") == vehicle_id),
                       [F.col("updated_timestamp").desc_nulls_last(), F.xxhash64(*vehicles.columns)], 1)


def live_routes(vehicles: DataFrame) -> DataFrame:
    """Routes with a current vehicle, in rider order."""
    return vehicles.select("route_id").distinct().orderBy(route_sort_key("route_id")).select(
        "route_id", F.col("route_id").alias("label"))


def vehicle_geojson(vehicles: DataFrame) -> DataFrame:
    """One GeoJSON Point feature text per vehicle."""
    properties = F.struct(*[c for c in vehicles.columns if c not in ("latitude", "longitude")])
    point = F.array("longitude", "latitude")
    return vehicles.select("vehicle_id", "updated_timestamp",
                           _feature("Point", F.col("vehicle_id"), point, properties).alias("feature"))


def fleet_summary(vehicles: DataFrame, fresh_only: bool = False) -> DataFrame:
    """Active and fresh counts, and mean age (missing as 0) of the rows shown."""
    shown = F.col("is_fresh") if fresh_only else F.lit(True)
    age = F.when(shown, F.coalesce("age_seconds", F.lit(0)))
    return vehicles.agg(
        F.count("*").alias("active_count"),
        F.count_if(F.col("is_fresh")).alias("fresh_count"),
        F.count_if(shown).alias("shown_count"),
        # Rounds halves up, towards later.
        F.floor(F.avg(age) + 0.5).cast("bigint").alias("avg_age_seconds"),
    )


def map_bounds(lines: DataFrame, vehicles: DataFrame, fresh_only: bool = False) -> DataFrame:
    """Box around the given shapes and the vehicles shown."""
    shown = vehicles.where(F.col("is_fresh")) if fresh_only else vehicles
    corners = lines.select(F.explode("coordinates").alias("c")).select(
        F.col("c")[0].alias("lon"), F.col("c")[1].alias("lat"))
    points = corners.unionByName(shown.select(F.col("longitude").alias("lon"), F.col("latitude").alias("lat")))
    return points.agg(
        F.min("lon").alias("min_lon"), F.min("lat").alias("min_lat"),
        F.max("lon").alias("max_lon"), F.max("lat").alias("max_lat"),
    )


# ---------------------------------------------------------------- upcoming stops


def match_trip_updates(vehicles: DataFrame, updates: DataFrame) -> DataFrame:
    """For each vehicle the first update in feed order with its vehicle id or its trip id.

    The feed is first cut to one update per vehicle id and one per trip id, so
    each lookup is an equi join on a unique key and no "or" join is needed.
    """
    u = "entity.trip_update."
    flat = updates.where(F.col("entity.trip_update").isNotNull()).select(
        "entity_index", F.coalesce(u + "vehicle.id", F.lit("")).alias("vehicle_id"),
        F.coalesce(u + "trip.trip_id", F.lit("")).alias("trip_id"),
        F.col(u + "stop_time_update").alias("stop_time_update"),
    )
    order = [F.col("entity_index").asc()]

    def first_by(key: str, prefix: str, rows: DataFrame) -> DataFrame:
        return first_per_key(rows, [key], order).select(
            key, F.col("entity_index").alias(f"{prefix}_index"), F.col("stop_time_update").alias(f"{prefix}_stops"))

    by_vehicle = first_by("vehicle_id", "v", flat)
    by_trip = first_by("trip_id", "t", flat.where(F.col("trip_id") != ""))
    both = vehicles.join(by_vehicle, "vehicle_id", "left").join(by_trip, "trip_id", "left")
    use_vehicle = F.col("v_index").isNotNull() & (
        F.col("t_index").isNull() | (F.col("v_index") <= F.col("t_index")))
    return both.select(
        *vehicles.columns,
        F.when(use_vehicle, F.col("v_stops")).otherwise(F.col("t_stops")).alias("stop_time_update"),
    )


def upcoming_stops(vehicles: DataFrame, updates: DataFrame, stops: DataFrame, as_of: Column | int,
                   n: int = UPCOMING_STOPS) -> DataFrame:
    """The next n stops of each vehicle, in feed order.

    A stop is ahead when its sequence passes the vehicle's; where either is
    unknown, when its time is not past or not known. The cut to n stops is made
    inside each vehicle's list, before rows are spread out.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    current = F.col("current_stop_sequence")

    def ahead(s: Column) -> Column:
        at = F.coalesce(F.nullif(s["arrival"]["time"], F.lit(0)), F.nullif(s["departure"]["time"], F.lit(0)))
        known = current.isNotNull() & s["stop_sequence"].isNotNull()
        return F.when(known, s["stop_sequence"] > current).otherwise(F.coalesce(at >= as_of, F.lit(True)))

    matched = match_trip_updates(vehicles.select("vehicle_id", "trip_id", "current_stop_sequence"), updates)
    next_stops = F.slice(F.filter("stop_time_update", ahead), 1, n)
    rows = matched.select("vehicle_id", "trip_id", F.posexplode(next_stops).alias("position", "s")).select(
        "vehicle_id", "trip_id", "position",
        F.col("s.stop_sequence").alias("stop_sequence"),
        F.coalesce("s.stop_id", F.lit("")).alias("stop_id"),
        iso_utc("s.arrival.time").alias("arrival_time"),
        iso_utc("s.departure.time").alias("departure_time"),
    )
    return rows.join(stop_names(stops), "stop_id", "left").select(
        "vehicle_id", "trip_id", "position", "stop_sequence", "stop_id",
        F.coalesce("stop_name", F.lit("")).alias("stop_name"), "arrival_time", "departure_time")


# ---------------------------------------------------------------- alerts


def is_active(periods: Column, as_of: Column) -> Column:
    """No periods means always active; a missing start or end leaves that side open."""
    covers = F.exists(periods, lambda p: (
        F.coalesce(p["start"] <= as_of, F.lit(True)) & F.coalesce(p["end"] >= as_of, F.lit(True))))
    return (F.coalesce(F.size(periods), F.lit(0)) <= 0) | covers


def live_alerts(entities: DataFrame, as_of: Column | int, route_id: str | None = None) -> DataFrame:
    """Alerts active now that touch a bus route, with rider texts and the routes in rider order."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    a = "entity.alert."
    return entities.where(
        F.col("entity.alert").isNotNull() & is_active(F.col(a + "active_period"), as_of) & touches_bus(a + "informed_entity", route_id)
    ).select(
        F.col("entity.id").alias("alert_id"),
        rider_text(a + "header_text").alias("header"), rider_text(a + "description_text").alias("description"),
        F.coalesce(a + "cause", F.lit("UNKNOWN_CAUSE")).alias("cause"),
        F.coalesce(a + "effect", F.lit("UNKNOWN_EFFECT")).alias("effect"),
        bus_routes_of(a + "informed_entity").alias("routes_affected"),
    )


def alerts_shown(alerts: DataFrame, order: Sequence[Column], n: int = ALERTS_SHOWN) -> DataFrame:
    """The first n alerts of a list."""
    return top_overall(alerts, order, n)


# ---------------------------------------------------------------- freshness and the recent layer


def feed_freshness(feeds: dict[str, DataFrame], as_of: Column | int) -> DataFrame:
    """Newest header stamp and its age, one row per feed."""
    reports = [
        df.agg(F.max("feed_timestamp").alias("stamp")).select(
            F.lit(name).alias("feed"), iso_utc("stamp").alias("feed_timestamp"),
            age_seconds("stamp", as_of).alias("feed_age_seconds"))
        for name, df in feeds.items()
    ]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def recent_rows(entities: DataFrame, as_of: Column | int, bus_only: bool = True) -> DataFrame:
    """Vehicle rows of the recent-snapshot layer, with a ``verdict`` of kept or why not.

    A vehicle without position is counted as such first; then the route is
    tested; then the coordinates.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    v = "entity.vehicle."
    text = F.lit("")
    verdict = F.when(F.col(v + "position").isNull(), "no_position")
    if bus_only:
        verdict = verdict.when(~is_bus_route(v + "trip.route_id", trim=True), "non_bus")
    verdict = verdict.when(
        F.col(v + "position.latitude").isNull() | F.col(v + "position.longitude").isNull(), "no_position"
    ).otherwise("kept")
    return entities.where(F.col("entity.vehicle").isNotNull()).select(
        iso_zulu(as_of).alias("snapshot_ts"), as_of.cast("bigint").alias("snapshot_unix"),
        F.nullif("feed_timestamp", F.lit(0)).alias("feed_timestamp"),
        age_seconds("feed_timestamp", as_of).alias("feed_age_seconds"),
        F.col("entity.id").alias("entity_id"),
        F.coalesce(v + "vehicle.id", "entity.id").alias("vehicle_id"),
        F.coalesce(v + "vehicle.label", text).alias("vehicle_label"),
        F.coalesce(v + "trip.route_id", text).alias("route_id"),
        F.coalesce(v + "trip.trip_id", text).alias("trip_id"),
        F.col(v + "trip.direction_id").alias("direction_id"),
        F.col(v + "position.latitude").cast("double").alias("latitude"),
        F.col(v + "position.longitude").cast("double").alias("longitude"),
        F.col(v + "position.bearing").cast("double").alias("bearing"),
        F.col(v + "position.speed").cast("double").alias("speed_mps"),
        F.col(v + "current_stop_sequence").alias("current_stop_sequence"),
        F.coalesce(v + "stop_id", text).alias("stop_id"),
        F.coalesce(v + "current_status", F.lit("NO_DATA")).alias("status"),
        F.nullif(F.col(v + "timestamp"), F.lit(0)).alias("vehicle_timestamp"),
        age_seconds(v + "timestamp", as_of).alias("vehicle_age_seconds"),
        verdict.alias("verdict"),
    )


def load_quality(rows: DataFrame) -> DataFrame:
    """Kept and skipped counts of ``recent_rows``, one row."""
    return rows.agg(
        F.max("feed_timestamp").alias("feed_timestamp"),
        F.count_if(F.col("verdict") == "kept").alias("row_count"),
        F.count_if(F.col("verdict") == "non_bus").alias("skipped_non_bus_count"),
        F.count_if(F.col("verdict") == "no_position").alias("skipped_no_position_count"),
    )
