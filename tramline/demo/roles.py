"""Transit roles played by the general test tables.

The test tables hold no transit rows, so each function renames and recomputes
columns of one table into a transit table: narrow projections, no sampling.
``demo/oracle.py`` states the same views in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.times import gtfs_clock, gtfs_seconds, seconds_since_midnight, wall_epoch
from tramline.schemas import RAW_ALERTS, RAW_TRIP_UPDATES, RAW_VEHICLE_POSITIONS, conform
from tramline.session import scratch_dir

c = F.col


def null() -> Column:
    return F.lit(None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table about to be turned into something costly per row.

    A small test file is one row group and would keep one task busy; it is
    spread over the cores. A table that already has a split per core is not moved.
    """
    rows = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table of the warehouse layers, built from the test tables once per application and kept as Parquet.

    Marts read dimensions and facts at rest, as in the nightly run, so that
    sizes are known when joins are planned and no layer is computed twice.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = scratch_dir(spark, name)
        build().write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


_DAYS: dict[tuple[str, str, str], tuple[date, date]] = {}


def _day_range(spark: SparkSession, sf_dir: str, name: str, of: str, days: Column, before: int, after: int) -> tuple[date, date]:
    """First and last day of a table, widened; read once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, f"{of} of {name}")
    if key not in _DAYS:
        row = table(spark, sf_dir, name).agg(F.date_sub(F.min(days), before).alias("first"), F.date_add(F.max(days), after).alias("last")).first()
        _DAYS[key] = (row["first"], row["last"]) if row["first"] else (date(1970, 1, 1), date(1970, 1, 1))
    return _DAYS[key]


def event_days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """Days of vehicle positions; trips begin up to three days before."""
    return _day_range(spark, sf_dir, "events", "positions", F.to_date("ts"), 3, 0)


def trip_days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """Days of trips; a service runs up to three days before and after its own day."""
    first, last = _day_range(spark, sf_dir, "orders", "trips", start_day(c("o_orderkey")), 3, 3)
    other = _day_range(spark, sf_dir, "lineitem", "trips", start_day(c("l_orderkey")), 3, 3)
    return min(first, other[0]), max(last, other[1])


def alert_days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """Days of alerts; the last ones are followed for sixty days."""
    return _day_range(spark, sf_dir, "lineitem", "alerts", F.to_date("l_shipdate"), 0, 60)


def text(column: Column) -> Column:
    return column.cast("string")


def plus_seconds(ts: Column, seconds: Column) -> Column:
    zero = F.lit(0)
    return ts + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def bus_id(n: Column) -> Column:
    """Route ids of every kind: rail, silver line, crosstown, commuter, boat, blank, missing, numbers."""
    odd = F.array(*[F.lit(x) for x in ("Red", "SL1", "CT2", "CR-3", "Boat-4", "")])
    return F.when(n < 6, F.get(odd, n.cast("int"))).when(n == 6, null()).otherwise(text(n))


# ---------------------------------------------------------------- schedule versions and dimensions


def event_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly versions over the event days."""
    def build():
        days = table(spark, sf_dir, "events").select(F.trunc(F.to_date("ts"), "week").alias("feed_start_date"))
        return days.distinct().coalesce(1)

    return stored(spark, sf_dir, "event_versions", build)


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly versions over the order days."""
    def build():
        days = table(spark, sf_dir, "orders").select(F.trunc(F.to_date("o_orderdate"), "quarter").alias("feed_start_date"))
        return days.distinct().coalesce(1)

    return stored(spark, sf_dir, "order_versions", build)


def each_version(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """Every row once per version."""
    starts = versions.agg(F.sort_array(F.collect_set("feed_start_date"))).scalar()
    return rows.select(F.explode(starts).alias("feed_start_date"), "*")


def event_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "event_routes", lambda: routes(spark, sf_dir, event_versions(spark, sf_dir)))


def order_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "order_routes", lambda: routes(spark, sf_dir, order_versions(spark, sf_dir)))


def routes(spark: SparkSession, sf_dir: str, versions: DataFrame) -> DataFrame:
    key = c("n_nationkey")
    rows = table(spark, sf_dir, "nation").select(
        text(key).alias("route_id"),
        F.when(key % 3 == 0, c("n_name")).otherwise(text(100 - key)).alias("route_short_name"),
        c("n_regionkey").alias("route_type"),
    )
    return each_version(rows, versions)


def stops_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """400 stops; several of them share a name."""
    return stored(spark, sf_dir, "stops_once", lambda: _stops(spark, sf_dir))


def _stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = c("p_partkey") % 400
    return (
        table(spark, sf_dir, "part").groupBy(number.alias("n"))
        .agg(F.min("p_retailprice").alias("price"), F.min("p_size").alias("size"))
        .select(
            F.concat(F.lit("S"), text(c("n"))).alias("stop_id"),
            F.concat(F.lit("Stop "), text(c("n") % 150)).alias("stop_name"),
            (c("price") / 10000.0 + 42.0).alias("stop_lat"), (-71.0 - c("size") / 100.0).alias("stop_lon"),
        )
    )


def order_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "order_stops",
                  lambda: each_version(stops_once(spark, sf_dir), order_versions(spark, sf_dir)))


# ---------------------------------------------------------------- vehicle positions (events)


def raw_vehicle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, user, day, hour = c("event_id"), c("user_id"), F.to_date("ts"), F.hour("ts")
    k = F.get_json_object("props", "$.k").cast("int")
    failed = c("event_type") == "error"
    started = (
        F.when(event % 17 == 0, F.date_sub(day, 3))
        .when((hour <= 5) & (event % 4 < 2), F.date_sub(day, 1)).otherwise(day)
    )
    status = (
        F.when(failed, null())
        .when(c("value") > 200, "FULL")
        .when(c("event_type") == "view", "EMPTY").when(c("event_type") == "click", "MANY_SEATS_AVAILABLE")
        .when(c("event_type") == "purchase", "FEW_SEATS_AVAILABLE")
        .when(c("value") > 100, "CRUSHED_STANDING_ROOM_ONLY").otherwise("STANDING_ROOM_ONLY")
    )
    stop = k % 10
    rows = wide_table(spark, sf_dir, "events").select(
        day.alias("service_date"), hour.alias("hour"),
        F.date_trunc("minute", "ts").alias("snapshot_timestamp"), c("ts").alias("ingested_at"),
        F.lit("2.0").alias("gtfs_realtime_version"), text(event).alias("entity_id"),
        F.when(event % 50 == 0, True).when(event % 3 != 0, False).alias("is_deleted"),
        text(user).alias("trip_id"), text(user % 25).alias("route_id"),
        F.when(user % 3 < 2, user % 3).alias("direction_id"), started.alias("trip_start_date"),
        F.lit("SCHEDULED").alias("trip_schedule_rel"),
        F.concat(F.lit("v"), text(user)).alias("vehicle_id"),
        (event % 1000 / 10000.0 + 42.0).alias("latitude"), (-71.0 - user % 1000 / 10000.0).alias("longitude"),
        F.when(~failed, c("value") / 10.0).alias("speed"),
        F.when(k != 99, stop).alias("current_stop_sequence"),
        F.concat(F.lit("S"), text(stop)).alias("stop_id"),
        F.when(event % 2 == 0, "STOPPED_AT").when(event % 3 == 0, "IN_TRANSIT_TO").otherwise("INCOMING_AT")
        .alias("current_status"),
        status.alias("occupancy_status"),
        F.when(~failed, F.least(F.floor("value"), F.lit(100))).alias("occupancy_percentage"),
        F.date_trunc("second", "ts").alias("position_timestamp"),
    )
    return conform(rows, RAW_VEHICLE_POSITIONS)


def event_stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schedule near what happened: per version week, trip and stop the earliest time seen, shifted."""
    return stored(spark, sf_dir, "event_stop_times", lambda: _event_stop_times(spark, sf_dir))


def _event_stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = (c("trip_id").cast("bigint") % 7) * 100 - 300
    planned = (
        raw_vehicle_positions(spark, sf_dir).where(c("current_stop_sequence").isNotNull())
        .groupBy(F.trunc("trip_start_date", "week").alias("feed_start_date"), "trip_id",
                 c("current_stop_sequence").alias("stop_sequence"))
        .agg(F.min(seconds_since_midnight("position_timestamp", "trip_start_date")).alias("seen"))
        .withColumn("arrival_time", gtfs_clock(F.greatest(c("seen") + shift, F.lit(0))))
    )
    return planned.select("feed_start_date", "trip_id", "stop_sequence", "arrival_time",
                          gtfs_seconds("arrival_time").alias("arrival_seconds"))


# ---------------------------------------------------------------- trips and trip updates (orders, lineitem)


def start_day(key: Column) -> Column:
    return F.date_add(F.lit("1996-01-01").cast("date"), (key % 730).cast("int"))


def version_of(day: Column) -> Column:
    return F.trunc(day, "quarter")


def raw_trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, line = c("l_orderkey"), c("l_linenumber")
    day = start_day(order)
    service = F.date_add(day, line % 4 - 1)
    second = (c("l_partkey") * 7 + c("l_suppkey") * 11) % 86400
    snapshot = plus_seconds(service.cast("timestamp_ntz"), second)
    relation = (
        F.when(c("l_returnflag") == "R", "CANCELED").when(c("l_returnflag") == "A", "ADDED")
        .when(line % 2 == 0, " ")
    )
    rows = wide_table(spark, sf_dir, "lineitem").select(
        service.alias("service_date"), F.floor(second / 3600).alias("hour"), snapshot.alias("snapshot_timestamp"),
        plus_seconds(snapshot, c("l_suppkey") % 1000).alias("ingested_at"),
        F.lit("2.0").alias("gtfs_realtime_version"),
        F.concat_ws("-", c("l_partkey"), c("l_suppkey"), line, c("l_quantity").cast("int")).alias("entity_id"),
        F.when(c("l_tax") == 0.08, True).when(c("l_discount") != 0, False).alias("is_deleted"),
        text(order).alias("trip_id"), text(order % 25).alias("route_id"),
        F.when(order % 3 < 2, order % 3).alias("direction_id"), day.alias("trip_start_date"),
        relation.alias("trip_schedule_rel"), snapshot.alias("trip_update_timestamp"),
        c("l_quantity").cast("int").alias("delay"),
    )
    return conform(rows, RAW_TRIP_UPDATES)


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = c("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        version_of(start_day(order)).alias("feed_start_date"), text(order).alias("trip_id"),
        text(order % 25).alias("route_id"), F.when(order % 3 < 2, order % 3).cast("int").alias("direction_id"),
        text(order % 3650).alias("service_id"),
    )


def _services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select((c("o_orderkey") % 3650).alias("s")).distinct().withColumn(
        "day", start_day(c("s")))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = c("s")
    return _services(spark, sf_dir).select(
        version_of(c("day")).alias("feed_start_date"), text(s).alias("service_id"),
        (s % 2 == 0).alias("monday"), (s % 3 != 0).alias("tuesday"), (s % 5 != 1).alias("wednesday"),
        F.lit(True).alias("thursday"), (s % 7 < 4).alias("friday"), (s % 3 == 1).alias("saturday"),
        (s % 4 == 0).alias("sunday"),
        F.date_sub("day", 3).alias("start_date"), F.date_add("day", 3).alias("end_date"),
    )


def calendar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed on their day: every 6th service; added: two of five, one of them two days later."""
    s = c("s")
    entries = F.filter(F.array(
        F.when(s % 6 == 0, F.struct(c("day").alias("date"), F.lit(2).alias("exception_type"))),
        F.when(s % 5 == 1, F.struct(c("day").alias("date"), F.lit(1).alias("exception_type"))),
        F.when(s % 5 == 2, F.struct(F.date_add("day", 2).alias("date"), F.lit(1).alias("exception_type"))),
    ), lambda e: e.isNotNull())
    return _services(spark, sf_dir).select(
        version_of(c("day")).alias("feed_start_date"), text(s).alias("service_id"), F.inline(entries))


def order_stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    clock = gtfs_clock((c("l_suppkey") % 27) * 3600 + (c("l_partkey") % 60) * 60)
    return wide_table(spark, sf_dir, "lineitem").select(
        version_of(start_day(c("l_orderkey"))).alias("feed_start_date"), text(c("l_orderkey")).alias("trip_id"),
        c("l_linenumber").alias("stop_sequence"), F.when(c("l_discount") != 0, clock).alias("departure_time"),
    )


# ---------------------------------------------------------------- alerts (lineitem)


def _translations(*pairs: tuple[Column, Column]) -> Column:
    if not pairs:
        empty = "ARRAY<STRUCT<text: STRING, language: STRING>>"
        return F.struct(F.array().cast(empty).alias("translation"))
    return F.struct(F.array(*[F.struct(t.alias("text"), lang.alias("language")) for t, lang in pairs])
                    .alias("translation"))


def alert_periods() -> Column:
    kind = "STRUCT<start: BIGINT, end: BIGINT>"
    start = wall_epoch("l_shipdate") + (c("l_suppkey") % 1000) * 97
    long = c("l_quantity").cast("bigint")
    end = F.when(~((long == 50) & (c("l_linestatus") == "O")), start + long * 43200 + c("l_partkey") % 3600)
    later = start + 40 * 86400
    first = F.struct(start.alias("start"), end.alias("end")).cast(kind)
    second = F.struct(later.alias("start"), (later + 5 * 86400 + c("l_partkey") % 100).alias("end")).cast(kind)
    return (
        F.when(c("l_tax") == 0, F.array().cast(f"ARRAY<{kind}>"))
        .when(c("l_quantity") > 25, F.array(first, second)).otherwise(F.array(first))
    )


def alert_entities(route: "callable") -> Column:
    """Two routes with stops (the first sometimes without) and a whole agency; ``route`` makes the ids."""
    def entity(agency, key, stop, direction):
        return F.struct(
            agency.cast("string").alias("agency_id"),
            (route(key) if key is not None else null()).cast("string").alias("route_id"),
            (key % 5 if key is not None else null()).cast("int").alias("route_type"),
            null().cast("STRUCT<trip_id: STRING, start_time: STRING, start_date: STRING, "
                      "schedule_relationship: STRING, route_id: STRING, direction_id: INT, "
                      "modified_trip: STRUCT<modifications_id: STRING, affected_trip_id: STRING, "
                      "start_time: STRING, start_date: STRING>>").alias("trip"),
            stop.cast("string").alias("stop_id"), direction.cast("int").alias("direction_id"),
        )

    stop_1 = F.when(c("l_discount") != 0.1, F.concat(F.lit("S"), text(c("l_partkey") % 400)))
    stop_2 = F.concat(F.lit("S"), text(c("l_suppkey") % 400))
    return F.array(
        entity(F.lit("1"), c("l_suppkey") % 25, stop_1, c("l_linenumber") % 2),
        entity(F.lit("1"), c("l_partkey") % 25, stop_2, null()),
        entity(F.lit("1"), None, null(), null()),
    )


def alert_payload(route: "callable") -> dict[str, Column]:
    line, part = c("l_linenumber"), text(c("l_partkey"))
    header = (
        F.when(line % 4 == 0, _translations((F.concat(F.lit("Aviso "), part), F.lit("es")),
                                            (F.concat(F.lit("Alert "), part), F.lit("en"))))
        .when(line % 4 == 1, _translations((F.concat(F.lit("Aviso "), part), F.lit("es"))))
        .when(line % 4 == 2, _translations())
        .otherwise(_translations((F.concat(F.lit("Plain "), part), null().cast("string"))))
    )
    description = F.when(line % 3 != 0, _translations((F.concat(F.lit("Text "), part), F.lit("EN-us"))))
    return {
        "active_period": alert_periods(),
        "informed_entity": alert_entities(route),
        "cause": F.when(line % 3 == 0, "MAINTENANCE").when(line % 3 == 1, "CONSTRUCTION").otherwise("ACCIDENT"),
        "effect": F.when(line % 2 == 0, "DETOUR").otherwise("SIGNIFICANT_DELAYS"),
        "url": _translations((F.concat(F.lit("https://example.org/"), part), F.lit("en"))),
        "header_text": header,
        "description_text": description,
        "severity_level": F.when(c("l_returnflag") == "R", "SEVERE").when(c("l_returnflag") == "A", "WARNING")
        .otherwise("INFO"),
    }


def raw_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line is one snapshot of the alert named by its order."""
    return raw_alerts_of(wide_table(spark, sf_dir, "lineitem"))


def raw_alerts_of(lines: DataFrame, entity_id: Column | None = None) -> DataFrame:
    hour = c("l_partkey") % 24
    snapshot = plus_seconds(c("l_shipdate"), hour * 3600 + (c("l_suppkey") % 60) * 60)
    rows = lines.select(
        F.to_date("l_shipdate").alias("service_date"), hour.alias("hour"), snapshot.alias("snapshot_timestamp"),
        plus_seconds(snapshot, F.lit(3600)).alias("ingested_at"), F.lit("2.0").alias("gtfs_realtime_version"),
        (text(c("l_orderkey")) if entity_id is None else entity_id).alias("entity_id"),
        F.when(c("l_tax") == 0.08, True).when(c("l_tax") != 0.07, False).alias("is_deleted"),
        *[v.alias(k) for k, v in alert_payload(text).items()],
    )
    return conform(rows, RAW_ALERTS)


# ---------------------------------------------------------------- live entities


def vehicle_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded vehicle entities, one per event; the entity id repeats per user."""
    event, user = c("event_id"), c("user_id")
    k = F.get_json_object("props", "$.k").cast("int")
    direction = F.when(user % 3 < 2, user % 3).cast("int")
    trip = F.struct(text(user).alias("trip_id"), bus_id(user % 25).alias("route_id"), direction.alias("direction_id"))
    position = F.struct(
        F.when(event % 97 != 0, event % 1000 / 10000.0 + 42.0).alias("latitude"),
        (-71.0 - user % 1000 / 10000.0).alias("longitude"), (event % 360).cast("double").alias("bearing"),
        F.when(event % 5 != 0, F.floor("value") / 10.0).alias("speed"),
    )
    descriptor = F.struct(
        F.when(event % 43 != 0, F.concat(F.lit("v"), text(user))).alias("id"), text(user).alias("label"))
    vehicle = F.struct(
        trip.alias("trip"), F.when(event % 53 != 0, position).alias("position"),
        F.when(k != 99, k % 10).alias("current_stop_sequence"),
        F.when(event % 2 == 0, "STOPPED_AT").when(event % 3 == 0, "INCOMING_AT").alias("current_status"),
        F.when(event % 59 != 0, wall_epoch("ts")).otherwise(F.lit(0)).alias("timestamp"),
        F.when(k != 50, F.concat(F.lit("S"), text(k % 10))).alias("stop_id"),
        F.when(event % 41 != 0, descriptor).alias("vehicle"),
    )
    entity = F.struct(F.concat(F.lit("e"), text(user)).alias("id"), vehicle.alias("vehicle"))
    return wide_table(spark, sf_dir, "events").select(
        event, (wall_epoch("ts") + 5).alias("feed_timestamp"), entity.alias("entity"))


def live_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, cust = c("o_orderkey"), c("o_custkey")
    return table(spark, sf_dir, "orders").select(
        text(order).alias("trip_id"), bus_id(cust % 25).alias("route_id"), text(cust % 2).alias("direction_id"),
        F.when(order % 10 != 0, F.concat(F.lit("sh"), text(cust))).otherwise("").alias("shape_id"),
        F.when(order % 4 != 0, F.concat(F.lit("To "), c("o_orderpriority"))).otherwise("").alias("trip_headsign"),
    )


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("sh"), text(c("l_partkey"))).alias("shape_id"), c("l_orderkey").cast("int").alias("seq"),
        (c("l_extendedprice") / 1000.0).alias("lat"), (c("l_quantity") * -1.0).alias("lon"),
    )


def order_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = c("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("v"), text(order)).alias("vehicle_id"),
        F.when(order % 5 != 0, text(order)).otherwise("").alias("trip_id"),
        F.when(order % 7 != 0, order % 12).cast("int").alias("current_stop_sequence"),
    )


def trip_update_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip-update entities, one per line, each with 3 to 9 stops; feed order by the line's keys."""
    base = wall_epoch("l_shipdate")

    def stop(number: int) -> Column:
        i = F.lit(number)
        return F.struct(
            F.when((i + c("l_partkey")) % 11 != 0, i).cast("int").alias("stop_sequence"),
            F.struct(F.when(i % 4 != 0, base + i * 60).otherwise(F.lit(0)).alias("time")).alias("arrival"),
            F.struct((base + i * 60 + 20).alias("time")).alias("departure"),
            F.concat(F.lit("S"), text((c("l_suppkey") + i) % 400)).alias("stop_id"),
        )

    update = F.struct(
        F.struct(text(c("l_orderkey")).alias("trip_id")).alias("trip"),
        F.slice(F.array(*[stop(i) for i in range(1, 10)]), F.lit(1), c("l_linenumber") + 2).alias("stop_time_update"),
        F.when(c("l_partkey") % 3 == 0, F.struct(F.concat(F.lit("v"), text(c("l_orderkey"))).alias("id")))
        .alias("vehicle"),
    )
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return wide_table(spark, sf_dir, "lineitem").select(
        base.alias("feed_timestamp"), order.alias("entity_index"),
        F.struct(text(c("l_orderkey")).alias("id"), update.alias("trip_update")).alias("entity"))


def alert_entity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert entities, one per line, with route ids of every kind."""
    alert = F.struct(*[v.alias(k) for k, v in alert_payload(bus_id).items()])
    key = F.concat_ws("-", c("l_orderkey"), c("l_linenumber"), c("l_partkey"), c("l_suppkey"))
    return wide_table(spark, sf_dir, "lineitem").select(
        wall_epoch("l_shipdate").alias("feed_timestamp"), F.struct(key.alias("id"), alert.alias("alert")).alias("entity"))
