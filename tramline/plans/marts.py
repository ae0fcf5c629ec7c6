"""Facts and schedule dimensions to daily metrics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.rates import count_share_pct, is_on_time, pct
from tramline.functions.text import schedule_relation
from tramline.functions.times import seconds_since_midnight
from tramline.operators.joins import join_hot, left_join_null_safe
from tramline.operators.latest import first_per_key
from tramline.operators.versions import join_version, link_version, version_on
from tramline.schemas import (
    METRIC_OCCUPANCY_ROUTE_HOUR, METRIC_ON_TIME, METRIC_SERVICE_DELIVERED, columns_of,
)

BUS = 3

# Occupancy status -> mart column of its share.
OCCUPANCY_SHARES = {
    "pct_empty": "EMPTY",
    "pct_many_seats": "MANY_SEATS_AVAILABLE",
    "pct_few_seats": "FEW_SEATS_AVAILABLE",
    "pct_standing_room": "STANDING_ROOM_ONLY",
    "pct_crushed_standing": "CRUSHED_STANDING_ROOM_ONLY",
    "pct_full": "FULL",
}
SEVERITIES = {"severe_count": "SEVERE", "warning_count": "WARNING", "info_count": "INFO"}
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def _between(column: str, first: date | None, last: date | None) -> Column:
    keep = F.lit(True)
    if first is not None:
        keep = keep & (F.col(column) >= F.lit(first))
    if last is not None:
        keep = keep & (F.col(column) <= F.lit(last))
    return keep


# ---------------------------------------------------------------- on-time performance


def stop_arrivals(positions: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Earliest stopped position per (trip day, trip, stop): the actual arrival.

    The first stop of a trip is left out here rather than after the joins: the
    sequence is part of the key, so whole groups go and the picks stay the same.
    """
    stopped = positions.where(
        _between("trip_start_date", first, last)
        & (F.col("current_status") == "STOPPED_AT") & (F.col("current_stop_sequence") != 1)
    ).select(
        "service_date", "trip_start_date", "hour", "trip_id", "route_id", "direction_id", "stop_id",
        F.col("current_stop_sequence").alias("stop_sequence"),
        F.col("position_timestamp").alias("actual_arrival_ts"),
        "occupancy_status", "occupancy_percentage", "static_version_date", "entity_id",
    )
    arrivals = first_per_key(stopped, ["trip_start_date", "trip_id", "stop_sequence"], [
        F.col("actual_arrival_ts").asc_nulls_last(), F.col("entity_id").asc(),
    ])
    return arrivals.drop("entity_id").withColumn(
        "actual_arrival_seconds", seconds_since_midnight("actual_arrival_ts", "trip_start_date"))


def mart_on_time(positions: DataFrame, stop_times: DataFrame, routes: DataFrame,
                 first: date | None = None, last: date | None = None) -> DataFrame:
    """Bus stop events with scheduled time, delay and on-time flag.

    Of the schedules only the versions between the oldest and the newest one of the range's positions are read.
    """
    named = positions.where(_between("trip_start_date", first, last)).agg(
        F.min("static_version_date").alias("oldest"), F.max("static_version_date").alias("newest"))
    in_force = F.col("feed_start_date").between(named.select("oldest").scalar(), named.select("newest").scalar())
    routes, stop_times = routes.where(in_force), stop_times.where(in_force)
    buses = routes.where(F.col("route_type") == BUS).withColumnRenamed("route_short_name", "route_name")
    events = join_version(stop_arrivals(positions, first, last), buses, ["route_id"], ["route_name", "route_type"])
    schedule = stop_times.select(
        "feed_start_date", "trip_id", "stop_sequence",
        F.col("arrival_time").alias("scheduled_arrival_time"),
        F.col("arrival_seconds").alias("scheduled_arrival_seconds"),
    )
    delay = F.col("actual_arrival_seconds") - F.col("scheduled_arrival_seconds")
    return (
        join_version(events, schedule, ["trip_id", "stop_sequence"],
                     ["scheduled_arrival_time", "scheduled_arrival_seconds"])
        .withColumn("arrival_delay_seconds", delay)
        .withColumn("is_on_time", is_on_time(F.col("arrival_delay_seconds")))
        .select(*columns_of(METRIC_ON_TIME))
    )


# ---------------------------------------------------------------- occupancy


def mart_occupancy_route_hour(positions: DataFrame, routes: DataFrame,
                              first: date | None = None, last: date | None = None) -> DataFrame:
    """Occupancy of bus snapshots by service date, hour and route.

    Snapshots are counted per version first; the route table then meets these
    few counts instead of every snapshot. A snapshot's day is its trip's day or the next, so the
    trip day, by which facts are stored, bounds the scan.
    """
    before = first - timedelta(days=1) if first else None
    counts = {name: F.count_if(F.col("occupancy_status") == status) for name, status in OCCUPANCY_SHARES.items()}
    counts["pct_no_data_occupancy"] = F.count_if(F.col("occupancy_status").isNull())
    partial = (
        positions.where(_between("trip_start_date", before, last) & _between("service_date", first, last) & (F.col("current_stop_sequence") != 1))
        .groupBy("service_date", "hour", "route_id", "static_version_date")
        .agg(
            F.count("*").alias("snapshot_count"),
            F.sum("occupancy_percentage").alias("pct_sum"),
            F.count("occupancy_percentage").alias("pct_snapshots_reporting"),
            *[c.alias(name) for name, c in counts.items()],
        )
    )
    buses = routes.where(F.col("route_type") == BUS).withColumnRenamed("route_short_name", "route_name")
    summed = ["snapshot_count", "pct_sum", "pct_snapshots_reporting", *counts]
    totals = (
        join_version(partial, buses, ["route_id"], ["route_name"])
        .groupBy("service_date", "hour", "route_id")
        .agg(F.max("route_name").alias("route_name"), *[F.sum(c).alias(c) for c in summed])
    )
    shares = {c: count_share_pct(F.col(c), F.col("snapshot_count")) for c in ("pct_snapshots_reporting", *counts)}
    mean = F.col("pct_sum").cast("double") / F.nullif(F.col("pct_snapshots_reporting"), F.lit(0))
    return totals.withColumns({"avg_occupancy_pct": mean, **shares}).select(
        *columns_of(METRIC_OCCUPANCY_ROUTE_HOUR))


# ---------------------------------------------------------------- alerts


def alert_segments(periods: DataFrame, first: date, last: date) -> DataFrame:
    """Stretches of days on which an alert has the same number of active periods.

    (entity_id, from_day, to_day, period_count), cut to the range and disjoint
    within an alert. Open-ended periods run to the end of the range. Starts and
    ends are summed per alert and day first, so the running count of an alert
    sees at most one row per calendar day, however many periods it has.
    """
    start = F.greatest(F.to_date("active_start"), F.lit(first))
    end = F.least(F.coalesce(F.to_date("active_end"), F.lit(last)), F.lit(last))
    cut = periods.where(F.to_date("active_start") <= F.lit(last)).select(
        "entity_id", start.alias("from_day"), end.alias("to_day")
    ).where(F.col("from_day") <= F.col("to_day"))
    steps = cut.select("entity_id", F.inline(F.array(
        F.struct(F.col("from_day").alias("day"), F.lit(1).alias("step")),
        F.struct(F.date_add("to_day", 1).alias("day"), F.lit(-1).alias("step")),
    ))).groupBy("entity_id", "day").agg(F.sum("step").alias("step")).where(F.col("step") != 0)
    by_day = Window.partitionBy("entity_id").orderBy("day")
    return steps.select(
        "entity_id", F.col("day").alias("from_day"), F.date_sub(F.lead("day").over(by_day), 1).alias("to_day"),
        F.sum("step").over(by_day).alias("period_count"),
    ).where(F.col("period_count") > 0)


def _each_day(segments: DataFrame) -> DataFrame:
    return segments.withColumn("alert_date", F.explode(F.sequence("from_day", "to_day"))).drop("from_day", "to_day")


def alert_days(periods: DataFrame, first: date, last: date) -> DataFrame:
    """Active days of each alert within the range: (entity_id, alert_date, period_count)."""
    return _each_day(alert_segments(periods, first, last)).select("entity_id", "alert_date", "period_count")


def _severities() -> dict[str, Column]:
    """What one alert adds to each count."""
    return {"alert_count": F.lit(1), **{n: (F.col("severity_level").eqNullSafe(F.lit(level))).cast("int") for n, level in SEVERITIES.items()}}


def _in_range(alert_routes: DataFrame, periods: DataFrame, first: date, last: date) -> DataFrame:
    """Bus rows of alerts that have a period in the range; the others leave before anything is joined."""
    active = periods.where((F.to_date("active_start") <= F.lit(last)) & (F.coalesce(F.to_date("active_end"), F.lit(last)) >= F.lit(first)))
    return alert_routes.where(F.col("route_type") == BUS).join(active.select("entity_id"), "entity_id", "left_semi")


def _day_totals(stretches: DataFrame, group: Sequence[str], adds: dict[str, Column], last: date) -> DataFrame:
    """Sums of ``adds`` over the stretches that cover each day: (alert_date, group, sums) of days with an alert.

    A stretch adds its values on its first day and takes them back after its last one. These steps are summed per
    group and day, a running sum over the few days on which a group changes gives its totals, and only those are
    spread over the days they hold for.
    """
    names = list(adds)
    on, off = ([(sign * F.col(n)).alias(n) for n in names] for sign in (1, -1))
    steps = stretches.withColumns(adds).select(*group, F.inline(F.array(
        F.struct(F.col("from_day").alias("day"), *on), F.struct(F.date_add("to_day", 1).alias("day"), *off)))).where(
        F.col("day") <= F.lit(last)).groupBy(*group, "day").agg(*[F.sum(n).alias(n) for n in names])
    by_day = Window.partitionBy(*group).orderBy("day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.date_sub(F.lead("day").over(by_day), 1), F.lit(last))
    totals = steps.select(*group, "day", until.alias("until"), *[F.sum(n).over(so_far).alias(n) for n in names])
    return totals.where(F.col("alert_count") > 0).select(F.explode(F.sequence("day", "until")).alias("alert_date"), *group, *names)


def mart_alerts_by_day(periods: DataFrame, alert_routes: DataFrame, alerts: DataFrame, routes: DataFrame,
                       first: date, last: date) -> DataFrame:
    """Distinct alerts active per day and bus route, in all and by severity.

    One side is reduced to distinct (alert, route) rows, the other to disjoint
    stretches of days, so each joined row is one distinct alert on each of its days.
    """
    touched = _in_range(alert_routes, periods, first, last).select("entity_id", "route_id").distinct()
    named = routes.withColumnRenamed("route_short_name", "route_name")
    states = alerts.select("entity_id", "severity_level", "static_version_date")
    affected = join_version(touched.join(states, "entity_id"), named, ["route_id"], ["route_name"])
    affected = affected.select("entity_id", "severity_level", "route_id", "route_name")
    active = alert_segments(periods, first, last).drop("period_count")
    joined = join_hot(affected, active, ["entity_id"], counted=alert_routes.select("entity_id"))
    return _day_totals(joined, ["route_id", "route_name"], _severities(), last)


def mart_alerts_by_day_stops(periods: DataFrame, alert_routes: DataFrame, alerts: DataFrame, stops: DataFrame,
                             first: date, last: date) -> DataFrame:
    """Distinct alerts active per day and stop name, with the mean place of the stops.

    The mean runs over every (period, route, stop) combination of an alert, as
    in the joined rows it is defined on; the combinations are counted before
    the join and used as weights instead of being produced. Places are summed as decimals, so
    that what a stretch takes back is exactly what it added.
    """
    touched = _in_range(alert_routes, periods, first, last).groupBy("entity_id", "stop_id").agg(F.count("*").alias("row_count"))
    states = alerts.select("entity_id", "severity_level", "static_version_date")
    placed = join_version(touched.join(states, "entity_id"), stops, ["stop_id"], ["stop_name", "stop_lat", "stop_lon"]).withColumns(
        {x: F.col(x).try_cast("decimal(18,13)") for x in ("stop_lat", "stop_lon")})

    def weighted(place: str) -> Column:
        return F.sum(F.coalesce(F.col(place) * F.col("row_count").cast("decimal(9,0)"), F.lit(0)))

    def weight(place: str) -> Column:
        return F.sum(F.when(F.col(place).isNotNull(), F.col("row_count")).otherwise(0))

    by_name = placed.groupBy("entity_id", "severity_level", "stop_name").agg(
        weighted("stop_lat").alias("lat_sum"), weight("stop_lat").alias("lat_n"),
        weighted("stop_lon").alias("lon_sum"), weight("stop_lon").alias("lon_n"),
    )
    joined = join_hot(by_name, alert_segments(periods, first, last), ["entity_id"],
                      counted=alert_routes.select("entity_id"))
    sums = {n: (F.col(n) * F.col("period_count").cast("decimal(9,0)")).cast("decimal(35,13)") if n.endswith("sum") else F.col(n) * F.col("period_count")
            for n in ("lat_sum", "lat_n", "lon_sum", "lon_n")}
    totals = _day_totals(joined, ["stop_name"], sums | _severities(), last)

    def mean(place: str) -> Column:
        return F.col(f"{place}_sum").cast("double") / F.nullif(F.col(f"{place}_n"), F.lit(0))

    return totals.select("alert_date", "stop_name", mean("lat").alias("stop_lat"), mean("lon").alias("stop_lon"), "alert_count", *SEVERITIES)


# ---------------------------------------------------------------- service delivered


def active_services(calendar: DataFrame, calendar_dates: DataFrame, versions: DataFrame,
                    first: date, last: date) -> DataFrame:
    """Services that run on each day: (day, static_version_date, service_id).

    Weekly services plus added days, minus removed days, all under the version
    in force on the day.
    """
    runs_on = F.element_at(F.array(*WEEKDAYS), F.weekday("day") + 1)
    days = F.sequence(F.greatest("start_date", F.lit(first)), F.least("end_date", F.lit(last)))
    weekly = (
        calendar.where(F.greatest("start_date", F.lit(first)) <= F.least("end_date", F.lit(last)))
        .select("feed_start_date", "service_id", *WEEKDAYS, F.explode(days).alias("day"))
        .where(runs_on)
        .select("feed_start_date", "service_id", "day")
    )
    exceptions = calendar_dates.where(F.col("date").between(F.lit(first), F.lit(last)))

    def on_exception(kind: int) -> DataFrame:
        return exceptions.where(F.col("exception_type") == kind).select(
            "feed_start_date", "service_id", F.col("date").alias("day"))

    running = (
        weekly.unionByName(on_exception(1)).distinct()
        .join(on_exception(2), ["feed_start_date", "service_id", "day"], "left_anti")
    )
    linked = link_version(running, versions, "day")
    return linked.where(F.col("feed_start_date") == F.col("static_version_date")).select(
        "day", "static_version_date", "service_id")


def first_departures(stop_times: DataFrame) -> DataFrame:
    """Departure at the first stop that has one, per version and trip."""
    timed = stop_times.where(F.col("departure_time").isNotNull()).select(
        "feed_start_date", "trip_id", "stop_sequence", "departure_time")
    return first_per_key(timed, ["feed_start_date", "trip_id"],
                         [F.col("stop_sequence").asc_nulls_last(), F.col("departure_time").asc()])


def scheduled_trips(trips: DataFrame, routes: DataFrame, stop_times: DataFrame, services: DataFrame) -> DataFrame:
    """Bus trips planned for each day whose first departure is before 24:00.

    The days of a service (at most those of the calendar) travel through the
    join as one array and are spread after it.
    """
    same_day = first_departures(stop_times).where(
        F.split_part("departure_time", F.lit(":"), F.lit(1)).try_cast("int") < 24
    ).select(F.col("feed_start_date").alias("static_version_date"), "trip_id")
    buses = routes.where(F.col("route_type") == BUS).withColumnRenamed("route_short_name", "route_name")
    planned = trips.select(
        F.col("feed_start_date").alias("static_version_date"), "trip_id", "route_id", "direction_id", "service_id")
    planned = join_version(planned, buses, ["route_id"], ["route_name"])
    planned = planned.join(same_day, ["static_version_date", "trip_id"], "left_semi")
    keys = trips.select(F.col("feed_start_date").alias("static_version_date"), "service_id")
    runs = services.groupBy("static_version_date", "service_id").agg(F.collect_set("day").alias("days"))
    return join_hot(planned, runs, ["static_version_date", "service_id"], counted=keys).select(
        F.explode("days").alias("trip_start_date"), "static_version_date", "trip_id", "route_id", "route_name",
        "direction_id")


def trip_delivery(scheduled: DataFrame, trip_updates: DataFrame, first: date, last: date) -> DataFrame:
    """Each scheduled trip with what became of it."""
    final = trip_updates.where(_between("trip_start_date", first, last)).select(
        "trip_start_date", "static_version_date", "trip_id",
        schedule_relation("trip_schedule_rel").alias("relation"))
    joined = scheduled.join(final, ["trip_start_date", "static_version_date", "trip_id"], "left")
    status = (
        F.when(F.col("relation").isNull(), "NO_RT_DATA")
        .when(F.col("relation").isin("CANCELED", "ADDED"), F.col("relation"))
        .otherwise("DELIVERED")
    )
    return joined.withColumn("delivery_status", status).drop("relation")


def added_trip_counts(trip_updates: DataFrame, first: date, last: date) -> DataFrame:
    """Distinct added trips per day, version, route and direction."""
    grain = ["trip_start_date", "static_version_date", "route_id", "direction_id"]
    return (
        trip_updates.where(_between("trip_start_date", first, last)
                           & (schedule_relation("trip_schedule_rel") == "ADDED"))
        .select(*grain, "trip_id").distinct()
        .groupBy(*grain).agg(F.count("trip_id").alias("added_trips"))
    )


def mart_service_delivered(trip_updates: DataFrame, trips: DataFrame, routes: DataFrame, stop_times: DataFrame,
                           calendar: DataFrame, calendar_dates: DataFrame, versions: DataFrame,
                           first: date, last: date) -> DataFrame:
    """Planned, delivered, canceled, unseen and added trips per day, route and direction.

    Only schedule versions in force within the range are read: from the one on ``first`` on.
    """
    oldest = F.coalesce(version_on(versions, first), F.lit(first))
    trips, routes, stop_times, calendar, calendar_dates = (
        dim.where(F.col("feed_start_date").between(oldest, F.lit(last)))
        for dim in (trips, routes, stop_times, calendar, calendar_dates))
    services = active_services(calendar, calendar_dates, versions, first, last)
    delivery = trip_delivery(scheduled_trips(trips, routes, stop_times, services), trip_updates, first, last)

    def with_status(name: str) -> Column:
        return F.count_if(F.col("delivery_status") == name)

    grain = ["trip_start_date", "static_version_date", "route_id", "direction_id"]
    counted = (
        delivery.where(F.col("delivery_status") != "ADDED")
        .groupBy(*grain)
        .agg(
            F.count("*").alias("scheduled_trips"),
            with_status("DELIVERED").alias("delivered_trips"),
            with_status("CANCELED").alias("canceled_trips"),
            with_status("NO_RT_DATA").alias("no_rt_data_trips"),
        )
    )
    # Names join the few groups, not the trips: a text maximum per trip would need sorted aggregation.
    names = routes.where(F.col("route_type") == BUS).groupBy("feed_start_date", "route_id").agg(
        F.max("route_short_name").alias("route_name"))
    named = join_version(counted, names, ["route_id"], ["route_name"])
    added = added_trip_counts(trip_updates, first, last)
    return left_join_null_safe(named, added, grain).withColumns({
        "service_date": F.col("trip_start_date"),
        "added_trips": F.coalesce("added_trips", F.lit(0).cast("bigint")),
        "pct_delivered": pct(F.col("delivered_trips"), F.col("scheduled_trips")),
    }).select(*columns_of(METRIC_SERVICE_DELIVERED))
