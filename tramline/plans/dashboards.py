"""Dashboard queries over the marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.rates import is_early, is_late, mean_flag_pct, pct, weighted_mean
from tramline.functions.text import route_name_order
from tramline.operators.latest import top_overall
from tramline.plans.marts import OCCUPANCY_SHARES, SEVERITIES

LEAST_EVENTS = 100
TOP = 10


def in_range(df: DataFrame, day: str, first: date, last: date, routes: Sequence[str] | None = None) -> DataFrame:
    """Rows of a date range and, when a route list is given and not empty, of these routes."""
    kept = df.where(F.col(day).between(F.lit(first), F.lit(last)))
    return kept.where(F.col("route_name").isin(list(routes))) if routes else kept


def _bucket(day: str, first: date, last: date) -> Column:
    """Hour of day for a single-day range, else the day."""
    return F.col("hour" if first == last else day).alias("bucket")


def route_options(occupancy: DataFrame) -> DataFrame:
    """Routes to choose from, numbers first and by value."""
    named = occupancy.where(F.col("route_name").isNotNull()).select("route_id", "route_name").distinct()
    return named.orderBy(*route_name_order("route_name"), "route_id")


# ---------------------------------------------------------------- on-time performance


def _punctuality() -> list[Column]:
    delay = F.col("arrival_delay_seconds")
    return [
        F.count("*").alias("event_count"),
        mean_flag_pct(F.col("is_on_time")).alias("on_time_pct"),
        mean_flag_pct(is_early(delay)).alias("early_pct"),
        mean_flag_pct(is_late(delay)).alias("late_pct"),
    ]


def _measured(on_time: DataFrame) -> DataFrame:
    return on_time.where(F.col("is_on_time").isNotNull() & F.col("arrival_delay_seconds").isNotNull())


def on_time_trend(on_time: DataFrame, first: date, last: date, routes: Sequence[str] | None = None) -> DataFrame:
    """On-time, early and late shares by day, or by hour for one day."""
    rows = _measured(in_range(on_time, "trip_start_date", first, last, routes)).where(F.col("hour").isNotNull())
    return rows.groupBy(_bucket("trip_start_date", first, last)).agg(*_punctuality()).orderBy("bucket")


def least_punctual_routes(on_time: DataFrame, first: date, last: date,
                          least_events: int = LEAST_EVENTS, n: int = TOP) -> DataFrame:
    """The n routes with the lowest on-time share among those with enough events."""
    rows = _measured(in_range(on_time, "trip_start_date", first, last)).where(F.col("route_name").isNotNull())
    ranked = rows.groupBy("route_name").agg(*_punctuality()).where(F.col("event_count") >= least_events)
    return top_overall(ranked, [F.col("on_time_pct").asc(), F.col("route_name").asc()], n)


# ---------------------------------------------------------------- occupancy


def occupancy_trend(occupancy: DataFrame, first: date, last: date, routes: Sequence[str] | None = None) -> DataFrame:
    """Snapshot-weighted occupancy by day, or by hour for one day.

    The mean weighs every hour by all its snapshots, also those that did not
    report a percentage.
    """
    n = F.col("snapshot_count")
    shares = [*OCCUPANCY_SHARES, "pct_no_data_occupancy"]
    return (
        in_range(occupancy, "service_date", first, last, routes)
        .groupBy(_bucket("service_date", first, last))
        .agg(
            F.sum(n).alias("snapshot_count"),
            weighted_mean(F.col("avg_occupancy_pct"), n, over_reported=True).alias("avg_occupancy_pct"),
            *[weighted_mean(F.col(c), n).alias(c) for c in shares],
        )
        .orderBy("bucket")
    )


def crowded_routes(occupancy: DataFrame, first: date, last: date, n: int = TOP) -> DataFrame:
    """The n routes with the highest weighted mean occupancy."""
    rows = in_range(occupancy, "service_date", first, last).where(F.col("route_name").isNotNull())
    mean = weighted_mean(F.col("avg_occupancy_pct"), F.col("snapshot_count"), over_reported=True)
    ranked = rows.groupBy("route_name").agg(
        F.sum("snapshot_count").alias("snapshot_count"), mean.alias("avg_occupancy_pct"),
    ).where(F.col("avg_occupancy_pct").isNotNull())
    return top_overall(ranked, [F.col("avg_occupancy_pct").desc(), F.col("route_name").asc()], n)


# ---------------------------------------------------------------- alerts


def _severity_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in SEVERITIES]


def _chosen(severities: Sequence[str]) -> Column:
    columns = [name for name, level in SEVERITIES.items() if level in severities]
    total = F.lit(0)
    for name in columns:
        total = total + F.col(name)
    return total.cast("bigint")


def alerts_by_route(by_day: DataFrame, first: date, last: date, routes: Sequence[str] | None = None) -> DataFrame:
    """The mart rows of a range, newest day first."""
    return in_range(by_day, "alert_date", first, last, routes).orderBy(F.col("alert_date").desc(), "route_id")


def daily_alert_totals(by_day: DataFrame, first: date, last: date, routes: Sequence[str] | None = None) -> DataFrame:
    """Severity counts per day summed over routes, and their total."""
    daily = in_range(by_day, "alert_date", first, last, routes).groupBy("alert_date").agg(*_severity_sums())
    return daily.withColumn("total", _chosen(list(SEVERITIES.values()))).orderBy("alert_date")


def highest_daily_total(by_day: DataFrame, first: date, last: date,
                        routes: Sequence[str] | None = None) -> DataFrame:
    """Largest daily total, the scale of the daily chart."""
    return daily_alert_totals(by_day, first, last, routes).agg(F.max("total").alias("max_daily_total"))


def top_alert_routes(by_day: DataFrame, first: date, last: date,
                     severities: Sequence[str] = tuple(SEVERITIES.values()), n: int = TOP) -> DataFrame:
    """The n routes with most alerts of the chosen severities."""
    summed = in_range(by_day, "alert_date", first, last).groupBy("route_name").agg(*_severity_sums())
    ranked = summed.withColumn("total", _chosen(severities)).where(F.col("total") > 0)
    return top_overall(ranked, [F.col("total").desc(), F.col("route_name").asc()], n)


def alert_hotspots(by_stop: DataFrame, first: date, last: date) -> DataFrame:
    """Alert counts and mean place per stop name over a range."""
    rows = by_stop.where(
        F.col("alert_date").between(F.lit(first), F.lit(last))
        & F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull()
    )
    return rows.groupBy("stop_name").agg(
        F.avg("stop_lat").alias("stop_lat"), F.avg("stop_lon").alias("stop_lon"),
        F.sum("alert_count").alias("alert_count"), *_severity_sums(),
    )


def top_alert_stops(by_stop: DataFrame, first: date, last: date,
                    severities: Sequence[str] = tuple(SEVERITIES.values()), n: int = TOP) -> DataFrame:
    """The n stops with most alerts of the chosen severities, smallest of them first for display."""
    ranked = alert_hotspots(by_stop, first, last).withColumn("total", _chosen(severities)).where(F.col("total") > 0)
    top = top_overall(ranked, [F.col("total").desc(), F.col("stop_name").asc()], n)
    return top.orderBy(F.col("total").asc(), F.col("stop_name").desc())


# ---------------------------------------------------------------- service delivered


def service_trend(delivered: DataFrame, first: date, last: date, routes: Sequence[str] | None = None) -> DataFrame:
    """Daily trip sums and their shares of the scheduled trips."""
    counts = ["scheduled_trips", "delivered_trips", "canceled_trips", "no_rt_data_trips", "added_trips"]
    daily = in_range(delivered, "trip_start_date", first, last, routes).groupBy(
        F.col("trip_start_date").alias("bucket")).agg(*[F.sum(c).alias(c) for c in counts])
    shares = {f"pct_{c.removesuffix('_trips')}": pct(F.col(c), F.col("scheduled_trips")) for c in counts[1:]}
    return daily.withColumns(shares).orderBy("bucket")
