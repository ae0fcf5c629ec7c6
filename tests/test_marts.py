from datetime import date

import pytest
from builders import rows

from tramline import schemas as s
from tramline.plans import dashboards, marts

DAY = date(2024, 1, 10)  # a Wednesday
V = "2024-01-01"
ROUTES = "feed_start_date DATE, route_id STRING, route_short_name STRING, route_type INT"


@pytest.fixture
def routes(spark):
    return rows(spark, ROUTES, {"feed_start_date": V, "route_id": "1", "route_short_name": "One", "route_type": 3},
                {"feed_start_date": V, "route_id": "Red", "route_short_name": "Red", "route_type": 1})


def position(**more):
    return {"service_date": "2024-01-10", "trip_start_date": "2024-01-10", "hour": 8, "trip_id": "t", "route_id": "1",
            "entity_id": "e", "static_version_date": V, "current_status": "STOPPED_AT", **more}


def test_on_time_bounds_and_first_arrival(spark, routes):
    stop_times = rows(spark, "feed_start_date DATE, trip_id STRING, stop_sequence INT, arrival_time STRING, arrival_seconds INT",
                      *[{"feed_start_date": V, "trip_id": "t", "stop_sequence": n, "arrival_time": "08:05:00", "arrival_seconds": sec}
                        for n, sec in ((1, 29100), (2, 29100), (3, 29100), (4, 29100), (5, 29100), (6, None))])
    at = {1: "08:05:00", 2: "08:02:29", 3: "08:02:30", 4: "08:10:00", 5: "08:10:01", 6: "08:05:00"}
    positions = rows(
        spark, s.FACT_VEHICLE_POSITIONS,
        *[position(current_stop_sequence=n, position_timestamp=f"2024-01-10T{t}") for n, t in at.items()],
        position(current_stop_sequence=4, position_timestamp="2024-01-10T09:00:00"),
        position(current_stop_sequence=None, position_timestamp="2024-01-10T08:00:00"),
        position(current_stop_sequence=3, position_timestamp="2024-01-10T08:00:00", current_status="IN_TRANSIT_TO"),
        position(current_stop_sequence=2, trip_id="rail", route_id="Red", position_timestamp="2024-01-10T08:00:00"))
    mart = marts.mart_on_time(positions, stop_times, routes, DAY, DAY)
    got = {r.stop_sequence: (r.arrival_delay_seconds, r.is_on_time) for r in mart.collect()}
    assert got == {2: (-151, False), 3: (-150, True), 4: (300, True), 5: (301, False), 6: (None, False)}
    trend = dashboards.on_time_trend(mart, DAY, DAY).collect()
    assert [(r.bucket, r.event_count, r.on_time_pct, r.early_pct, r.late_pct) for r in trend] == [(8, 4, 50.0, 25.0, 25.0)]
    assert dashboards.on_time_trend(mart, DAY, date(2024, 1, 11)).first().bucket == DAY
    assert dashboards.least_punctual_routes(mart, DAY, DAY).count() == 0
    assert dashboards.least_punctual_routes(mart, DAY, DAY, least_events=4).first().route_name == "One"
    assert dashboards.on_time_trend(mart, DAY, DAY, routes=["Two"]).count() == 0


def test_overnight_arrival_compares_with_hours_beyond_24(spark, routes):
    stop_times = rows(spark, "feed_start_date DATE, trip_id STRING, stop_sequence INT, arrival_time STRING, arrival_seconds INT",
                      {"feed_start_date": V, "trip_id": "t", "stop_sequence": 9, "arrival_time": "25:10:00", "arrival_seconds": 90600})
    positions = rows(spark, s.FACT_VEHICLE_POSITIONS, position(
        service_date="2024-01-11", hour=1, current_stop_sequence=9, position_timestamp="2024-01-11T01:11:00"))
    assert marts.mart_on_time(positions, stop_times, routes, DAY, DAY).first().arrival_delay_seconds == 60


def test_occupancy_shares_and_silent_snapshots(spark, routes):
    def seen(status, pct, seq=2, route="1"):
        return position(occupancy_status=status, occupancy_percentage=pct, current_stop_sequence=seq, route_id=route)

    positions = rows(spark, s.FACT_VEHICLE_POSITIONS, seen("EMPTY", 0), seen("FULL", 100), seen(None, None),
                     seen("EMPTY", 50, seq=1), seen("EMPTY", 50, seq=None), seen("FULL", 9, route="Red"))
    row = marts.mart_occupancy_route_hour(positions, routes, DAY, DAY).collect()
    assert len(row) == 1
    row = row[0]
    assert (row.snapshot_count, row.avg_occupancy_pct, row.pct_snapshots_reporting) == (3, 50.0, 66.67)
    assert (row.pct_empty, row.pct_full, row.pct_no_data_occupancy, row.pct_few_seats) == (33.33, 33.33, 33.33, 0.0)


def alert_tables(spark, periods, touched, states):
    return (
        rows(spark, s.FACT_ALERTS_ACTIVE_PERIODS, *[
            {"entity_id": e, "period_index": i, "active_start": a, "active_end": b} for e, i, a, b in periods]),
        rows(spark, s.FACT_ALERTS_ROUTES, *[
            {"entity_id": e, "route_id": r, "stop_id": p, "route_type": k} for e, r, p, k in touched]),
        rows(spark, s.FACT_ALERTS, *[
            {"entity_id": e, "severity_level": v, "static_version_date": V} for e, v in states]),
    )


PERIODS = [
    ("open", 0, "2024-01-01T00:00:00", None), ("before", 0, "2024-01-01T00:00:00", "2024-01-09T23:59:59"),
    ("on day", 0, "2024-01-01T00:00:00", "2024-01-10T00:00:00"), ("later", 0, "2024-01-11T00:00:00", None),
    ("twice", 0, "2024-01-09T00:00:00", "2024-01-12T00:00:00"), ("twice", 1, "2024-01-10T09:00:00", "2024-01-10T10:00:00"),
]
TOUCHED = [
    ("open", "1", "a", 3), ("open", "1", "b", 3), ("before", "1", "a", 3), ("on day", "1", "a", 3), ("later", "1", "a", 3),
    ("twice", "1", "a", 3), ("twice", "1", "c", 3), ("open", "Red", "a", 1),
]
STATES = [("open", "SEVERE"), ("before", "INFO"), ("on day", "WARNING"), ("later", "INFO"), ("twice", "SEVERE")]


def test_alerts_active_on_a_day(spark, routes):
    mart = marts.mart_alerts_by_day(*alert_tables(spark, PERIODS, TOUCHED, STATES), routes, DAY, DAY)
    got = [tuple(r) for r in mart.select("alert_date", "route_id", "route_name", "alert_count", "severe_count",
                                         "warning_count", "info_count").collect()]
    assert got == [(DAY, "1", "One", 3, 2, 1, 0)]


def test_a_range_equals_its_days(spark, routes):
    tables = alert_tables(spark, PERIODS, TOUCHED, STATES)
    first, last = date(2024, 1, 8), date(2024, 1, 13)
    whole = marts.mart_alerts_by_day(*tables, routes, first, last).collect()
    single = []
    for n in range(8, 14):
        single += marts.mart_alerts_by_day(*tables, routes, date(2024, 1, n), date(2024, 1, n)).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, single))


def test_stop_place_is_weighted_by_period_and_route_rows(spark):
    stops = rows(spark, "feed_start_date DATE, stop_id STRING, stop_name STRING, stop_lat DOUBLE, stop_lon DOUBLE",
                 *[{"feed_start_date": V, "stop_id": i, "stop_name": n, "stop_lat": lat, "stop_lon": -71.0}
                   for i, n, lat in (("a", "Main", 1.0), ("b", "Main", 2.0), ("c", "Main", 4.0))])
    row = marts.mart_alerts_by_day_stops(*alert_tables(spark, PERIODS, TOUCHED, STATES), stops, DAY, DAY).collect()
    assert len(row) == 1
    # open: a, b once; on day: a once; twice: a and c for each of two periods.
    assert row[0].stop_lat == pytest.approx((1 + 2 + 1 + 2 * (1 + 4)) / 7)
    assert (row[0].alert_count, row[0].severe_count, row[0].warning_count) == (3, 2, 1)


def service_tables(spark, calendar, dates, trips, departures):
    flags = dict.fromkeys(marts.WEEKDAYS, False)
    return {
        "trips": rows(spark, "feed_start_date DATE, trip_id STRING, route_id STRING, direction_id INT, service_id STRING",
                      *[{"feed_start_date": V, "trip_id": t, "route_id": r, "direction_id": d, "service_id": sv} for t, r, d, sv in trips]),
        "stop_times": rows(spark, "feed_start_date DATE, trip_id STRING, stop_sequence INT, departure_time STRING",
                           *[{"feed_start_date": V, "trip_id": t, "stop_sequence": n, "departure_time": x} for t, n, x in departures]),
        "calendar": rows(spark, "feed_start_date DATE, service_id STRING, " + ", ".join(f"{d} BOOLEAN" for d in marts.WEEKDAYS)
                         + ", start_date DATE, end_date DATE",
                         *[{"feed_start_date": V, "service_id": sv, **flags, day: True, "start_date": a, "end_date": b}
                           for sv, day, a, b in calendar]),
        "calendar_dates": rows(spark, "feed_start_date DATE, service_id STRING, date DATE, exception_type INT",
                               *[{"feed_start_date": V, "service_id": sv, "date": d, "exception_type": k} for sv, d, k in dates]),
        "versions": rows(spark, "feed_start_date DATE", {"feed_start_date": V}),
    }


def test_services_of_a_day(spark):
    t = service_tables(
        spark,
        [("weekly", "wednesday", "2024-01-01", "2024-01-31"), ("wrong day", "tuesday", "2024-01-01", "2024-01-31"),
         ("removed", "wednesday", "2024-01-01", "2024-01-31"), ("ended", "wednesday", "2023-12-01", "2024-01-09"),
         ("both", "tuesday", "2024-01-01", "2024-01-31")],
        [("removed", "2024-01-10", 2), ("added", "2024-01-10", 1), ("both", "2024-01-10", 1), ("both", "2024-01-10", 2)], [], [])
    out = marts.active_services(t["calendar"], t["calendar_dates"], t["versions"], DAY, DAY)
    assert sorted(r.service_id for r in out.collect()) == ["added", "weekly"]


def test_delivery_states_and_added_trips(spark, routes):
    names = ["blank", "null", "canceled", "added", "unseen", "late", "rail", "no time"]
    t = service_tables(
        spark, [("wk", "wednesday", "2024-01-01", "2024-01-31")], [],
        [(n, "Red" if n == "rail" else "1", None, "wk") for n in names],
        [(n, 2, "09:00:00") for n in names if n not in ("late", "no time")] + [("late", 1, "24:05:00"), ("blank", 1, "23:59:00"),
                                                                             ("no time", 1, None)])
    seen = [("blank", " "), ("null", None), ("canceled", "CANCELED"), ("added", "ADDED"), ("extra", "ADDED"), ("extra 2", " ADDED ")]
    updates = rows(spark, s.FACT_TRIP_UPDATES, *[
        {"trip_start_date": "2024-01-10", "trip_id": n, "trip_schedule_rel": rel, "route_id": "1", "static_version_date": V} for n, rel in seen],
        {"trip_start_date": "2024-01-10", "trip_id": "other direction", "trip_schedule_rel": "ADDED", "route_id": "1",
         "direction_id": 1, "static_version_date": V})
    mart = marts.mart_service_delivered(updates, t["trips"], routes, t["stop_times"], t["calendar"], t["calendar_dates"],
                                        t["versions"], DAY, DAY).collect()
    assert len(mart) == 1
    row = mart[0]
    assert (row.scheduled_trips, row.delivered_trips, row.canceled_trips, row.no_rt_data_trips) == (4, 2, 1, 1)
    assert (row.added_trips, row.direction_id, row.pct_delivered, row.route_name) == (3, None, 50.0, "One")


def test_dashboard_rankings(spark):
    by_day = rows(spark, s.METRIC_ALERTS_BY_DAY, *[
        {"alert_date": "2024-01-10", "route_id": str(i), "route_name": f"r{i:02}", "alert_count": i, "severe_count": i % 3,
         "warning_count": 1, "info_count": 0} for i in range(20)])
    top = dashboards.top_alert_routes(by_day, DAY, DAY, severities=["SEVERE"]).collect()
    assert [r.route_name for r in top] == ["r02", "r05", "r08", "r11", "r14", "r17", "r01", "r04", "r07", "r10"]
    assert dashboards.top_alert_routes(by_day, DAY, DAY, severities=["INFO"]).count() == 0
    totals = dashboards.daily_alert_totals(by_day, DAY, DAY).first()
    assert (totals.severe_count, totals.warning_count, totals.total) == (19, 20, 39)
    assert dashboards.highest_daily_total(by_day, DAY, DAY).first().max_daily_total == 39


def test_occupancy_trend_weights_silent_hours_as_silent(spark):
    mart = rows(spark, s.METRIC_OCCUPANCY_ROUTE_HOUR, *[
        {"service_date": "2024-01-10", "hour": h, "route_id": "1", "route_name": "One", "snapshot_count": n, "avg_occupancy_pct": a,
         "pct_empty": 50.0} for h, n, a in ((8, 10, 20.0), (9, 30, 60.0), (9, 60, None))])
    by_hour = {r.bucket: r for r in dashboards.occupancy_trend(mart, DAY, DAY).collect()}
    assert by_hour[9].avg_occupancy_pct == 60.0 and by_hour[9].snapshot_count == 90
    by_day = dashboards.occupancy_trend(mart, DAY, date(2024, 1, 11)).first()
    assert by_day.avg_occupancy_pct == 50.0 and by_day.pct_empty == 50.0
    assert dashboards.crowded_routes(mart, DAY, DAY).first().route_name == "One"
