from datetime import date

import pytest
from builders import rows

from tramline import schemas as s
from tramline.plans import facts

D1, D2 = date(2024, 1, 10), date(2024, 1, 10)


@pytest.fixture
def versions(spark):
    return spark.createDataFrame([(date(2024, 1, 1),)], "feed_start_date date")


def test_run_day_offsets():
    assert facts.fact_day(date(2024, 1, 12)) == D1 and facts.load_day(date(2024, 1, 12)) == date(2024, 1, 11)


def test_positions_keep_own_day_and_early_next_day(spark, versions):
    base = {"trip_start_date": "2024-01-10", "service_date": "2024-01-10", "hour": 12}
    raw = rows(
        spark, s.RAW_VEHICLE_POSITIONS,
        {**base, "entity_id": "own"}, {**base, "entity_id": "not deleted", "is_deleted": False},
        {**base, "entity_id": "deleted", "is_deleted": True},
        {**base, "entity_id": "05", "service_date": "2024-01-11", "hour": 5},
        {**base, "entity_id": "06", "service_date": "2024-01-11", "hour": 6},
        {**base, "entity_id": "two days", "service_date": "2024-01-12", "hour": 1},
        {**base, "entity_id": "other day", "trip_start_date": "2024-01-09"},
    )
    out = facts.fact_vehicle_positions(raw, versions, D1, D2)
    assert sorted(r.entity_id for r in out.collect()) == ["05", "not deleted", "own"]
    assert out.columns == s.columns_of(s.FACT_VEHICLE_POSITIONS)
    assert {r.static_version_date for r in out.collect()} == {date(2024, 1, 1)}


def test_rows_before_the_first_version_are_rejected(spark, versions):
    raw = rows(spark, s.RAW_VEHICLE_POSITIONS, {"trip_start_date": "2023-12-30", "service_date": "2023-12-30", "hour": 1})
    assert facts.fact_vehicle_positions(raw, versions, date(2023, 12, 30), date(2023, 12, 30)).count() == 0


def test_final_trip_state(spark, versions):
    base = {"trip_start_date": "2024-01-10", "service_date": "2024-01-10", "trip_id": "t", "entity_id": "e1",
            "snapshot_timestamp": "2024-01-10T10:00:00", "ingested_at": "2024-01-11T00:00:00"}
    raw = rows(
        spark, s.RAW_TRIP_UPDATES, base,
        {**base, "service_date": "2024-01-11", "snapshot_timestamp": "2024-01-11T03:00:00", "delay": 1},
        {**base, "service_date": "2024-01-11", "snapshot_timestamp": "2024-01-11T03:00:00", "delay": 2,
         "ingested_at": "2024-01-11T09:00:00"},
        {**base, "service_date": "2024-01-11", "snapshot_timestamp": "2024-01-11T03:00:00", "delay": 3,
         "ingested_at": "2024-01-11T09:00:00", "entity_id": "e2"},
        {**base, "service_date": "2024-01-12", "snapshot_timestamp": "2024-01-12T03:00:00", "delay": 4},
        {**base, "service_date": "2024-01-11", "snapshot_timestamp": "2024-01-11T05:00:00", "delay": 5, "is_deleted": True},
        {**base, "trip_id": None, "delay": 6},
    )
    out = facts.fact_trip_updates(raw, versions, D1, D2)
    assert [(r.trip_id, r.delay) for r in out.collect()] == [("t", 3)]
    assert "stop_time_update" not in out.columns


ALERT = {"service_date": "2024-01-10", "ingested_at": "2024-01-10T00:00:00", "entity_id": "a",
         "snapshot_timestamp": "2024-01-10T10:00:00"}


def entity(route, stop, kind=3):
    return ("1", route, kind, None, stop, None)


def test_alert_entities_need_route_and_stop(spark):
    raw = rows(spark, s.RAW_ALERTS, {**ALERT, "informed_entity": [
        entity("1", "s1"), entity("1", None), entity(None, "s1"), entity("2", "s1")]},
        {**ALERT, "snapshot_timestamp": "2024-01-10T11:00:00", "informed_entity": [entity("1", "s1", 0)]},
        {**ALERT, "entity_id": "none"})
    got = {(r.route_id, r.stop_id): r.route_type for r in facts.fact_alerts_routes(raw).collect()}
    assert got == {("1", "s1"): 0, ("2", "s1"): 3}


def test_alert_periods(spark, at):
    start = 1704880859  # 2024-01-10 10:00:59 UTC
    raw = rows(spark, s.RAW_ALERTS, {**ALERT, "active_period": [(start, start + 61), (start, None)]},
               {**ALERT, "entity_id": "empty", "active_period": []}, {**ALERT, "entity_id": "null"})
    got = sorted(facts.fact_alerts_active_periods(raw).collect(), key=lambda r: r.period_index)
    assert [(r.period_index, r.is_open_ended) for r in got] == [(0, False), (1, True)]
    assert got[0].duration_hours == 2 / 60.0 and got[1].duration_hours is None
    assert got[0].active_start == at("2024-01-10T10:00:59") and got[1].active_end is None


def test_alert_text_and_newest_state(spark, versions):
    raw = rows(
        spark, s.RAW_ALERTS, {**ALERT, "header_text": ([("old", "en")],), "severity_level": "INFO"},
        {**ALERT, "snapshot_timestamp": "2024-01-10T12:00:00", "header_text": ([("es", "es"), ("en", "en")],),
         "severity_level": "SEVERE"},
        {**ALERT, "snapshot_timestamp": "2024-01-10T13:00:00", "is_deleted": True})
    got = facts.fact_alerts(raw, versions).collect()
    assert [(r.header_text, r.severity_level, r.url) for r in got] == [("es", "SEVERE", None)]
    assert facts.fact_alerts(raw, versions, date(2024, 1, 11)).count() == 0


def test_alert_periods_are_picked_by_stamps(spark):
    """Times are computed for the picked rows only, below nothing that shuffles or sorts all rows; the picks are those of the times."""
    start = 1704906000
    raw = rows(spark, s.RAW_ALERTS, {**ALERT, "active_period": [(start, None)]}, {**ALERT, "active_period": [(None, start)]},
               {**ALERT, "active_period": [(start, start + 5), (None, None)]}, {**ALERT, "active_period": [(-5, start)]})
    found = facts.fact_alerts_active_periods(raw)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "make_dt_interval" in plan[:plan.index("Window")] and "make_dt_interval" not in plan[plan.index("Window"):]
    got = sorted(found.collect(), key=lambda r: r.period_index)
    assert [(r.period_index, r.active_start, r.is_open_ended) for r in got] == [(0, None, False), (1, None, True)]
