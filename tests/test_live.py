import json

import pytest
from pyspark.sql import functions as F

from tramline.plans import live
from tramline.sources import feed_spec

NOW = 1_704_906_100


def entities(spark, payload, *records):
    """Entity rows from dicts shaped like the feed; absent fields are NULL."""
    kind = feed_spec.entity_type(payload)
    layout = f"feed_timestamp BIGINT, entity_index BIGINT, entity {kind.simpleString()}"
    data = [(NOW - 5, i, {"id": r.pop("id", f"e{i}"), payload: r}) for i, r in enumerate(records)]
    return spark.createDataFrame(data, layout)


def bus(at=NOW, route="1", trip="t1", **more):
    return {"trip": {"trip_id": trip, "route_id": route}, "position": {"latitude": 42.0, "longitude": -71.0},
            "timestamp": at, **more}


@pytest.fixture
def stops(spark):
    return spark.createDataFrame([("s1", "Main"), ("s2", "Side")], "stop_id string, stop_name string")


@pytest.fixture
def trips(spark):
    rows = [("t1", "1", "0", "a", "North"), ("t2", "1", "0", "b", "South"), ("t3", "1", "0", "b", "South"),
            ("t4", "1", "1", "c", ""), ("t5", "Red", "0", "r", "Rail"), ("t6", "1", "0", "d", ""), ("t7", "1", "0", "e", "")]
    return spark.createDataFrame(rows, "trip_id string, route_id string, direction_id string, shape_id string, trip_headsign string")


def test_vehicle_rules(spark, stops, trips):
    feed = entities(
        spark, "vehicle",
        bus(NOW - 90, id="fresh", stop_id="s1", vehicle={"id": "v1", "label": "L"}),
        bus(NOW - 91, id="stale", trip="none"), bus(NOW + 50, id="ahead"), bus(0, id="no stamp"),
        bus(id="rail", route="Red"), {"id": "no position", "trip": {"route_id": "1"}},
        {**bus(id="no lat"), "position": {"longitude": 1.0}}, bus(id="blank vehicle", vehicle={}))
    got = {r.vehicle_id: r for r in live.live_vehicles(feed, stops, trips, NOW).collect()}
    assert set(got) == {"v1", "stale", "ahead", "no stamp", ""}
    v = got["v1"]
    assert (v.age_seconds, v.is_fresh, v.stop_name, v.direction_label, v.status) == (90, True, "Main", "North", "IN_TRANSIT_TO")
    assert (got["stale"].age_seconds, got["stale"].is_fresh, got["stale"].direction_label) == (91, False, "")
    assert got["ahead"].age_seconds == 0 and got["no stamp"].age_seconds == 5
    summary = live.fleet_summary(live.live_vehicles(feed, stops, trips, NOW)).first()
    assert (summary.active_count, summary.fresh_count, summary.avg_age_seconds) == (5, 4, 37)


def test_direction_label_falls_back(spark, stops, trips):
    def at(trip, direction):
        return {**bus(trip=trip, id=f"{trip}-{direction}"), "trip": {"trip_id": trip, "route_id": "1", "direction_id": direction}}

    feed = entities(spark, "vehicle", at("t1", 0), at("x", 0), at("x", 1))
    got = {r.vehicle_id: r.direction_label for r in live.live_vehicles(feed, stops, trips, NOW).collect()}
    assert got == {"t1-0": "North", "x-0": "South", "x-1": "Direction 1"}


def test_geojson(spark, stops, trips):
    feed = entities(spark, "vehicle", bus(id="v"))
    feature = json.loads(live.vehicle_geojson(live.live_vehicles(feed, stops, trips, NOW)).first().feature)
    assert feature["geometry"] == {"type": "Point", "coordinates": [-71.0, 42.0]}
    assert feature["properties"]["speed_mph"] is None and feature["id"] == "v"


def test_shapes(spark, trips):
    points = [("a", 2, 1.0, 5.0), ("a", 1, 2.0, 6.0), ("b", 1, 3.0, 7.0), ("c", 1, 1.0, 1.0), ("c", 2, 1.0, 2.0), ("r", 1, 0.0, 0.0)]
    shapes = spark.createDataFrame(points, "shape_id string, seq int, lat double, lon double")
    picked = {r.shape_id: r.trip_count for r in live.selected_shapes(trips).collect()}
    assert picked == {"b": 2, "a": 1, "d": 1, "c": 1}
    lines = {r.shape_id: r for r in live.route_shapes(trips, shapes).collect()}
    assert set(lines) == {"a", "c"}  # b has one point
    assert lines["a"].coordinates == [[6.0, 2.0], [5.0, 1.0]] and lines["c"].direction_label == "Direction 1"
    assert live.route_shapes(trips, shapes, "77").count() == 0
    box = live.map_bounds(live.route_shapes(trips, shapes), spark.createDataFrame(
        [(-9.0, 50.0, True), (99.0, 99.0, False)], "longitude double, latitude double, is_fresh boolean"), fresh_only=True).first()
    assert tuple(box) == (-9.0, 1.0, 6.0, 50.0)
    assert json.loads(live.shape_geojson(live.route_shapes(trips, shapes, "1")).first().feature)["geometry"]["type"] == "LineString"


def stop(seq, at, name="s1"):
    return {"stop_sequence": seq, "stop_id": name, "arrival": {"time": at} if at is not None else None}


def vehicles(spark, *rows):
    return spark.createDataFrame(list(rows), "vehicle_id string, trip_id string, current_stop_sequence int")


def test_upcoming_stops(spark, stops):
    feed = entities(
        spark, "trip_update",
        {"trip": {"trip_id": "t1"}, "stop_time_update": [stop(i, NOW + i) for i in range(1, 15)]},
        {"trip": {"trip_id": "t9"}, "vehicle": {"id": "v1"}, "stop_time_update": [stop(1, NOW)]},
        {"trip": {"trip_id": "t2"}, "vehicle": {"id": "v2"}, "stop_time_update": [
            stop(None, NOW - 1), stop(2, NOW - 1), stop(3, NOW), stop(4, None), stop(5, 0, "s2")]})
    got = live.upcoming_stops(vehicles(spark, ("v1", "t1", 3), ("v2", "", None), ("v3", "", 1), ("v4", "t2", 2)), feed, stops, NOW).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.vehicle_id, r.position)):
        by.setdefault(r.vehicle_id, []).append(r.stop_sequence)
    # v1: the trip match comes first in the feed; stops after 3, at most 8. v2: by time. v3: no match.
    assert by == {"v1": list(range(4, 12)), "v2": [3, 4, 5], "v4": [3, 4, 5]}
    assert [r.stop_name for r in got if r.vehicle_id == "v2" and r.stop_sequence == 5] == ["Side"]


def test_alerts_now(spark):
    def item(name, periods, *routes):
        return {"id": name, "active_period": periods, "informed_entity": [{"route_id": r} for r in routes],
                "header_text": {"translation": [{"text": "hola", "language": "es"}, {"text": "hi", "language": "en"}]}}

    feed = entities(
        spark, "alert", item("always", [], "10", "9", "9", "SL1", "Red"), item("open start", [{"end": NOW}], "1"),
        item("open end", [{"start": NOW}], "1"), item("past", [{"start": 1, "end": NOW - 1}], "1"),
        item("second", [{"start": 1, "end": 2}, {"start": NOW - 1, "end": NOW + 1}], "CT1"), item("rail only", [], "Red"))
    got = {r.alert_id: r for r in live.live_alerts(feed, NOW).collect()}
    assert set(got) == {"always", "open start", "open end", "second"}
    assert got["always"].routes_affected == ["9", "10", "SL1"]
    assert (got["always"].header, got["always"].description, got["always"].cause) == ("hi", "", "UNKNOWN_CAUSE")
    assert [r.alert_id for r in live.live_alerts(feed, NOW, "CT1").collect()] == ["second"]
    assert live.alerts_shown(live.live_alerts(feed, NOW), [F.col("alert_id").asc()], n=2).count() == 2


def test_recent_rows_and_verdicts(spark):
    feed = entities(
        spark, "vehicle", bus(id="kept", route=" 1 "), {"id": "rail no position", "trip": {"route_id": "Red"}},
        bus(id="rail", route="Red"), {**bus(id="half"), "position": {"latitude": 1.0}})
    rows = live.recent_rows(feed, NOW)
    assert {r.entity_id: r.verdict for r in rows.collect()} == {
        "kept": "kept", "rail no position": "no_position", "rail": "non_bus", "half": "no_position"}
    q = live.load_quality(rows).first()
    assert (q.row_count, q.skipped_non_bus_count, q.skipped_no_position_count) == (1, 1, 2)
    kept = rows.where("verdict = 'kept'").first()
    assert (kept.snapshot_ts, kept.feed_age_seconds, kept.status) == ("2024-01-10T17:01:40Z", 5, "NO_DATA")


def test_newest_feed(spark):
    feed = entities(spark, "vehicle", bus(id="a"), bus(id="b")).withColumn("feed_timestamp", F.col("entity_index") + 100)
    assert [r.entity.id for r in live.newest_feed(feed).collect()] == ["b"]
    fresh = live.feed_freshness({"vehicles": feed, "empty": feed.limit(0)}, 111).collect()
    assert {r.feed: r.feed_age_seconds for r in fresh} == {"vehicles": 10, "empty": None}
