import os
from datetime import date

from builders import rows
from pyspark.sql import functions as F

from tramline import schemas as s
from tramline.plans import daily, raw
from tramline.sinks import tables as sinks
from tramline.sinks.state import LatestState
from tramline.sources import feed_spec, schedule, snapshot_tree
from tramline.sources.recent import read_recent
from tramline.sources.snapshots import decode_snapshots, read_snapshot_files

DAY = "2024-01-10"


def snapshot(base, feed, hour, minute, fill, day=DAY, stamp=1704906000):
    folder = base / feed / f"dt={day}" / f"hour={hour:02}"
    folder.mkdir(parents=True, exist_ok=True)
    message = feed_spec.message_class()()
    message.header.gtfs_realtime_version = "2.0"
    message.header.timestamp = stamp + minute * 60
    fill(message)
    (folder / f"snapshot_{day.replace('-', '')}_{hour:02}{minute:02}00.pb").write_bytes(message.SerializeToString())


def vehicle(message, name, trip="t1", sequence=2, start="20240110", status=1, at=1704906000, route="1"):
    e = message.entity.add(id=name)
    e.vehicle.trip.trip_id, e.vehicle.trip.route_id, e.vehicle.trip.start_date = trip, route, start
    e.vehicle.position.latitude, e.vehicle.position.longitude = 42.5, -71.25
    e.vehicle.current_stop_sequence, e.vehicle.current_status, e.vehicle.timestamp = sequence, status, at
    return e


def update(message, trip, relation, delay=0, start="20240110"):
    e = message.entity.add(id=f"u-{trip}")
    e.trip_update.trip.trip_id, e.trip_update.trip.route_id, e.trip_update.trip.start_date = trip, "1", start
    if relation is not None:
        e.trip_update.trip.schedule_relationship = relation
    e.trip_update.delay = delay
    stop = e.trip_update.stop_time_update.add(stop_sequence=1, stop_id="s1")
    stop.arrival.time = 5


def alert(message, name, severity=4, start=1704800000, end=None):
    e = message.entity.add(id=name)
    e.alert.severity_level, e.alert.cause, e.alert.effect = severity, 9, 4
    period = e.alert.active_period.add(start=start)
    if end:
        period.end = end
    e.alert.informed_entity.add(agency_id="1", route_id="1", route_type=3, stop_id="s2")
    e.alert.header_text.translation.add(text="Detour", language="en")


def test_decode_keeps_absent_fields_null(spark, tmp_path, at):
    def fill(m):
        e = vehicle(m, "v1")
        e.vehicle.occupancy_status = 0
        e.vehicle.multi_carriage_details.add(id="c1", carriage_sequence=1)
        m.entity.add(id="other").alert.cause = 1
        m.entity.add(id="gone", is_deleted=True).vehicle.stop_id = "s"

    snapshot(tmp_path, "vehicle_positions", 12, 0, fill)
    files = read_snapshot_files(spark, str(tmp_path), "vehicle_positions", date(2024, 1, 10), date(2024, 1, 10))
    table = raw.raw_vehicle_positions(decode_snapshots(files, "vehicle_positions", engine="python"))
    assert table.columns == s.columns_of(s.RAW_VEHICLE_POSITIONS)
    got = {r.entity_id: r for r in table.collect()}
    assert set(got) == {"v1", "gone"}
    v = got["v1"]
    assert (v.hour, v.service_date, v.snapshot_timestamp) == (12, date(2024, 1, 10), at("2024-01-10T12:00:00"))
    assert (v.current_status, v.occupancy_status, v.occupancy_percentage, v.is_deleted) == ("STOPPED_AT", "EMPTY", None, None)
    assert (v.trip_start_date, v.trip_schedule_rel, v.latitude) == (date(2024, 1, 10), None, 42.5)
    assert v.multi_carriage_details[0].id == "c1" and v.multi_carriage_details[0].label is None
    assert got["gone"].is_deleted is True and got["gone"].latitude is None


def test_empty_feed_and_missing_folders(spark, tmp_path):
    assert read_snapshot_files(spark, str(tmp_path), "alerts", date(2024, 1, 10), date(2024, 1, 10)) is None
    snapshot(tmp_path, "alerts", 1, 0, lambda m: None)
    snapshot(tmp_path, "alerts", 3, 0, lambda m: alert(m, "a"))  # hour 02 is missing, as on a clock change
    files = read_snapshot_files(spark, str(tmp_path), "alerts", date(2024, 1, 10), date(2024, 1, 10))
    assert [r.hour for r in decode_snapshots(files, "alerts").collect()] == [3]
    other = read_snapshot_files(spark, str(tmp_path), "alerts", date(2024, 1, 11), date(2024, 1, 11))
    assert other.count() == 0


def test_stride_takes_every_nth_file_of_each_hour(spark, tmp_path):
    for hour in (4, 5):
        for minute in range(0, 12):
            snapshot(tmp_path, "trip_updates", hour, minute, lambda m: update(m, "t", 0))
    files = read_snapshot_files(spark, str(tmp_path), "trip_updates", date(2024, 1, 10), date(2024, 1, 10), stride=5)
    names = sorted(os.path.basename(r.path) for r in files.collect())
    assert names == [f"snapshot_20240110_{h:02}{m:02}00.pb" for h in (4, 5) for m in (0, 5, 10)]


def test_descriptor_matches_the_public_numbers():
    m = feed_spec.message_class()()
    vehicle(m, "x", status=2)
    assert m.SerializeToString()[-40:].find(b"\x20\x02") >= 0  # field 4, value 2
    assert feed_spec.entity_type("alert").fieldNames() == ["id", "is_deleted", "alert"]


def write_schedule(base, stamp="20240101_020012", start="20240101"):
    folder = base / f"v_{stamp}"
    folder.mkdir(parents=True)
    files = {
        "feed_info": f'feed_start_date,feed_end_date,feed_version,feed_publisher_name,feed_publisher_url,feed_lang,feed_contact_email,feed_id\n'
                     f'{start},20240331,"Winter 2024, version ""D""\nsecond line",Agency,http://x,EN,a@x,id\n',
        "agency": "agency_id,agency_name,agency_url,agency_timezone,agency_lang,agency_phone\n1,A,http://x,America/New_York,EN,1\n",
        "routes": "route_id,agency_id,route_short_name,route_long_name,route_type,route_sort_order\n1,1,One,Long,3,\nRed,1,,Red Line,1,x\n",
        "stops": "stop_id,stop_name,stop_lat,stop_lon,location_type\ns1,Main,42.5,-71.1,0\ns2,Side,,,\n",
        "trips": "trip_id,route_id,service_id,trip_headsign,direction_id,shape_id\nt1,1,wk,North,0,sh\nt2,1,wk,North,0,sh\nt3,1,wk,North,0,sh\n",
        "stop_times": "trip_id,stop_sequence,stop_id,arrival_time,departure_time,timepoint\n"
                      "t1,1,s1,12:00:00,12:00:00,1\nt1,2,s2,12:01:00,12:01:00,\nt2,1,s1,25:00:00,25:00:00,0\nt3,1,s1,10:00:00,10:00:00,0\n",
        "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nwk,1,1,1,1,1,0,0,20240101,20240331\n",
        "calendar_dates": "service_id,date,exception_type,holiday_name\nwk,20240115,2,Holiday\n",
        "shapes": "shape_id,shape_pt_sequence,shape_pt_lat,shape_pt_lon\nsh,2,42.2,-71.2\nsh,1,42.1,-71.1\nsh,x,42.1,-71.1\n",
    }
    for name, body in files.items():
        (folder / f"{name}.txt").write_text("﻿" + body if name in ("stops", "shapes") else body, encoding="utf-8")
    return folder


def test_version_discovery(spark, tmp_path, at):
    assert schedule.find_version(spark, str(tmp_path)) is None
    for stamp in ("20240101_020012", "20240105_010000", "20240105_230000"):
        write_schedule(tmp_path, stamp)
    (tmp_path / "v_draft").mkdir()
    (tmp_path / "v_draft" / "feed_info.txt").write_text("x\n")
    assert schedule.find_version(spark, str(tmp_path)).endswith("v_20240105_230000")
    assert schedule.find_version(spark, str(tmp_path), date(2024, 1, 5)).endswith("v_20240105_010000")
    assert schedule.find_version(spark, str(tmp_path), date(2024, 1, 2)) is None
    newest = schedule.list_versions(spark, str(tmp_path)).orderBy(F.col("name").desc()).first()
    assert newest.collected_at == at("2024-01-05T23:00:00") and newest.collection_date == date(2024, 1, 5)


def test_dimensions_are_typed_and_stamped(spark, tmp_path):
    dims = schedule.build_dimensions(spark, str(write_schedule(tmp_path)))
    assert len(dims) == 8
    info = dims["static_versions"].first()
    assert info.feed_version == 'Winter 2024, version "D"\nsecond line' and info.collection_date == date(2024, 1, 1)
    times = {(r.trip_id, r.stop_sequence): r for r in dims["stop_times"].collect()}
    assert times["t2", 1].departure_seconds == 90000 and times["t1", 2].timepoint is None
    routes = {r.route_id: r for r in dims["routes"].collect()}
    assert routes["1"].route_type == 3 and routes["Red"].route_sort_order is None
    assert routes["Red"].feed_start_date == date(2024, 1, 1) and routes["1"].network_id is None
    week = dims["calendar"].first()
    assert week.wednesday is True and week.sunday is False and week.end_date == date(2024, 3, 31)
    live = schedule.read_live_tables(spark, str(tmp_path / "v_20240101_020012"))
    assert sorted(r.seq for r in live["shapes"].collect()) == [1, 2]
    assert {r.stop_id for r in live["stops"].collect()} == {"s1", "s2"}


def test_replace_days_clears_empty_days(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [date(2024, 1, n) for n in (1, 2, 3)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "d date, n int")
    for _ in range(2):  # a rerun changes nothing
        sinks.replace_days(df, path, "d", days)
        assert spark.read.parquet(path).count() == 3
    sinks.replace_days(df.where("n = 2").withColumn("n", F.lit(9)), path, "d", days[1:])
    got = sorted((r.d, r.n) for r in spark.read.schema(df.schema).parquet(path).collect())
    assert got == [(days[0], 0), (days[2], 9)]


def test_state_survives_an_unfinished_merge(spark, tmp_path):
    state = LatestState(spark, str(tmp_path / "state"), s.FACT_ALERTS_ROUTES, ["entity_id", "route_id", "stop_id"])
    assert state.read().count() == 0

    def batch(stamp, kind):
        return rows(spark, s.FACT_ALERTS_ROUTES, {"entity_id": "a", "route_id": "1", "stop_id": "s",
                                                 "snapshot_timestamp": stamp, "route_type": kind})

    state.merge(batch("2024-01-02T00:00:00", 2))
    dead = tmp_path / "state" / "parts" / "000000000000000-dead"  # a merge that died before its job was committed
    dead.mkdir()
    (dead / "part-0.parquet").write_bytes(b"half")
    state.merge(batch("2024-01-01T00:00:00", 1))
    assert [r.route_type for r in state.read().collect()] == [2]
    state.merge(batch("2024-01-03T00:00:00", 3))
    assert [r.route_type for r in state.read().collect()] == [3]


def touched_routes(spark, *entities, stamp="2024-01-02T00:00:00", kind=3):
    return rows(spark, s.FACT_ALERTS_ROUTES, *[{"entity_id": e, "route_id": "1", "stop_id": "s", "snapshot_timestamp": stamp,
                                               "route_type": kind} for e in entities])


def kinds(state):
    return sorted((r.entity_id, r.route_type) for r in state.read().collect())


def test_merges_from_the_same_state_keep_both(spark, tmp_path, monkeypatch):
    first, second = (LatestState(spark, str(tmp_path / "state"), s.FACT_ALERTS_ROUTES, ["entity_id"]) for _ in range(2))
    first.merge(touched_routes(spark, "a"))
    stale = first.parts()
    first.merge(touched_routes(spark, "b", "a", stamp="2024-01-03T00:00:00", kind=2))
    live = second._live
    seen = iter([stale])  # the second one folds what it saw before the first one's merge and fold
    monkeypatch.setattr(second, "_live", lambda: next(seen, None) or live())
    second.fold()
    second.merge(touched_routes(spark, "c", "a"))
    assert kinds(first) == kinds(second) == [("a", 2), ("b", 2), ("c", 3)]


def test_a_merge_writes_its_batch_only(spark, tmp_path):
    state = LatestState(spark, str(tmp_path / "state"), s.FACT_ALERTS_ROUTES, ["entity_id"], share=100, most=4)
    for day in range(1, 5):
        state.merge(touched_routes(spark, *"abc"[:day], stamp=f"2024-01-{day:02}T00:00:00", kind=day))
        assert len(state.parts()) == day and not (tmp_path / "state" / "covers").exists()
    before = set(state.parts())
    state.merge(touched_routes(spark, "d"))  # one part too many
    folded = state.parts()
    assert len(folded) == 1 and before <= {p.name for p in (tmp_path / "state" / "parts").iterdir()}
    assert kinds(state) == [("a", 4), ("b", 4), ("c", 4), ("d", 3)]
    state.merge(touched_routes(spark, "a", stamp="2024-01-09T00:00:00", kind=9))
    state.fold()  # the parts that the fold before had covered go now, those that it covers itself stay
    there = {p.name for p in (tmp_path / "state" / "parts").iterdir()}
    assert not before & there and set(folded) < there and len(state.parts()) == 1
    assert kinds(state) == [("a", 9), ("b", 4), ("c", 4), ("d", 3)]
    state.fold()
    state.fold()
    assert len(list((tmp_path / "state" / "covers").iterdir())) == 2 and len(kinds(state)) == 4


def test_the_row_stored_first_stays_over_folds(spark, tmp_path):
    state = LatestState(spark, str(tmp_path / "state"), s.FACT_ALERTS_ROUTES, ["entity_id"], share=100)
    for kind in (5, 4, 6):
        state.merge(touched_routes(spark, "a", kind=kind))
        if kind == 4:
            state.fold()
    assert kinds(state) == [("a", 5)]
    state.merge(touched_routes(spark))  # an empty batch changes nothing
    assert kinds(state) == [("a", 5)]


def test_parts_are_folded_when_they_outgrow_the_largest(spark, tmp_path):
    state = LatestState(spark, str(tmp_path / "state"), s.FACT_ALERTS_ROUTES, ["entity_id"])
    for day in range(1, 4):
        state.merge(touched_routes(spark, "a", stamp=f"2024-01-{day:02}T00:00:00", kind=day))
    assert len(state.parts()) == 1 and kinds(state) == [("a", 3)]


def test_recent_lines(spark, tmp_path):
    path = str(tmp_path / "recent")
    df = rows(spark, s.RECENT_SNAPSHOT, {"snapshot_unix": 1704067207, "entity_id": "a", "latitude": 1.5},
              {"snapshot_unix": 1704070800, "entity_id": "b"})
    sinks.write_recent(df, path)
    sinks.write_recent(df, path)
    got = sorted((r.entity_id, str(r.dt), r.hour, r.latitude) for r in read_recent(spark, path).collect())
    assert got == [("a", "2024-01-01", 0, 1.5), ("b", "2024-01-01", 1, None)]
    assert any(f.endswith(".json.gz") for f in os.listdir(f"{path}/dt=2024-01-01/hour=00"))


def test_tables_are_created_once(spark):
    for _ in range(2):
        s.create_tables(spark, "tramline_test")
    assert spark.table("tramline_test.metric_on_time").columns[-1] == "trip_start_date"
    assert len(spark.sql("SHOW TABLES IN tramline_test").collect()) == len(s.TABLES)


def test_nightly_from_files_to_marts(spark, tmp_path):
    feeds, schedules = tmp_path / "rt", tmp_path / "static"
    write_schedule(schedules)
    noon = 1704906000  # 2024-01-10 12:00 Eastern
    for minute in (0, 1, 2):
        snapshot(feeds, "vehicle_positions", 12, minute, lambda m: vehicle(m, f"v{minute}", at=noon + 30 + minute * 60))
        snapshot(feeds, "trip_updates", 12, minute, lambda m: (update(m, "t1", 0), update(m, "x", 1)))
        snapshot(feeds, "alerts", 12, minute, lambda m: alert(m, "a1"))
    snapshot(feeds, "trip_updates", 3, 0, lambda m: update(m, "t1", None, delay=7), day="2024-01-11", stamp=noon + 54000)
    snapshot(feeds, "vehicle_positions", 3, 0, lambda m: vehicle(m, "late"), day="2024-01-11", stamp=noon + 54000)
    snapshot(feeds, "alerts", 3, 0, lambda m: alert(m, "a2"), day="2024-01-11", stamp=noon + 54000)
    warehouse = daily.Warehouse(spark, str(tmp_path / "wh"))
    assert daily.load_schedule(warehouse, str(schedules), None)
    assert not daily.load_schedule(warehouse, str(schedules), date(2024, 1, 2))
    daily.load_raw(warehouse, str(feeds), "vehicle_positions", date(2024, 1, 10), date(2024, 1, 10))
    daily.load_raw(warehouse, str(feeds), "trip_updates", date(2024, 1, 10), date(2024, 1, 10))
    daily.load_raw(warehouse, str(feeds), "alerts", date(2024, 1, 10), date(2024, 1, 10))
    for _ in range(2):  # a repeated night leaves the same tables
        daily.nightly(warehouse, str(feeds), str(schedules), date(2024, 1, 12))
        on_time = warehouse.read("metric_on_time").collect()
        assert [(r.trip_id, r.stop_sequence, r.arrival_delay_seconds, r.is_on_time) for r in on_time] == [("t1", 2, -60, True)]
        updates = {r.trip_id: r for r in warehouse.read("fact_trip_updates").collect()}
        assert updates["t1"].delay == 7 and updates["x"].trip_schedule_rel == "ADDED"
        service = warehouse.read("metric_service_delivered").collect()
        assert [(r.scheduled_trips, r.delivered_trips, r.no_rt_data_trips) for r in service] == [(2, 1, 1)]
        alerts = warehouse.read("metric_alerts_by_day").collect()
        assert [(r.alert_date, r.route_id, r.alert_count, r.severe_count) for r in alerts] == [(date(2024, 1, 10), "1", 1, 1)]
        assert warehouse.read("metric_alerts_by_day_stops").first().stop_name == "Side"
        assert warehouse.read("metric_occupancy_route_hour").agg(F.sum("snapshot_count")).first()[0] == 3
        assert warehouse.read("fact_alerts").count() == 1


def tree(base, days=("2024-01-09", "2024-01-10", "2024-01-11"), hours=(4, 5), minutes=range(12)):
    for day in days:
        for hour in hours:
            for minute in minutes:
                snapshot(base, "trip_updates", hour, minute, lambda m: update(m, "t", 0), day=day)
    return f"{base}/trip_updates"


def test_both_readers_take_the_same_files(spark, tmp_path):
    tree(tmp_path)
    day = date(2024, 1, 10)
    for stride in (1, 5):
        found = [{(r.service_date, r.hour, os.path.basename(r.path), bytes(r.content)) for r in read_snapshot_files(
            spark, str(tmp_path), "trip_updates", day, day, stride, reader).collect()} for reader in ("tree", "spark")]
        assert found[0] == found[1] and len(found[0]) == (24 if stride == 1 else 6)


def test_foreign_days_are_never_listed(tmp_path, monkeypatch):
    root, listed = tree(tmp_path), []

    class Store:
        def __init__(self, store):
            self.store = store

        def get_file_info(self, selector):
            listed.append(os.path.basename(selector.base_dir))
            return self.store.get_file_info(selector)

    opened = snapshot_tree.open_store
    monkeypatch.setattr(snapshot_tree, "open_store", lambda r: (Store(opened(r)[0]), opened(r)[1]))
    options = {"path": root, "first": "2024-01-10", "last": "2024-01-10"}
    planned = snapshot_tree.TreeReader(options).partitions()
    assert listed == ["dt=2024-01-10"] and [f for p in planned for f in p.folders] == [
        (date(2024, 1, 10), h, f"dt=2024-01-10/hour={h:02}") for h in (4, 5)]
    listed.clear()
    reader = snapshot_tree.PushedTreeReader({"path": root})
    kept = snapshot_tree.GreaterThan(("service_date",), date(2024, 1, 10)), snapshot_tree.EqualTo(("hour",), 4)
    assert list(reader.pushFilters(list(kept))) == [kept[1]]
    assert [f[0] for p in reader.partitions() for f in p.folders] == [date(2024, 1, 11)] * 2
    assert set(listed) == {"trip_updates", "dt=2024-01-11"}


def test_tree_days_are_pushed_down(spark, tmp_path):
    root = tree(tmp_path, minutes=(0, 1))
    spark.conf.set(snapshot_tree.PUSHDOWN, "true")
    try:
        files = snapshot_tree.read_tree(spark, root).where(F.col("service_date").isin(date(2024, 1, 9), date(2024, 1, 11)) & (F.col("hour") == 5))
        assert sorted((r.service_date.day, r.hour) for r in files.collect()) == [(9, 5)] * 2 + [(11, 5)] * 2
        assert files.rdd.getNumPartitions() == 4  # the hour folders of two days
    finally:
        spark.conf.unset(snapshot_tree.PUSHDOWN)
    assert snapshot_tree.read_tree(spark, root).count() == 12
    assert snapshot_tree.read_tree(spark, root, slices=3).count() == 12
    assert snapshot_tree.read_tree(spark, f"{root}/none").count() == 0


def test_tree_groups_hours_and_skips_other_files(spark, tmp_path):
    root = tree(tmp_path, hours=range(24), minutes=(0,))
    (tmp_path / "trip_updates/dt=2024-01-09/hour=03/.draft.pb").write_bytes(b"x")
    (tmp_path / "trip_updates/dt=2024-01-09/hour=03/notes.txt").write_bytes(b"x")
    planned = snapshot_tree.TreeReader({"path": root, "partitions": "10"}).partitions()
    assert len(planned) == 9 and sum(len(p.folders) for p in planned) == 72
    assert snapshot_tree.read_tree(spark, root).count() == 72


def test_tree_round_trip(spark, tmp_path):
    files = spark.createDataFrame([(date(2024, 1, 10), 3, "x/a.pb", b"one"), (date(2024, 1, 10), None, "b.pb", b""), (date(2024, 1, 11), 23, "c.pb", b"three")],
                                  snapshot_tree.SCHEMA)
    root = f"file:{tmp_path}/out"
    for _ in range(2):  # a repeated write leaves the same files
        snapshot_tree.write_tree(files, root)
    got = {(r.service_date, r.hour, r.path[len(root):], bytes(r.content)) for r in snapshot_tree.read_tree(spark, root).collect()}
    assert got == {(date(2024, 1, 10), 3, "/dt=2024-01-10/hour=03/a.pb", b"one"), (date(2024, 1, 10), None, "/dt=2024-01-10/b.pb", b""),
                   (date(2024, 1, 11), 23, "/dt=2024-01-11/hour=23/c.pb", b"three")}


def test_raw_days_go_when_their_feed_is_gone(spark, tmp_path):
    feeds = tmp_path / "rt"
    snapshot(feeds, "alerts", 3, 0, lambda m: alert(m, "a"))
    warehouse = daily.Warehouse(spark, str(tmp_path / "wh"))
    daily.load_raw(warehouse, str(feeds), "alerts", date(2024, 1, 10), date(2024, 1, 10))
    assert warehouse.read("raw_alerts").count() == 1
    daily.load_raw(warehouse, str(tmp_path / "nowhere"), "alerts", date(2024, 1, 10), date(2024, 1, 10))
    assert warehouse.read("raw_alerts").count() == 0


def test_a_dimension_file_that_became_empty_empties_its_version(spark, tmp_path):
    write_schedule(tmp_path)
    folder = tmp_path / "v_20240101_020012"
    warehouse = daily.Warehouse(spark, str(tmp_path / "wh"))
    assert daily.load_schedule(warehouse, str(tmp_path)) and warehouse.read("dim_routes").count() > 0
    header = (folder / "routes.txt").read_text().splitlines()[0]
    (folder / "routes.txt").write_text(header + "\n")
    assert daily.load_schedule(warehouse, str(tmp_path))
    assert warehouse.read("dim_routes").count() == 0 and warehouse.read("dim_stops").count() > 0
    assert "route_short_name" in warehouse.read("dim_routes").columns


def test_alert_rows_that_arrived_for_a_range(spark, tmp_path):
    state = LatestState(spark, str(tmp_path / "state"), s.FACT_ALERTS_ROUTES, ["entity_id"])
    first, last = date(2024, 1, 2), date(2024, 1, 3)
    assert state.arrived(first, last).count() == 0
    for stamp in ("2024-01-01T23:59:59", "2024-01-02T00:00:00", "2024-01-03T23:59:59", "2024-01-04T00:00:00"):
        state.merge(touched_routes(spark, stamp, stamp=stamp))
    assert sorted(r.entity_id for r in state.arrived(first, last).collect()) == ["2024-01-02T00:00:00", "2024-01-03T23:59:59"]
