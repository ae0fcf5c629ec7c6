from datetime import date

from builders import rows
from pyspark.sql import functions as F
from test_sources_sinks import alert, snapshot, vehicle

from tramline import schemas as s
from tramline.plans import facts, raw
from tramline.sinks.state import LatestState
from tramline.sources.snapshots import decode_snapshots, read_snapshot_files
from tramline.streaming import jobs, stateful

POSITIONS = "ts timestamp_ntz, vehicle_id string, route_id string, occupancy_percentage int"


def pieces(spark, tmp_path, n=3):
    """The same rows as several files, one micro-batch each."""
    base = spark.range(600).select(
        (F.expr("timestamp_ntz'2024-01-10 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 7).cast("int"), F.lit(0))).alias("ts"),
        (F.col("id") % 20).cast("string").alias("vehicle_id"), (F.col("id") % 5).cast("string").alias("route_id"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 90).cast("int").alias("occupancy_percentage"), "id")
    for i in range(n):
        base.where(F.col("id") % n == i).drop("id").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def same(a, b):
    key = sorted(a.columns)
    return sorted(map(str, a.select(key).collect())) == sorted(map(str, b.select(key).collect()))


def state_of(spark, tmp_path, layout, keys, newest):
    return LatestState(spark, str(tmp_path / "state"), layout, keys, newest=newest)


def test_hourly_stream_equals_batch(spark, tmp_path):
    folder = pieces(spark, tmp_path)
    stream = jobs.with_event_time(jobs.table_stream(spark, folder, files_per_batch=1), "ts", "3 days")
    state = state_of(spark, tmp_path, "hour_start timestamp, route_id string, snapshot_count bigint, report_count bigint, avg_occupancy_pct double, batch bigint",
                     ["hour_start", "route_id"], "batch")
    jobs.updates_to_state(jobs.hourly_occupancy(stream), state, str(tmp_path / "out")).awaitTermination()
    batch = jobs.hourly_occupancy(spark.read.parquet(folder).withColumn("event_time", F.col("ts").cast("timestamp")))
    assert same(state.read().drop("batch"), batch)


def at_times(spark, *rows):
    return spark.createDataFrame(rows, "vehicle_id string, ts string, n long").withColumn("ts", F.to_timestamp_ntz("ts"))


def test_latest_rows_over_arrivals_and_freed_state(spark, tmp_path):
    state = state_of(spark, tmp_path, "vehicle_id string, ts timestamp_ntz, n bigint", ["vehicle_id"], "ts")

    def start():
        stream = jobs.with_event_time(jobs.table_stream(spark, str(tmp_path / "in")), "ts", "1 hour")
        return jobs.updates_to_state(stateful.latest_rows(stream, "vehicle_id", "ts", "n", 3), state, str(tmp_path / "out"), keyed=True)

    parts = [at_times(spark, ("a", "2024-01-01 10:00:00", 1), ("a", "2024-01-01 10:00:00", 10), ("a", "2024-01-01 09:59:59", 99), ("b", "2024-01-01 12:00:00", 2)),
             at_times(spark, ("b", "2024-01-02 12:00:00", 3), ("c", "2024-01-02 13:00:00", 4), ("b", "2024-01-02 11:30:00", 5)),
             at_times(spark, ("c", "2024-01-09 00:00:00", 6)), at_times(spark, ("a", "2024-01-09 01:00:00", 7))]
    progress = jobs.run_arrivals([{str(tmp_path / "in"): p.coalesce(1)} for p in parts], start)
    assert sorted((r.vehicle_id, r.n) for r in state.read().collect()) == [("a", 7), ("b", 3), ("c", 6)]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert max(held) > held[-1]  # silent vehicles have left the state, their rows stay in the table


def trip_rows(spark, *rows):
    return spark.createDataFrame(rows, "trip_start_date date, trip_id string, snapshot string, entity_id string").select(
        "trip_start_date", "trip_id", F.to_timestamp_ntz("snapshot").alias("snapshot_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("ingested_at"), "entity_id")


def test_final_trips_wait_two_days_and_drop_late_rows(spark, tmp_path, day):
    def start():
        stream = jobs.with_event_time(jobs.table_stream(spark, str(tmp_path / "in")), "snapshot_timestamp", "1 hour")
        return jobs.append_to_table(stateful.final_trips(stream), str(tmp_path / "out"), keyed=True)

    def arrive(*rows):
        progress = jobs.run_arrivals([{str(tmp_path / "in"): trip_rows(spark, *rows).coalesce(1)}], start)
        return jobs.rows_dropped(progress), sorted((r.trip_id, r.entity_id) for r in spark.read.parquet(str(tmp_path / "out/rows")).collect())

    first, second, later = day("2024-01-01"), day("2024-01-02"), day("2024-01-05")
    assert arrive((first, "t", "2024-01-01 08:00:00.000001", "1"), (first, "t", "2024-01-01 08:00:00.000002", "0"), (first, "u", "2024-01-01 09:00:00", "2")) == (0, [])
    assert arrive((first, "t", "2024-01-02 01:00:00", "3"), (second, "t", "2024-01-02 08:00:00", "4"), (first, "u", "2024-01-01 08:30:00", "5")) == (0, [])
    # Both trips of the first day are over; the row of "u" that comes now would be newer but is too late.
    assert arrive((later, "v", "2024-01-05 08:00:00", "6")) == (0, [("t", "3"), ("t", "4"), ("u", "2")])
    assert arrive((first, "u", "2024-01-02 05:00:00", "7"), (later, "v", "2024-01-05 07:59:59", "8")) == (1, [("t", "3"), ("t", "4"), ("u", "2")])
    assert arrive((day("2024-01-09"), "w", "2024-01-09 08:00:00", "9"))[1] == [("t", "3"), ("t", "4"), ("u", "2"), ("v", "6")]


def test_joined_streams_keep_lone_rows_and_free_their_state(spark, tmp_path):
    def side(name, time):
        return jobs.table_stream(spark, str(tmp_path / name)).withColumn(time, F.col("ts").cast("timestamp")).withWatermark(time, "1 hour").drop("ts")

    def start():
        right = side("r", "other_at").withColumnRenamed("n", "m")
        return jobs.append_to_table(stateful.join_intervals(side("l", "at"), right, ["vehicle_id"], "at", "other_at", "1 hour", "0 hours"), str(tmp_path / "out"))

    parts = [(at_times(spark, ("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-01 10:00:00", 2)), at_times(spark, ("a", "2024-01-01 08:59:59", 11))),
             (at_times(spark, ("a", "2024-01-01 11:00:00", 3)), at_times(spark, ("a", "2024-01-01 10:00:00", 12), ("b", "2024-01-01 10:00:01", 13))),
             (at_times(spark, ("z", "2024-01-03 00:00:00", 4)), at_times(spark, ("y", "2024-01-03 00:00:00", 14)))]
    progress = jobs.run_arrivals([{str(tmp_path / "l"): a.coalesce(1), str(tmp_path / "r"): b.coalesce(1)} for a, b in parts], start)
    got = sorted((r.vehicle_id, r.n, r.m) for r in spark.read.parquet(str(tmp_path / "out/rows")).collect())
    assert sorted(got, key=str) == [("a", 1, 12), ("a", 3, 12), ("b", 2, None)]
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 2  # only the newest row of each side


def test_versions_loaded_meanwhile_count_from_the_next_batch(spark, tmp_path, day):
    dims = str(tmp_path / "dims")
    version = lambda d, name: spark.createDataFrame([(day(d), "1", name)], "feed_start_date date, route_id string, route_name string")
    rows_on = lambda *days: spark.createDataFrame([(day(d), "1") for d in days], "trip_start_date date, route_id string")

    def start():
        return jobs.enrich_as_of(jobs.table_stream(spark, str(tmp_path / "in")), lambda: spark.read.parquet(dims).select("feed_start_date"),
                                 lambda: spark.read.parquet(dims), str(tmp_path / "out"))

    jobs.run_arrivals([{dims: version("2024-01-01", "old"), str(tmp_path / "in"): rows_on("2023-12-31", "2024-01-05")},
                       {dims: version("2024-01-08", "new"), str(tmp_path / "in"): rows_on("2024-01-07", "2024-01-08", "2024-01-20")}], start)
    got = sorted((r.trip_start_date.day, r.route_name) for r in spark.read.parquet(str(tmp_path / "out/rows/batch=*")).collect())
    assert got == [(5, "old"), (7, "old"), (8, "new"), (20, "new")]


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    folder = pieces(spark, tmp_path)
    stream = jobs.with_event_time(jobs.table_stream(spark, folder, files_per_batch=1), "ts", "3 days")
    once = jobs.drop_repeats(stream, ["vehicle_id"]).select("vehicle_id")
    jobs.append_to_table(once, str(tmp_path / "out")).awaitTermination()
    assert sorted(r.vehicle_id for r in spark.read.parquet(str(tmp_path / "out/rows")).collect()) == sorted(str(i) for i in range(20))


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    def arrive(n, *stamps):
        spark.createDataFrame([(t,) for t in stamps], "t string").select(F.to_timestamp_ntz("t").alias("ts")).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))
        stream = jobs.with_event_time(jobs.table_stream(spark, str(tmp_path / "in"), files_per_batch=1), "ts", "1 hour")
        counts = stream.groupBy(F.window("event_time", "1 hour").alias("w")).agg(F.count("*").alias("n")).select(
            F.hour("w.start").alias("h"), "n")
        jobs.append_to_table(counts, str(tmp_path / "out")).awaitTermination()

    arrive(1, "2024-01-10 01:10:00", "2024-01-10 01:20:00")
    arrive(2, "2024-01-10 05:00:00")
    arrive(3, "2024-01-10 01:30:00", "2024-01-10 09:00:00")  # 01:30 is too late
    got = {r.h: r.n for r in spark.read.parquet(str(tmp_path / "out/rows")).collect()}
    assert got == {1: 2, 5: 1}


def test_snapshot_stream_feeds_the_raw_table(spark, tmp_path):
    base = tmp_path / "rt"
    for minute in range(3):
        snapshot(base, "vehicle_positions", 12, minute, lambda m: vehicle(m, f"v{minute}"))
    files = jobs.snapshot_stream(spark, str(base), "vehicle_positions", files_per_batch=1)
    table = raw.raw_vehicle_positions(decode_snapshots(files, "vehicle_positions")).drop("multi_carriage_details", "ingested_at")
    jobs.append_to_table(table, str(tmp_path / "out")).awaitTermination()
    batch = raw.raw_vehicle_positions(decode_snapshots(
        read_snapshot_files(spark, str(base), "vehicle_positions", date(2024, 1, 10), date(2024, 1, 10)), "vehicle_positions"))
    assert same(spark.read.parquet(str(tmp_path / "out/rows")), batch.drop("multi_carriage_details", "ingested_at"))


def test_alert_stream_keeps_the_newest_state(spark, tmp_path):
    base = tmp_path / "rt"
    for minute in (2, 0, 1):
        snapshot(base, "alerts", 12, minute, lambda m: alert(m, "a", severity=2 + minute))
    versions = rows(spark, "feed_start_date DATE", {"feed_start_date": "2024-01-01"})
    state = LatestState(spark, str(tmp_path / "state"), s.FACT_ALERTS, ["entity_id"])
    stream = decode_snapshots(jobs.snapshot_stream(spark, str(base), "alerts", files_per_batch=1), "alerts")
    jobs.merge_into_state(stream, lambda b: facts.fact_alerts(raw.raw_alerts(b), versions), state, str(tmp_path / "run")).awaitTermination()
    assert [r.severity_level for r in state.read().collect()] == ["SEVERE"]


def test_enrichment_and_lateness_rules(spark):
    df = rows(spark, "service_date DATE, trip_start_date DATE, hour INT, is_deleted BOOLEAN, route_id STRING, stop_id STRING",
              {"service_date": "2024-01-10", "trip_start_date": "2024-01-10", "hour": 9, "route_id": "1", "stop_id": "x"},
              {"service_date": "2024-01-11", "trip_start_date": "2024-01-10", "hour": 6, "route_id": "1", "stop_id": "x"},
              {"service_date": "2024-01-10", "trip_start_date": "2024-01-10", "hour": 9, "is_deleted": True})
    kept = jobs.on_time_arrivals(df)
    assert kept.count() == 1
    names = spark.createDataFrame([("1", "One")], "route_id string, route_name string")
    stops = spark.createDataFrame([("s", "Main")], "stop_id string, stop_name string")
    row = jobs.enrich(kept, names, stops).first()
    assert (row.route_name, row.stop_name) == ("One", "")


def test_stream_queries_read_tables_of_several_files(spark, tmp_path):
    """Every stream query gives the same rows when its tables are folders of part files."""
    from pathlib import Path

    from tramline.demo import queries as registered

    sf = Path("/root/testdata/sf0.001")
    for file in sf.iterdir():
        if file.stem in ("events", "lineitem", "orders"):
            spark.read.parquet(str(file)).repartition(3).write.parquet(str(tmp_path / file.name))
        else:
            (tmp_path / file.name).symlink_to(file)
    names = [n for n in registered.QUERIES if n.startswith("stream_")]
    assert len(names) == 11
    for name in names:
        one, many = (sorted(map(str, registered.QUERIES[name](spark, str(d)).collect())) for d in (sf, tmp_path))
        assert one == many, name
