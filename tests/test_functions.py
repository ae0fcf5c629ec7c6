from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tramline.functions import rates, text, times


def values(spark, column, rows, schema="v string"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(column.alias("out")).collect()]


def test_gtfs_seconds_takes_hours_beyond_a_day(spark):
    got = values(spark, times.gtfs_seconds("v"), ["25:10:00", "", None, "00:00:59", "bad", "7:05:00"])
    assert got == [90600, None, None, 59, None, 25500]


def test_gtfs_clock_is_the_inverse(spark):
    assert values(spark, times.gtfs_clock("v"), [0, 90600, 359999], "v bigint") == ["00:00:00", "25:10:00", "99:59:59"]


def test_gtfs_date_is_lenient(spark, day):
    assert values(spark, times.gtfs_date("v"), ["20240229", "", None, "2024-02-29"]) == [
        day("2024-02-29"), None, None, None]


def test_eastern_time_follows_clock_changes(spark, at):
    # 2024-03-10 06:59:59Z / 07:00:00Z and 2024-11-03 05:59:59Z / 06:00:00Z
    got = values(spark, times.local_wall_time("v"), [1710053999, 1710054000, 1730613599, 1730613600, None], "v bigint")
    assert got == [at("2024-03-10T01:59:59"), at("2024-03-10T03:00:00"), at("2024-11-03T01:59:59"),
                   at("2024-11-03T01:00:00"), None]


def test_wall_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(1710054000,)], "v bigint").select(
        times.local_wall_time("v").cast("string"), times.wall_epoch(times.utc_wall_time("v")), times.iso_utc("v"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert tuple(df.first()) == ("2024-03-10 03:00:00", 1710054000, "2024-03-10T07:00:00+00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_minute_boundaries_are_counted_not_elapsed_minutes(spark, at):
    df = spark.createDataFrame([(at("2024-01-01T10:00:59"), at("2024-01-01T10:02:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    row = df.select(times.minute_boundaries("a", "b").alias("m"), times.boundary_hours("a", "b").alias("h")).first()
    assert row.m == 2 and row.h == 2 / 60.0


def test_seconds_since_midnight_passes_a_day(spark, at, day):
    df = spark.createDataFrame([(at("2024-01-02T00:10:05"), day("2024-01-01"))], "t timestamp_ntz, d date")
    assert df.select(times.seconds_since_midnight("t", "d")).first()[0] == 87005


def test_age_is_never_negative_and_missing_for_zero(spark):
    assert values(spark, times.age_seconds("v", 1000), [910, 1000, 1200, 0, None], "v bigint") == [90, 0, 0, None, None]


def test_stamps(spark):
    df = spark.createDataFrame([(1704067207,), (0,)], "v bigint")
    rows = df.select(times.iso_utc("v"), times.iso_zulu("v"), times.compact_zulu("v")).collect()
    assert tuple(rows[0]) == ("2024-01-01T00:00:07+00:00", "2024-01-01T00:00:07Z", "20240101T000007Z")
    assert rows[1][0] is None


def test_bus_routes(spark):
    ids = ["1", "SL1", "CT2", "Red", "CR-Foo", "", None, "Green-B", "Boat-F1", "1A", " 39 "]
    assert values(spark, text.is_bus_route("v"), ids) == [
        True, True, True, False, False, False, False, False, False, False, False]
    assert values(spark, text.is_bus_route("v", trim=True), ids)[-1] is True


def test_route_orders(spark):
    df = spark.createDataFrame([(r,) for r in ["CT2", "10", "SL4", "9", "Zoo", "SL1", "1A"]], "v string")
    rider = [r.v for r in df.orderBy(text.route_sort_key("v")).collect()]
    board = [r.v for r in df.orderBy(*text.route_name_order("v")).collect()]
    assert rider == ["9", "10", "SL1", "SL4", "CT2", "1A", "Zoo"]
    assert board == ["9", "10", "1A", "CT2", "SL1", "SL4", "Zoo"]


def test_schedule_relation_defaults(spark):
    assert values(spark, text.schedule_relation("v"), [" ", "", None, "CANCELED", " ADDED"]) == [
        "SCHEDULED", "SCHEDULED", "SCHEDULED", "CANCELED", "ADDED"]


TEXTS = "t STRUCT<translation: ARRAY<STRUCT<text: STRING, language: STRING>>>"


def test_translations(spark):
    rows = [
        ((([("hola", "es"), ("hi", "EN-us")]),),), ((([("hola", "es")]),),), ((([]),),), ((([("hey", None)]),),), (None,),
        ((([("hola", "es"), ("plain", "")]),),),
    ]
    df = spark.createDataFrame(rows, TEXTS)
    got = df.select(text.rider_text("t"), text.first_translation("t")).collect()
    assert [r[0] for r in got] == ["hi", "hola", "", "hey", "", "plain"]
    assert [r[1] for r in got] == ["hola", "hola", None, "hey", None, "hola"]


def test_enum_labels(spark):
    labels = {0: "A", 1: "B"}
    assert values(spark, text.enum_label("v", labels), ["0", "7", None]) == ["A", "7", None]
    assert values(spark, text.enum_label("v", labels, "NONE"), ["1", "7", None]) == ["B", "NONE", "NONE"]


def test_not_deleted(spark):
    assert values(spark, text.not_deleted("v"), [None, False, True], "v boolean") == [True, True, False]


def test_on_time_bounds(spark):
    delays = [-151, -150, 300, 301, None]
    assert values(spark, rates.is_on_time(F.col("v")), delays, "v int") == [False, True, True, False, False]
    assert values(spark, rates.is_early(F.col("v")), delays, "v int") == [True, False, False, False, None]
    assert values(spark, rates.is_late(F.col("v")), delays, "v int") == [False, False, False, True, None]


def test_percentages_have_the_digits_of_fixed_point_division(spark):
    pairs = [(n, d) for d in (1, 3, 7, 64, 128, 333, 997, 40_000, 1_999_999) for n in (0, 1, d // 3, d // 2, d)]
    pairs += [(12_345, 100_000), (1_234_499_6, 100_000_000), (0, 0)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = df.select(rates.count_share_pct(F.col("n"), F.col("d")), rates.pct(F.col("n"), F.col("d"))).collect()

    def digits(x, n):
        return x.quantize(Decimal(1).scaleb(-n), ROUND_HALF_UP)

    for (n, d), row in zip(pairs, got):
        if d == 0:
            assert row[0] is None and row[1] is None
            continue
        share = digits(digits(Decimal(n) / Decimal(d), 6) * 100, 2)
        assert row[0] == float(share), (n, d)
        assert row[1] == float(digits(Decimal(n * 100) / Decimal(d), 2)), (n, d)


def test_mph_rounds_half_even(spark):
    assert values(spark, rates.mph(F.col("v")), [0.0, 10.0, None], "v double") == [0.0, 22.4, None]


def test_weighted_mean_counts_silent_rows_only_when_asked(spark):
    df = spark.createDataFrame([(10.0, 2), (None, 6), (40.0, 2)], "v double, n bigint")
    row = df.agg(rates.weighted_mean(F.col("v"), F.col("n"), over_reported=True).alias("a"),
                 rates.weighted_mean(F.col("v"), F.col("n")).alias("b")).first()
    assert row.a == pytest.approx(25.0) and row.b == pytest.approx(10.0)
