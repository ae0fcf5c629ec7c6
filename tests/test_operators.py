from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tramline.operators import checks
from tramline.operators.joins import hot_keys, join_hot, left_join_null_safe
from tramline.operators.latest import first_per_key
from tramline.operators.merge import merge_latest
from tramline.operators.nested import explode_array, ordered_lines
from tramline.operators.sampling import every_nth
from tramline.operators.versions import join_version, link_version, version_on


def tuples(df, *columns):
    rows = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.fixture
def versions(spark, day):
    return spark.createDataFrame([(day("2024-03-01"),), (day("2024-01-01"),), (day("2024-02-01"),)],
                                 "feed_start_date date")


def test_version_link_is_as_of(spark, versions, day):
    days = ["2023-12-31", "2024-01-01", "2024-01-31", "2024-02-01", "2024-02-29", "2024-03-01", "2030-01-01"]
    df = spark.createDataFrame([(day(d),) for d in days], "d date")
    got = dict(tuples(link_version(df, versions, "d", required=False)))
    want = [None, "2024-01-01", "2024-01-01", "2024-02-01", "2024-02-01", "2024-03-01", "2024-03-01"]
    assert got == {day(d): v and day(v) for d, v in zip(days, want)}
    assert link_version(df, versions, "d").count() == 6
    assert link_version(df, versions.where("feed_start_date = '2024-02-01'"), "d").count() == 4
    assert link_version(df, versions.limit(0), "d").count() == 0


def test_version_on_one_day(spark, versions, day):
    got = spark.range(1).select(version_on(versions, day("2024-02-10")), version_on(versions, day("2020-01-01"))).first()
    assert tuple(got) == (day("2024-02-01"), None)


def test_version_join_needs_both_keys(spark, day):
    facts = spark.createDataFrame([("1", day("2024-01-01")), ("1", day("2024-02-01"))], "route_id string, static_version_date date")
    dim = spark.createDataFrame([("1", "one", day("2024-02-01"))], "route_id string, name string, feed_start_date date")
    assert tuples(join_version(facts, dim, ["route_id"], ["name"]), "static_version_date", "name") == [(day("2024-02-01"), "one")]


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    top = first_per_key(df, ["k"], [F.col("v").desc()], n=2, rank_as="place")
    assert tuples(top.where("k = 0")) == [(0, 987, 2), (0, 994, 1)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


LOADS = [
    [("a", 1, "a1"), ("b", 5, "b5")],
    [("a", 3, "a3"), ("c", 2, "c2")],
    [("a", 2, "a2"), ("b", 4, "b4"), ("c", 2, "c2 again")],
]


def _load(spark, rows, at):
    return spark.createDataFrame([(k, at(f"2024-01-0{n}T00:00:00"), v) for k, n, v in rows],
                                 "entity_id string, snapshot_timestamp timestamp_ntz, v string")


def test_merge_keeps_the_newest_in_any_order(spark, at):
    for order in permutations(range(3)):
        state = _load(spark, [], at)
        for i in (*order, order[0]):
            state = merge_latest(state, _load(spark, LOADS[i], at), ["entity_id"])
        got = {r.entity_id: r.v for r in state.collect()}
        assert got["a"] == "a3" and got["b"] == "b5"
        # Equal stamps: the row stored first stays.
        assert got["c"] == ("c2" if order.index(1) < order.index(2) else "c2 again")


def test_merge_ignores_older_and_equal(spark, at):
    stored = _load(spark, [("a", 5, "stored")], at)
    for n, want in ((4, "stored"), (5, "stored"), (6, "batch")):
        merged = merge_latest(stored, _load(spark, [("a", n, "batch")], at), ["entity_id"])
        assert [r.v for r in merged.collect()] == [want]


def test_hot_join_equals_join(spark):
    many = spark.range(3000).select(F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("m"))
    few = spark.range(200).select((F.col("id") % 60).alias("k"), F.col("id").alias("f"))
    assert [r.k for r in hot_keys(many, ["k"]).collect()] == [0]
    for how in ("inner", "left"):
        assert tuples(join_hot(many, few, ["k"], how), "k", "m", "f") == tuples(
            many.join(few, ["k"], how), "k", "m", "f")
    parts = join_hot(many, few, ["k"]).where("k = 0").select(F.col("m"))
    assert parts.count() == many.where("k = 0").count() * few.where("k = 0").count()


def test_null_safe_left_join(spark):
    left = spark.createDataFrame([("1", 0), ("1", None), ("2", None)], "r string, d int")
    right = spark.createDataFrame([("1", None, 7), ("2", 0, 9)], "r string, d int, n int")
    assert tuples(left_join_null_safe(left, right, ["r", "d"]), "r", "d", "n") == [("1", 0, None), ("1", None, 7), ("2", None, None)]


def test_every_nth_counts_across_buckets(spark):
    df = spark.range(103).select((F.col("id") % 2).alias("g"), F.col("id"))
    got = every_nth(df, ["g"], F.floor(F.col("id") / 10), [F.col("id").asc()], 5)
    evens, odds = list(range(0, 103, 2)), list(range(1, 103, 2))
    assert sorted(r.id for r in got.collect()) == sorted(evens[::5] + odds[::5])
    assert every_nth(df, ["g"], F.lit(0), [F.col("id")], 1) is df


def test_explode_keeps_index_and_skips_empty(spark):
    df = spark.createDataFrame([("a", [5, 6]), ("b", []), ("c", None)], "k string, xs array<int>")
    assert tuples(explode_array(df, "xs", ["k"], "x", index="i")) == [("a", 0, 5), ("a", 1, 6)]


def test_lines_are_ordered_across_chunks(spark):
    points = spark.range(5000).select(F.lit("s").alias("shape_id"), F.col("id").cast("int").alias("seq"),
                                      F.col("id").cast("double").alias("lon"), F.lit(1.0).alias("lat"))
    line = ordered_lines(points.orderBy(F.rand(1)), ["shape_id"], chunk=64).first()
    assert [p[0] for p in line.coordinates] == [float(i) for i in range(5000)]


def test_constraint_report(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "k string, v int")
    assert tuples(checks.constraint_report(df, ["k"], ["k", "v"])) == [("not null k", 0), ("not null v", 1), ("unique k", 1)]
    parent = spark.createDataFrame([("a",)], "id string")
    assert tuples(checks.orphans(df, parent, "k", "id")) == [("b", 1)]
