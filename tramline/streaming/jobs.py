"""Streaming transformations and the ways to run them.

Transformations take and return streaming DataFrames and also run on batch
ones, which is how they are compared. State is keyed by entity or by hour and
route and bounded by a watermark or by the number of live entities.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline.functions.text import not_deleted
from tramline.functions.times import age_seconds
from tramline.operators.versions import link_version
from tramline.plans.facts import OVERNIGHT_LAST_HOUR
from tramline.sinks.state import LatestState
from tramline.streaming.stateful import with_keyed_state


# Fixed value: the layout of Spark's binary file source.
BINARY_FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"

# ---------------------------------------------------------------- sources


def snapshot_stream(spark: SparkSession, base: str, feed: str, files_per_batch: int = 1000) -> DataFrame:
    """New snapshot files as they land: (service_date, hour, path, content), ready to be decoded."""
    files = (
        spark.readStream.format("binaryFile").schema(BINARY_FILES).option("pathGlobFilter", "*.pb")
        .option("maxFilesPerTrigger", files_per_batch).load(f"{base.rstrip('/')}/{feed}")
    )
    day = F.regexp_extract("path", r"dt=(\d{4}-\d{2}-\d{2})", 1)
    hour = F.regexp_extract("path", r"hour=(\d{2})", 1)
    return files.select(F.try_to_date(day).alias("service_date"), hour.try_cast("int").alias("hour"),
                        "path", "content")


def table_stream(spark: SparkSession, folder: str, pattern: str = "*.parquet",
                 files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a folder, with the schema its files have now.

    ``pattern`` picks files of the folder by name; the name of a table that is a folder of part
    files streams that folder.
    """
    named = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{pattern}")
    if "*" not in pattern and named.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(named).isDirectory():
        folder, pattern = named.toString(), "*.parquet"
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )


# ---------------------------------------------------------------- transformations


def with_event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermark on a wall-time column; adds ``event_time``, the instant form that watermarks need."""
    return df.withColumn("event_time", F.col(column).cast("timestamp")).withWatermark("event_time", delay)


def hourly_occupancy(positions: DataFrame) -> DataFrame:
    """Snapshots, reports and mean occupancy by hour and route (event time from ``with_event_time``)."""
    return (
        positions.groupBy(F.window("event_time", "1 hour").alias("w"), "route_id")
        .agg(
            F.count("*").alias("snapshot_count"),
            F.count("occupancy_percentage").alias("report_count"),
            F.avg("occupancy_percentage").alias("avg_occupancy_pct"),
        )
        .select(F.col("w.start").alias("hour_start"), "route_id", "snapshot_count", "report_count",
                "avg_occupancy_pct")
    )


def drop_repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First arrival per key within the watermark delay; a batch keeps one row per key."""
    return df.dropDuplicatesWithinWatermark(list(keys)) if df.isStreaming else df.dropDuplicates(list(keys))


def on_time_arrivals(positions: DataFrame) -> DataFrame:
    """Positions within the accepted lateness: own day, or next day up to 05:59."""
    same_day = F.col("service_date") == F.col("trip_start_date")
    overnight = (F.col("service_date") == F.date_add("trip_start_date", 1)) & F.col("hour").between(
        0, OVERNIGHT_LAST_HOUR)
    return positions.where(not_deleted() & (same_day | overnight))


def enrich(positions: DataFrame, routes: DataFrame, stops: DataFrame) -> DataFrame:
    """Route and stop names from schedule tables; a missing name is ''."""
    return (
        positions.join(routes.select("route_id", "route_name"), "route_id", "left")
        .join(stops.select("stop_id", "stop_name"), "stop_id", "left")
        .withColumns({c: F.coalesce(c, F.lit("")) for c in ("route_name", "stop_name")})
    )


def feed_lag(entities: DataFrame, as_of: Column | int) -> DataFrame:
    """Newest stamp seen and its age, for one batch."""
    return entities.agg(F.max("feed_timestamp").alias("feed_timestamp")).withColumn(
        "feed_age_seconds", age_seconds("feed_timestamp", as_of))


# ---------------------------------------------------------------- running


def append_to_table(stream: DataFrame, folder: str, available_now: bool = True, keyed: bool = False):
    """Append-mode stream into Parquet, exactly once; returns the started query. ``keyed`` streams have timers."""
    writer = _triggered(stream.writeStream.outputMode("append").format("parquet")
                        .option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/progress"), available_now)
    return with_keyed_state(writer) if keyed else writer.start()


def updates_to_state(stream: DataFrame, state: LatestState, folder: str, available_now: bool = True, keyed: bool = False):
    """Update-mode stream: the changed rows of every batch are merged into a latest-wins table.

    Where the table goes by ``batch``, rows get their batch's number, so the newest batch wins and a replay changes
    nothing. ``keyed`` streams have timers.
    """
    def write(batch: DataFrame, number: int) -> None:
        state.merge(batch.withColumn("batch", F.lit(number).cast("long")) if state.newest == "batch" else batch)

    return _foreach(stream, "update", write, folder, available_now, keyed)


def merge_into_state(stream: DataFrame, prepare: Callable[[DataFrame], DataFrame], state: LatestState,
                     folder: str, available_now: bool = True):
    """Each batch, after ``prepare``, is merged into a latest-wins table; replays change nothing."""
    return _foreach(stream, "append", lambda batch, _: state.merge(prepare(batch)), folder, available_now)


def enrich_as_of(stream: DataFrame, versions: Callable[[], DataFrame], routes: Callable[[], DataFrame], folder: str,
                 available_now: bool = True):
    """Positions with the route name of the schedule version that was in force on their day.

    ``versions`` and ``routes`` are read anew for every batch, so a version loaded while the stream runs counts from the next
    batch on; a rerun batch replaces its own rows.
    """
    def write(batch: DataFrame, number: int) -> None:
        linked = link_version(batch, versions(), "trip_start_date")
        names = routes().select(F.col("feed_start_date").alias("static_version_date"), "route_id", "route_name")
        rows = linked.join(names, ["static_version_date", "route_id"], "left").withColumn("route_name", F.coalesce("route_name", F.lit("")))
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    return _foreach(stream, "append", write, folder, available_now)


def run_arrivals(parts: Sequence[dict[str, DataFrame]], start: Callable[[], StreamingQuery]) -> list[dict]:
    """Appends each part's tables to their folders and lets the stream take what has arrived; the progress of all batches.

    Every arrival is one batch, and one without data after it when the watermark has moved.
    """
    progress = []
    for part in parts:
        for folder, rows in part.items():
            rows.write.mode("append").parquet(folder)
        running = start()
        running.awaitTermination()
        progress += [json.loads(p.json) for p in running.recentProgress]
    return progress


def rows_dropped(progress: list[dict]) -> int:
    """Rows that came behind the watermark, over all stateful operators and batches."""
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])


def _foreach(stream: DataFrame, mode: str, write: Callable, folder: str, available_now: bool, keyed: bool = False):
    writer = _triggered(stream.writeStream.outputMode(mode).foreachBatch(write)
                        .option("checkpointLocation", f"{folder}/progress"), available_now)
    return with_keyed_state(writer) if keyed else writer.start()


def _triggered(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
