"""Idempotent Parquet writes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tramline.schemas import RECENT_SNAPSHOT, conform

def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace exactly the partitions that ``df`` has rows for; others stay.

    Rows are gathered by partition so that a partition gets few files; adaptive
    execution splits the large ones over several tasks. A rerun writes the same
    partitions again. Spark moves the new files into place when the job
    commits, so a lost executor costs only its tasks.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).parquet(path)
    )


def replace_days(df: DataFrame, path: str, column: str, days: Sequence[date]) -> list[date]:
    """Replace the given days, also those for which ``df`` has no rows any more.

    This is delete-then-insert by day: rows of other days in ``df`` are not
    written, and a day without rows ends up empty. Gives the days without rows.
    """
    wanted = df.where(F.col(column).isin(list(days)))
    written = Observation()
    replace_partitions(wanted.observe(written, F.collect_set(F.col(column).cast("string")).alias("days")), path, [column])
    try:
        filled = set(written.get["days"])
    except Py4JJavaError:  # nothing is measured where Spark knows beforehand that there are no rows
        filled = set()
    empty = [d for d in days if d.isoformat() not in filled]
    clear_days(df.sparkSession, path, column, empty)
    hadoop = df.sparkSession._jvm.org.apache.hadoop.fs
    for day in empty:
        folder = hadoop.Path(f"{path.rstrip('/')}/{column}={day.isoformat()}")
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).mkdirs(folder)
    return empty


def clear_days(spark: SparkSession, path: str, column: str, days: Sequence[date]) -> None:
    """Deletes the folders of the given days, whatever lies below them."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for day in days:
        folder = hadoop.Path(f"{path.rstrip('/')}/{column}={day.isoformat()}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_dimensions(tables: dict[str, DataFrame], base: str) -> None:
    """Replace one schedule version in each dimension table, also where its file has no rows any more."""
    start = tables["static_versions"].agg(F.min("feed_start_date").alias("start")).first()["start"]
    for name, df in tables.items():
        path = f"{base.rstrip('/')}/dim_{name}"
        if start is None:
            replace_partitions(df, path, ["feed_start_date"])
        elif replace_days(df, path, "feed_start_date", [start]):
            # An empty file keeps the table's columns known.
            df.limit(0).drop("feed_start_date").write.mode("overwrite").parquet(f"{path}/feed_start_date={start.isoformat()}")


def write_recent(rows: DataFrame, path: str) -> None:
    """Recent-snapshot rows as gzip JSON lines by UTC day and hour; a rerun replaces its hours."""
    at = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("snapshot_unix").cast("decimal(18,6)"))
    stamped = conform(rows, RECENT_SNAPSHOT).withColumns({
        "dt": F.to_date(at), "hour": F.lpad(F.hour(at).cast("string"), 2, "0"),
    })
    (
        stamped.hint("rebalance", F.col("dt"), F.col("hour")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "hour").option("compression", "gzip").option("ignoreNullFields", False).json(path)
    )
