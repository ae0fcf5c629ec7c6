"""Linking rows to the schedule version in force on a date.

A version is named by its ``feed_start_date`` and holds until the day before
the next one. There is at most one version per calendar day, so everything
built from the version dates alone is bounded by the calendar (about 3,650
rows for ten years) however large the fact tables are. That is the size proof
behind the one explicit broadcast below.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def version_on(versions: DataFrame, day: date | Column) -> Column:
    """Scalar: newest ``feed_start_date`` on or before ``day``, NULL when there is none."""
    day = day if isinstance(day, Column) else F.lit(day)
    return (
        versions.where(F.col("feed_start_date") <= day)
        .agg(F.max("feed_start_date")).scalar()
    )


def version_calendar(versions: DataFrame) -> DataFrame:
    """One row per day of every closed version: (day, version)."""
    starts = versions.where(F.col("feed_start_date").isNotNull()).agg(
        F.sort_array(F.collect_set("feed_start_date")).alias("start")
    )
    ranges = (
        starts.withColumn("next", F.slice("start", F.lit(2), F.greatest(F.size("start"), F.lit(1))))
        .select(F.inline(F.arrays_zip("start", "next")))
        .where(F.col("next").isNotNull())
    )
    return ranges.select(
        F.explode(F.sequence(F.col("start"), F.date_sub("next", 1))).alias("__day"),
        F.col("start").alias("__closed_version"),
    )


def link_version(df: DataFrame, versions: DataFrame, day: str,
                 name: str = "static_version_date", required: bool = True) -> DataFrame:
    """Add the version in force on ``df[day]`` as column ``name``.

    Closed versions are looked up by day in a broadcast calendar; days from the
    newest version on take that version. Rows before the first version get NULL
    and are dropped when ``required`` (the column is NOT NULL in fact tables).
    """
    newest = versions.agg(F.max("feed_start_date")).scalar()
    calendar = F.broadcast(version_calendar(versions))
    linked = df.join(calendar, F.col(day) == F.col("__day"), "left").withColumn(
        name, F.when(F.col(day) >= newest, newest).otherwise(F.col("__closed_version"))
    ).drop("__day", "__closed_version")
    return linked.where(F.col(name).isNotNull()) if required else linked


def join_version(facts: DataFrame, dim: DataFrame, on: list[str], columns: list[str],
                 how: str = "inner") -> DataFrame:
    """Join a versioned dimension on its ids and on version = feed_start_date.

    Only ``columns`` of the dimension are read. The join carries no hint: Spark
    broadcasts the dimension when its size is below the broadcast threshold and
    otherwise sort-merges, with skewed partitions split at run time.
    """
    side = dim.select(F.col("feed_start_date").alias("static_version_date"), *on, *columns)
    return facts.join(side, [*on, "static_version_date"], how)
