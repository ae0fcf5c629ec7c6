"""First or latest rows per key.

All of these are ``row_number() <= n``. Spark plans that as a group limit on
both sides of the shuffle: every map task sends at most ``n`` rows per key, so
a key that holds a third of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  n: int = 1, rank_as: str | None = None) -> DataFrame:
    """The first ``n`` rows of every key group in ``order``.

    ``order`` should end in columns that make it unique, or ties are arbitrary.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(_RANK) <= n)
    return kept.withColumnRenamed(_RANK, rank_as) if rank_as else kept.drop(_RANK)


def latest_snapshot_per_key(df: DataFrame, keys: Sequence[str],
                            ties: Sequence[Column] = ()) -> DataFrame:
    """The row of the newest ``snapshot_timestamp`` per key."""
    return first_per_key(df, keys, [F.col("snapshot_timestamp").desc_nulls_last(), *ties])


def top_overall(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global top-n: each task keeps n rows, the driver side merges n per task."""
    return df.orderBy(*order).limit(n)
