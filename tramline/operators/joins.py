"""Joins that keep their shape when keys are hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_SHARE of the rows. At most
# HOT_SHARE keys can do so, which bounds the broadcast list of hot keys.
HOT_SHARE = 64


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold more than 1/share of all rows, and that part (``__part``); fewer than ``share`` rows."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    total = df.agg(F.count("*")).scalar()  # of a stored table this is read off its files' footers
    return counts.where(F.col("__n") > total / F.lit(share)).select(*keys, (F.col("__n") / total).alias("__part"))


def join_hot(many: DataFrame, few: DataFrame, on: Sequence[str], how: str = "inner",
             counted: DataFrame | None = None) -> DataFrame:
    """Equi join whose hot keys are spread over partitions in proportion to their rows.

    Rows of ``many`` with a hot key get a salt from a hash of all their columns, out of
    as many as the key's part of all rows is of the shuffle partitions (two at least);
    rows of ``few`` with that key are repeated once per salt. All other rows
    have salt 0 on both sides and are not repeated. ``how`` may be ``inner`` or
    ``left`` (``many`` is the preserved side). Key columns must not be NULL in
    ``many`` for ``left``; NULL keys match nothing either way.

    Counting the hot keys reads the key columns of ``counted`` (by default
    ``many``; better a stored table it comes from) once more, so this is for
    many-to-many joins, where one hot key multiplies; one-to-many joins leave
    the splitting to adaptive execution.
    """
    if how not in ("inner", "left"):
        raise ValueError("join_hot supports inner and left joins")
    on = list(on)
    partitions = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(many if counted is None else counted, on).select(
        *on, F.greatest(F.lit(2), F.ceil(F.col("__part") * F.lit(partitions))).cast("int").alias("__hot")))
    fragment = (
        many.join(hot, on, "left")
        .withColumn("__salt", F.when(F.col("__hot").isNotNull(), F.pmod(F.xxhash64(*many.columns), F.col("__hot")).cast("int"))
                    .otherwise(F.lit(0)))
        .drop("__hot")
    )
    copies = F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.col("__hot") - 1)).otherwise(F.array(F.lit(0)))
    replica = few.join(hot, on, "left").withColumn("__salt", F.explode(copies)).drop("__hot")
    return fragment.join(replica, [*on, "__salt"], how).drop("__salt")


def left_join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on ``on`` where NULL matches NULL; right keys are not repeated."""
    renamed = reduce(lambda d, k: d.withColumnRenamed(k, f"__r_{k}"), on, right)
    condition: Column = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in on]
    )
    return left.join(renamed, condition, "left").drop(*[f"__r_{k}" for k in on])
