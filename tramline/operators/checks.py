"""Declared keys, required columns and references, as reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row and their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_count) for required columns, in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "null_count")


def orphans(df: DataFrame, parent: DataFrame, column: str, parent_column: str) -> DataFrame:
    """Values of ``column`` that ``parent`` does not have, with their row count."""
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("row_count"))
    known = parent.select(F.col(parent_column).alias(column))
    return values.join(known, column, "left_anti")


def constraint_report(df: DataFrame, keys: Sequence[str], required: Sequence[str]) -> DataFrame:
    """One row per violated-or-not rule: (rule, violations). Keys and required columns may be empty."""
    nulls = null_counts(df, required).select(
        F.concat(F.lit("not null "), F.col("column_name")).alias("rule"),
        F.col("null_count").cast("bigint").alias("violations"),
    ) if required else df.sparkSession.createDataFrame([], "rule string, violations bigint")
    if not keys:
        return nulls
    duplicates = duplicate_keys(df, keys).agg(
        F.lit("unique " + ", ".join(keys)).alias("rule"),
        F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).cast("bigint").alias("violations"),
    )
    return duplicates.unionByName(nulls)
