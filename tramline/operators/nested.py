"""Array columns to rows and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_array(df: DataFrame, array: str, keep: Sequence[str], element: str,
                  index: str | None = None) -> DataFrame:
    """One row per array element, NULL and empty arrays giving none; ``index`` counts from 0."""
    if index:
        return df.select(*keep, F.posexplode(array).alias(index, element))
    return df.select(*keep, F.explode(array).alias(element))


def ordered_lines(points: DataFrame, keys: Sequence[str], chunk: int = 1024) -> DataFrame:
    """Points (keys, seq, lon, lat) to one coordinate array per key, in (seq, lon, lat) order.

    Points are first gathered and sorted in chunks of ``chunk`` sequence numbers,
    so the sorting of a long line is spread over many tasks; the last step only
    strings sorted chunks together. The whole line is one value of the result.
    """
    pieces = (
        points.withColumn("__chunk", F.floor(F.col("seq") / chunk))
        .groupBy(*keys, "__chunk")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "lon", "lat"))).alias("__points"))
    )
    lines = pieces.groupBy(*keys).agg(
        F.flatten(F.transform(
            F.array_sort(F.collect_list(F.struct("__chunk", "__points"))), lambda c: c["__points"]
        )).alias("__points")
    )
    return lines.select(*keys, F.transform("__points", lambda p: F.array(p["lon"], p["lat"])).alias("coordinates"))
