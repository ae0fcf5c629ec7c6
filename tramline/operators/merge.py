"""Latest-wins merge of a batch into stored state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.operators.latest import first_per_key


def merge_latest(stored: DataFrame, batch: DataFrame, keys: Sequence[str],
                 ties: Sequence[Column] = ()) -> DataFrame:
    """Stored rows updated by strictly newer batch rows, plus batch rows with new keys.

    The newest ``snapshot_timestamp`` wins as a whole row; on equal stamps the
    stored row stays. Batches may arrive in any order and any number of times:
    the result is the same. ``ties`` order equal stamps within one batch.
    """
    both = stored.withColumn("__stored", F.lit(0)).unionByName(batch.withColumn("__stored", F.lit(1)))
    order = [F.col("snapshot_timestamp").desc_nulls_last(), F.col("__stored").asc(), *ties]
    return first_per_key(both, keys, order).drop("__stored")
