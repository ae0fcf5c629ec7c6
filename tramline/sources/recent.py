"""Recent vehicle snapshots: gzip JSON lines under dt=YYYY-MM-DD/hour=HH (UTC)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.schemas import RECENT_SNAPSHOT


def read_recent(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot rows with a fixed schema plus the ``dt`` and ``hour`` partition columns."""
    return spark.read.schema(RECENT_SNAPSHOT + ", dt DATE, hour INT").json(path)
