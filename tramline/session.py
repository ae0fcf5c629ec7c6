"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession


def build_session(app_name: str = "tramline", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC as session zone.

    ``shuffle_partitions`` is left to the cluster unless given; adaptive
    execution coalesces small partitions after each shuffle.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Conditions on a day reach the snapshot tree before its folders are listed.
        .config("spark.sql.python.filterPushdown.enabled", "true")
        # Larger generated methods are not compiled by the JVM; wide nested
        # projections then run faster outside whole-stage code generation.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


HUGE = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def at_most(spark: SparkSession, limits: dict[str, int]) -> Iterator[None]:
    """Numbers of the session lowered to ``limits`` (as far as they aren't below, or off) for what is run inside."""
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, most in limits.items():
            spark.conf.set(k, min(most, int(before[k])) if int(before[k]) > 0 else most)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables, under the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of this
    machine; on a cluster every executor must see the folder, so the setting is
    required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tramline-")
