"""A latest-wins table of keyed deltas that are folded now and then."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.latest import first_per_key
from tramline.schemas import conform

SHARE = 0.5  # of the largest part's bytes that the other parts may have before all are folded
MOST = 32  # parts that a read has to merge at most
_LOADED = "__loaded"


class LatestState:
    """The newest row per key over all batches ever merged, as Parquet folders that are only ever added.

    A merge appends its batch as one part, so it costs what the batch costs. Reading takes the first row per
    key over all parts in one group-limited pass: newest ``newest`` column, then the batch that was loaded
    first, then ``ties``. When the small parts outgrow a share of the largest one, or are many, the rows of
    all of them are written as one more part, and a list of the parts that it covers is written after it. A part and its
    fold hold the same newest rows, so it does not matter which of them a reader sees, or whether
    two writers fold at once: no part is lost or counted twice, and there is nothing to claim. A merge that dies
    leaves a part without Spark's success marker, which is not read. Parts are deleted by the second fold after them, so a
    read that has begun stays valid over one fold.
    """

    def __init__(self, spark: SparkSession, path: str, layout: str, keys: Sequence[str], ties: Sequence[Column] = (),
                 share: float = SHARE, most: int = MOST, newest: str = "snapshot_timestamp"):
        self.spark, self.path, self.layout = spark, path.rstrip("/"), layout
        self.keys, self.ties, self.share, self.most, self.newest = list(keys), list(ties), share, most, newest
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def read(self) -> DataFrame:
        return self._newest(self._live()).drop(_LOADED)

    def arrived(self, first: date, last: date) -> DataFrame:
        """Rows whose newest stamp lies in the range, of every part and before they are merged; only their row groups are read."""
        paths = [f"{self.path}/parts/{p}" for p in self._live()]
        if not paths:
            return self.spark.createDataFrame([], self.layout)
        kind = dict(self.spark.createDataFrame([], self.layout).dtypes)[self.newest]
        rows = self.spark.read.schema(self.layout).parquet(*paths)
        return rows.where((F.col(self.newest) >= F.lit(first).cast(kind)) & (F.col(self.newest) < F.lit(last + timedelta(days=1)).cast(kind)))

    def merge(self, batch: DataFrame) -> DataFrame:
        name = self._name()
        conform(batch, self.layout).withColumn(_LOADED, F.lit(name)).write.mode("errorifexists").parquet(f"{self.path}/parts/{name}")
        parts = self._live()
        sizes = [self._bytes(f"{self.path}/parts/{p}") for p in parts]
        if len(parts) > 1 and (sum(sizes) - max(sizes) > self.share * max(sizes) or len(parts) > self.most):
            self.fold()
        return self.read()

    def fold(self) -> None:
        """Writes the newest rows as one part and deletes what the fold before this one had covered."""
        name, covered = self._name(), self._covered()
        parts = self._live()
        self._newest(parts).write.mode("errorifexists").parquet(f"{self.path}/parts/{name}")
        there = [p for p in covered if self._exists(f"{self.path}/parts/{p}")]
        names = self.spark.createDataFrame([(p,) for p in (*parts, *there)], "part string")
        names.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/covers/{name}")
        for part in there:
            self._delete(f"{self.path}/parts/{part}")
        for old in self._complete("covers")[:-2]:
            self._delete(f"{self.path}/covers/{old}")

    def parts(self) -> list[str]:
        """Names of the parts that a read merges."""
        return self._live()

    def _name(self) -> str:
        return f"{time.time_ns() // 1_000_000:015}-{uuid.uuid4().hex}"

    def _newest(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], f"{self.layout}, {_LOADED} string")
        rows = self.spark.read.schema(f"{self.layout}, {_LOADED} string").parquet(*[f"{self.path}/parts/{p}" for p in parts])
        if len(parts) == 1 and parts[0] in self._complete("covers"):
            return rows  # a fold has one row per key
        return first_per_key(rows, self.keys, [F.col(self.newest).desc_nulls_last(), F.col(_LOADED).asc(), *self.ties])

    def _live(self) -> list[str]:
        covered = set(self._covered())
        return [p for p in self._complete("parts") if p not in covered]

    def _covered(self) -> list[str]:
        """Parts that the newest fold covers; their number is bounded by ``most`` and the writers at work."""
        folds = self._complete("covers")
        return [r.part for r in self.spark.read.schema("part string").parquet(f"{self.path}/covers/{folds[-1]}").collect()] if folds else []

    def _complete(self, kind: str) -> list[str]:
        """Folders whose write has ended, oldest first."""
        pattern = self._hadoop.Path(f"{self.path}/{kind}/*/_SUCCESS")
        return sorted(s.getPath().getParent().getName() for s in self._store(pattern).globStatus(pattern) or [])

    def _store(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        found = self._hadoop.Path(path)
        return self._store(found).exists(found)

    def _bytes(self, path: str) -> int:
        found = self._hadoop.Path(path)
        return self._store(found).getContentSummary(found).getLength()

    def _delete(self, path: str) -> None:
        found = self._hadoop.Path(path)
        self._store(found).delete(found, True)
