"""Streams with keyed state and event-time timers, and a stream-stream join."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tramline.functions.times import wall_epoch

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Keyed state with timers needs this store.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_OUT = "packed string"
GROUPS = 2  # of the trips of a day; a group's open trips are read and written together


class Newest(StatefulProcessor):
    """The newest row per key as value state, given out whenever it changes.

    The key's timer, set anew by each newer row to ``due`` (milliseconds of event time), frees the state.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "place string, packed string, due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.newest.get() if self.newest.exists() else None
        best = held
        for part in rows:
            for row in part[["place", "packed", "due"]].itertuples(index=False, name=None):
                if best is None or row[0] > best[0]:
                    best = row
        if best is not held:
            if held is not None and held[2] != best[2]:
                self.handle.deleteTimer(int(held[2]))
            if held is None or held[2] != best[2]:
                self.handle.registerTimer(int(best[2]))
            self.newest.update((best[0], best[1], int(best[2])))
            yield pd.DataFrame({"packed": [best[1]]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.newest.get() if self.newest.exists() else None
        if held is not None and held[2] <= expiredTimerInfo.getExpiryTimeInMs():
            self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


class FinalRows(StatefulProcessor):
    """The newest row of each member of a group as list state, given out when the group's one timer goes off.

    All members of a group are due at the same time, so a batch reads and writes a group's state once, however many of
    its members it has.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "member string, place string, packed string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = {m: (m, *row) for m, *row in self.rows.get()} if self.rows.exists() else {}
        timed, changed = bool(newest), False
        for part in rows:
            if not timed and len(part):
                self.handle.registerTimer(int(part["due"].iloc[0]))
                timed = True
            for row in part[["member", "place", "packed"]].itertuples(index=False, name=None):
                if row[0] not in newest or row[1] > newest[row[0]][1]:
                    newest[row[0]] = row
                    changed = True
        if changed:
            self.rows.put(list(newest.values()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.rows.exists():
            packed = [row[2] for row in self.rows.get()]
            self.rows.clear()
            yield pd.DataFrame({"packed": packed})

    def close(self) -> None:
        pass


def _through_state(rows: DataFrame, keys: Sequence[Column], member: Column, order: Sequence[Column], due: Column,
                   processor: StatefulProcessor, mode: str) -> DataFrame:
    """``rows`` must carry a watermark on ``event_time``. Columns travel through the state as one JSON text and keep their types."""
    columns = [c for c in rows.columns if c != "event_time"]
    layout = rows.select(columns).schema
    packed = rows.select(
        *[k.cast("string").alias(f"key_{i}") for i, k in enumerate(keys)], "event_time", member.cast("string").alias("member"),
        F.concat(*order).alias("place"), F.to_json(F.struct(*columns), _TIMES).alias("packed"), due.cast("long").alias("due"))
    found = packed.groupBy(*[f"key_{i}" for i in range(len(keys))]).transformWithStateInPandas(processor, _OUT, mode, "EventTime")
    return found.select(F.from_json("packed", layout, _TIMES).alias("row")).select("row.*")


def sortable(time: str, missing: str = "") -> Column:
    """A wall time as text that orders like it; missing times come first, or last with "~"."""
    return F.coalesce(F.lpad(F.unix_micros(F.col(time).cast("timestamp")).cast("string"), 20, "0"), F.lit(missing))


def final_trips(updates: DataFrame, wait_days: int = 2, groups: int = GROUPS) -> DataFrame:
    """Each trip's newest update, given out once its start day is ``wait_days`` days behind the watermark.

    ``updates`` are valid rows (see ``facts``) with a watermark on ``event_time``. The state holds one row per trip that is
    still open, those of a start day in ``groups`` groups; rows behind the watermark are dropped by Spark before they reach it.
    """
    due = wall_epoch(F.date_add("trip_start_date", wait_days).cast("timestamp_ntz")) * 1000
    order = [sortable("snapshot_timestamp", "~"), F.lit("/"), sortable("ingested_at", "~"), F.lit("/"), F.coalesce("entity_id", F.lit("~"))]
    group = F.pmod(F.xxhash64("trip_id"), F.lit(groups))
    return _through_state(updates, [F.col("trip_start_date"), group], F.col("trip_id"), order, due, FinalRows(), "Append")


def latest_rows(rows: DataFrame, key: str, time: str, tie: str, ttl_days: int) -> DataFrame:
    """The newest row per key whenever it changes; a key without newer rows for ``ttl_days`` of event time leaves the state.

    ``tie`` is a whole number that settles equal times.
    """
    due = (wall_epoch(time) + ttl_days * 86_400) * 1000
    order = [sortable(time), F.lit("/"), F.lpad(F.col(tie).cast("string"), 20, "0")]
    return _through_state(rows, [F.col(key)], F.col(key), order, due, Newest(), "Update")


def join_intervals(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
                   before: str, after: str) -> DataFrame:
    """Rows of ``left`` with each row of ``right`` of the same keys whose time lies within ``before`` and ``after``; or alone.

    Both sides carry watermarks on their time columns, which bound how long a row waits in the state. A left row
    without partners is given out once none can come any more.
    """
    same = [left[k] == right[k] for k in keys]
    near = (right[right_time] >= left[left_time] - F.expr(f"INTERVAL {before}")) & (right[right_time] <= left[left_time] + F.expr(f"INTERVAL {after}"))
    joined = left.join(right, [*same, near], "left_outer")
    return joined.select(*[left[c] for c in left.columns], *[right[c] for c in right.columns if c not in keys])


def with_keyed_state(writer):
    """Starts a query whose state needs timers; the session's own choice of state store stays as it is."""
    spark = writer._spark
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
