"""Dates, wall times and GTFS clock texts.

Wall times are TIMESTAMP_NTZ and are computed without the session time zone,
so the same job gives the same rows whatever zone the cluster runs in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EASTERN = "America/New_York"
DAY_SECONDS = 86_400


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def utc_wall_time(epoch: Column | str) -> Column:
    """Epoch seconds as UTC wall time."""
    seconds = _col(epoch).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(zero, zero, zero, seconds)


def local_wall_time(epoch: Column | str, zone: str = EASTERN) -> Column:
    """Epoch seconds as wall time of ``zone``, clock changes included."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall_time(epoch))


def wall_epoch(ts: Column | str) -> Column:
    """Whole seconds from 1970-01-01 00:00 to a wall time, both on the same clock."""
    ts = _col(ts)
    return F.unix_date(F.to_date(ts)).cast("bigint") * DAY_SECONDS + seconds_of_day(ts)


def seconds_of_day(ts: Column | str) -> Column:
    ts = _col(ts)
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_since_midnight(ts: Column | str, day: Column | str) -> Column:
    """Seconds from midnight of ``day`` to ``ts``; passes 86,400 for overnight trips.

    Counted on the wall clock, so on clock-change days it differs by an hour
    from the noon-minus-twelve rule of the schedule standard.
    """
    ts, day = _col(ts), _col(day)
    return F.date_diff(F.to_date(ts), day) * DAY_SECONDS + seconds_of_day(ts)


def gtfs_date(text: Column | str) -> Column:
    """``yyyyMMdd`` text to a date, NULL when it does not parse."""
    return F.try_to_date(_col(text).cast("string"), "yyyyMMdd")


def gtfs_seconds(text: Column | str) -> Column:
    """``HH:MM:SS`` (hours may pass 23) to seconds; NULL and blank stay NULL."""
    parts = F.split(_col(text), ":")

    def part(i: int) -> Column:
        return F.get(parts, i).try_cast("int")

    return part(0) * 3600 + part(1) * 60 + part(2)


def gtfs_clock(seconds: Column | str) -> Column:
    """Seconds since midnight to ``HH:MM:SS`` with hours beyond 23 kept."""
    s = _col(seconds).cast("bigint")
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60,
    )


def minute_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of minute boundaries crossed between two wall times."""
    return F.floor(wall_epoch(end) / 60) - F.floor(wall_epoch(start) / 60)


def boundary_hours(start: Column | str, end: Column | str) -> Column:
    """Hours between two wall times, counted in minute boundaries."""
    return minute_boundaries(start, end).cast("double") / F.lit(60.0)


def age_seconds(epoch: Column | str, as_of: Column | int) -> Column:
    """Whole seconds from ``epoch`` to ``as_of``, never below 0; NULL for a missing or zero stamp."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    stamp = F.nullif(_col(epoch), F.lit(0))
    return F.when(stamp.isNotNull(), F.greatest(F.lit(0), as_of - stamp)).cast("bigint")


def iso_utc(epoch: Column | str) -> Column:
    """``2024-01-01T00:00:07+00:00``; NULL for a missing or zero stamp."""
    text = utc_wall_time(F.nullif(_col(epoch), F.lit(0))).cast("string")
    return F.concat(F.translate(text, " ", "T"), F.lit("+00:00"))


def iso_zulu(epoch: Column | str) -> Column:
    """``2024-01-01T00:00:07Z``."""
    return F.concat(F.translate(utc_wall_time(epoch).cast("string"), " ", "T"), F.lit("Z"))


def compact_zulu(epoch: Column | str) -> Column:
    """``20240101T000007Z``."""
    return F.concat(F.translate(utc_wall_time(epoch).cast("string"), " -:", "T"), F.lit("Z"))
