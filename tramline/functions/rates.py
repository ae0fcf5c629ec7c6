"""Shares, percentages and speeds.

The warehouse these metrics come from divides in fixed-point decimals. The two
percentage functions reproduce its digits with whole-number arithmetic, which
is exact and stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METERS_PER_SECOND_TO_MPH = 2.2369362921


def _half_up(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded half up, for non-negative whole numbers; NULL for 0."""
    d = F.nullif(denominator, F.lit(0))
    return F.call_function("div", numerator * 2 + d, d * 2)


def count_share_pct(part: Column, whole: Column) -> Column:
    """part / whole * 100 to 2 digits, the quotient itself fixed at 6 digits."""
    quotient = _half_up(part.cast("bigint") * 1_000_000, whole.cast("bigint"))
    return _half_up(quotient, F.lit(100).cast("bigint")).cast("double") / F.lit(100.0)


def pct(part: Column, whole: Column) -> Column:
    """part * 100 / whole to 2 digits; NULL when whole is 0."""
    return _half_up(part.cast("bigint") * 10_000, whole.cast("bigint")).cast("double") / F.lit(100.0)


def mean_flag_pct(flag: Column) -> Column:
    """Aggregate: percentage of rows where ``flag`` holds, NULL flags counted as not."""
    return F.avg(F.when(flag, F.lit(1.0)).otherwise(F.lit(0.0))) * F.lit(100.0)


def weighted_mean(value: Column, weight: Column, over_reported: bool = False) -> Column:
    """Aggregate: sum(value * weight) / sum(weight).

    ``over_reported`` counts only the weight of rows that have a value.
    """
    base = F.when(value.isNotNull(), weight).otherwise(F.lit(0)) if over_reported else weight
    return F.sum(value * weight) / F.nullif(F.sum(base), F.lit(0))


def mph(meters_per_second: Column) -> Column:
    return F.bround(meters_per_second.cast("double") * METERS_PER_SECOND_TO_MPH, 1)


ON_TIME_EARLIEST = -150
ON_TIME_LATEST = 300


def is_on_time(delay_seconds: Column) -> Column:
    """True for a delay of -150 to 300 seconds; a missing delay is not on time."""
    return F.coalesce(delay_seconds.between(ON_TIME_EARLIEST, ON_TIME_LATEST), F.lit(False))


def is_early(delay_seconds: Column) -> Column:
    return delay_seconds < ON_TIME_EARLIEST


def is_late(delay_seconds: Column) -> Column:
    return delay_seconds > ON_TIME_LATEST
