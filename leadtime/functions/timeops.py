"""Time arithmetic as native Column expressions.

All functions return ``Column`` objects so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadtime.functions._util import col


def to_instant(c) -> Column:
    """TIMESTAMP_NTZ (as Parquet gives it) -> TIMESTAMP; session zone is UTC."""
    return col(c).cast("timestamp")


def epoch_micros(c) -> Column:
    return F.unix_micros(col(c))


def from_epoch_micros(c) -> Column:
    return F.timestamp_micros(col(c))


def add_minutes(ts, minutes) -> Column:
    """ts + minutes (double minutes allowed); NULL minutes -> NULL."""
    return F.timestamp_micros(F.unix_micros(col(ts)) + F.round(col(minutes) * F.lit(60_000_000)).cast("long"))


def hours_before(ts, n: float) -> Column:
    """time minus n hours."""
    return F.timestamp_micros(F.unix_micros(col(ts)) - F.lit(int(round(n * 3_600_000_000))))


def hhmm_timestamp(date, hhmm) -> Column:
    """date + HHMM integer as a local wall-clock timestamp; 2400 -> next midnight.

    Built from arithmetic (date + h hours + m minutes), so 2400 needs no
    special case and no string parsing happens per row.
    """
    h = F.floor(col(hhmm) / 100)
    m = col(hhmm) % 100
    base = F.unix_micros(F.to_date(col(date)).cast("timestamp"))
    return F.timestamp_micros(base + (h * 3600 + m * 60).cast("long") * F.lit(1_000_000))


def to_utc(ts, zone) -> Column:
    """F8: local wall-clock time in ``zone`` -> UTC instant; NULL-safe."""
    return F.when(col(zone).isNotNull() & col(ts).isNotNull(), F.to_utc_timestamp(col(ts), col(zone)))


def roll_arrival(dep, arr) -> Column:
    """if departure is after arrival the arrival is on the next day."""
    return F.when(col(dep) > col(arr), F.timestamp_add("DAY", F.lit(1), col(arr))).otherwise(col(arr))


def actual_time(ts, delay_min) -> Column:
    """scheduled + delay minutes, NULL delay counted as 0."""
    return add_minutes(ts, F.coalesce(col(delay_min).cast("double"), F.lit(0.0)))


def elapsed_minutes(a, b) -> Column:
    """minutes from a to b."""
    return (F.unix_micros(col(b)) - F.unix_micros(col(a))) / F.lit(60_000_000.0)


def time_parts(ts, prefix: str = "") -> dict[str, Column]:
    """hour, weekday (1 = Sunday), month and date of a timestamp."""
    c = col(ts)
    return {f"{prefix}hour": F.hour(c), f"{prefix}dow": F.dayofweek(c),
            f"{prefix}month": F.month(c), f"{prefix}date": F.to_date(c)}


def cyclic(c, period: float) -> tuple[Column, Column]:
    """(sin, cos) encoding of a periodic value."""
    ang = col(c).cast("double") * F.lit(2.0 * math.pi / period)
    return F.sin(ang), F.cos(ang)


def hhmm_hour(c) -> Column:
    """HHMM integer -> hour."""
    return F.floor(col(c) / 100).cast("int")


def time_bucket(ts, width) -> Column:
    """F16: 'day'/'week'/'month'/'hour' truncation, or an epoch bucket of
    ``width`` seconds (returned as the bucket's start instant)."""
    if isinstance(width, str):
        return F.date_trunc(width, col(ts))
    w = int(width) * 1_000_000
    return F.timestamp_micros(F.floor(F.unix_micros(col(ts)) / w).cast("long") * w)


def interval_minutes(c) -> Column:
    """day-time interval -> minutes (double)."""
    return F.unix_micros(F.lit("1970-01-01 00:00:00").cast("timestamp") + col(c)) / F.lit(60_000_000.0)


def minutes_interval(c) -> Column:
    """Minutes (number) -> day-time interval."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), col(c).cast("decimal(18,6)") * 60)


def iso_timestamp(c) -> Column:
    """'YYYY-MM-DDTHH:MM:SS' string -> timestamp (bad strings -> NULL)."""
    return F.try_to_timestamp(F.regexp_replace(col(c), "T", " "))
