"""Calendar and clock expressions.

All of them work on epoch milliseconds or dates and give the same answer in
every session time zone: local wall clocks are reached by shifting the epoch,
never by printing a timestamp.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: zone of the slot labels and of the daily event hours.
LOCAL_ZONE = "Africa/Algiers"
CALENDAR_COLUMNS = ["month", "month_sin", "month_cos", "doy_sin", "doy_cos", "is_weekend"]

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def utc_date(epoch_ms: Column) -> Column:
    """UTC calendar date of an epoch in milliseconds."""
    return F.date_from_unix_date(F.floor(epoch_ms / F.lit(DAY_MS)).cast("int"))


def month_of(date: Column) -> Column:
    return F.month(date)


def day_of_year(date: Column) -> Column:
    return F.dayofyear(date)


def _turn(part: Column, period: float) -> Column:
    return F.lit(2.0 * math.pi) * part / F.lit(period)


def month_sin(date: Column) -> Column:
    return F.sin(_turn(F.month(date), 12.0))


def month_cos(date: Column) -> Column:
    return F.cos(_turn(F.month(date), 12.0))


def doy_sin(date: Column) -> Column:
    """Always over 365 days, leap years included."""
    return F.sin(_turn(F.dayofyear(date), 365.0))


def doy_cos(date: Column) -> Column:
    return F.cos(_turn(F.dayofyear(date), 365.0))


def is_weekend(date: Column) -> Column:
    return F.when(F.dayofweek(date).isin(1, 7), 1).when(date.isNotNull(), 0)


def calendar_columns(date: Column) -> list[Column]:
    """The six calendar features of a date, named as in a snapshot."""
    return [
        month_of(date).alias("month"),
        month_sin(date).alias("month_sin"),
        month_cos(date).alias("month_cos"),
        doy_sin(date).alias("doy_sin"),
        doy_cos(date).alias("doy_cos"),
        is_weekend(date).alias("is_weekend"),
    ]


def strict_date(text: Column) -> Column:
    """ISO ``yyyy-MM-dd`` text to a date; anything else is null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def slot_label(epoch_ms: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local hour of an epoch as ``HH:00``."""
    local_ms = F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(epoch_ms), zone))
    hour = F.pmod(F.floor(local_ms / F.lit(HOUR_MS)), F.lit(24)).cast("string")
    return F.concat(F.lpad(hour, 2, "0"), F.lit(":00"))


def local_epoch(date: Column, offset_ms: Column | int = 0, zone: str = LOCAL_ZONE) -> Column:
    """Epoch milliseconds of local midnight plus an offset on the wall clock."""
    offset = F.lit(offset_ms) if isinstance(offset_ms, int) else offset_ms
    wall_ms = F.unix_date(date).cast("bigint") * F.lit(DAY_MS) + offset
    return F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(wall_ms), zone))


def local_hour_epoch(date: Column, hour: Column | int, zone: str = LOCAL_ZONE) -> Column:
    hour = F.lit(hour) if isinstance(hour, int) else hour
    return local_epoch(date, hour.cast("bigint") * F.lit(HOUR_MS), zone)


def local_day_start_plus(date: Column, offset_ms: Column, zone: str = LOCAL_ZONE) -> Column:
    """Epoch of local midnight, then an elapsed time added to the instant."""
    return local_epoch(date, 0, zone) + offset_ms


def date_range(start: Column, end: Column) -> Column:
    """Every date from start to end, both included."""
    return F.sequence(start, end, F.expr("interval 1 day"))
