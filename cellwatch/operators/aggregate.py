"""Multi-source measures per cell and time window, and snapshots from them.

Every measure is a sum, count, minimum, maximum or ``max_by`` over fixed-width
values, so Spark hash-aggregates before the shuffle. A cell with a third of
all events sends one row per task and window, not its events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.functions.calendar import CALENDAR_COLUMNS, calendar_columns, utc_date
from cellwatch.functions.scalars import same_text
from cellwatch.schemas import SNAPSHOT_COLUMNS, STATIC_COLUMNS

# Measure columns of the aggregate table, by source.
FIRE_AGGREGATES = [
    "fire_count",
    "fire_declared_count",
    "avg_fire_intensity",
    "max_fire_intensity",
    "total_burned_area",
]
METEO_AGGREGATES = [
    "meteo_count",
    "avg_temp",
    "min_humidity",
    "max_wind_speed",
    "avg_vpd",
    "avg_soil_moisture",
    "total_precipitation_1d",
    "total_precipitation_7d",
]
SENSOR_AGGREGATES = [
    "sensor_count",
    "avg_co2",
    "max_co2",
    "avg_smoke",
    "max_smoke",
    "avg_sensor_temp",
    "max_sensor_temp",
    "min_battery",
]


def measure_columns() -> list[Column]:
    fire, meteo, sensor = (same_text(F.col("source_type"), s) for s in ("fire", "meteo", "sensor"))

    def of(source: Column, name: str) -> Column:
        return F.when(source, F.col(name))

    rain = F.coalesce(F.sum(of(meteo, "precipitation")), F.lit(0.0))
    return [
        F.count_if(fire).alias("fire_count"),
        F.coalesce(F.sum(F.when(fire & (F.col("fire_declared") > 0), F.col("fire_declared"))), F.lit(0)).alias(
            "fire_declared_count"
        ),
        F.avg(of(fire, "intensity")).alias("avg_fire_intensity"),
        F.max(of(fire, "intensity")).alias("max_fire_intensity"),
        F.coalesce(F.sum(of(fire, "burned_area")), F.lit(0.0)).alias("total_burned_area"),
        F.count_if(meteo).alias("meteo_count"),
        F.avg(of(meteo, "temperature")).alias("avg_temp"),
        F.min(of(meteo, "humidity")).alias("min_humidity"),
        F.max(of(meteo, "wind_speed")).alias("max_wind_speed"),
        F.avg(of(meteo, "vpd")).alias("avg_vpd"),
        F.avg(of(meteo, "soil_moisture")).alias("avg_soil_moisture"),
        rain.alias("total_precipitation_1d"),
        rain.alias("total_precipitation_7d"),
        F.count_if(sensor).alias("sensor_count"),
        F.avg(of(sensor, "co2")).alias("avg_co2"),
        F.max(of(sensor, "co2")).alias("max_co2"),
        F.avg(of(sensor, "smoke")).alias("avg_smoke"),
        F.max(of(sensor, "smoke")).alias("max_smoke"),
        F.avg(of(sensor, "sensor_temperature")).alias("avg_sensor_temp"),
        F.max(of(sensor, "sensor_temperature")).alias("max_sensor_temp"),
        F.min(of(sensor, "battery")).alias("min_battery"),
        F.avg("lat").alias("avg_lat"),
        F.avg("lon").alias("avg_lon"),
    ]


def _last_known(name: str) -> Column:
    return F.max_by(name, F.when(F.col(name).isNotNull(), F.col("seq"))).alias(name)


def cell_windows(
    unified: DataFrame, length: str = "1 day", watermark: str | None = None, static: DataFrame | None = None
) -> DataFrame:
    """One row per cell and tumbling UTC window over the unified events.

    ``seq`` gives the arrival order behind "last seen" values. The bounds of
    the window are epoch milliseconds, the end exclusive; ``first_event_time``
    and ``last_event_time`` are what really arrived. A stream needs a
    ``watermark``: how late events may be before their window is closed.

    With ``static``, a dimension of one row per cell, the static columns are
    joined to the finished windows and those of the events are not read;
    without it they are the last values that the events themselves carried.
    """
    timed = unified.withColumn("event_ts", F.timestamp_millis("event_time"))
    if watermark:
        timed = timed.withWatermark("event_ts", watermark)
    grouped = timed.groupBy("h3_cell", F.window("event_ts", length).alias("w"))
    windows = grouped.agg(
        *measure_columns(),
        *([_last_known(c) for c in STATIC_COLUMNS] if static is None else []),
        F.max_by("event_date", "seq").alias("event_date"),
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("last_event_time"),
    )
    if static is not None:
        windows = windows.join(static.select("h3_cell", *STATIC_COLUMNS), "h3_cell", "left")
    return windows.select(
        "h3_cell",
        "event_date",
        F.unix_millis("w.start").alias("window_start"),
        F.unix_millis("w.end").alias("window_end"),
        "first_event_time",
        "last_event_time",
        *FIRE_AGGREGATES,
        *METEO_AGGREGATES,
        *SENSOR_AGGREGATES,
        "avg_lat",
        "avg_lon",
        *STATIC_COLUMNS,
    )


def window_snapshots(windows: DataFrame, date_from: str = "end") -> DataFrame:
    """Feature snapshots from aggregated windows.

    The event time is the window end. With ``date_from="end"`` the date is that
    of the exclusive end, so a daily window carries the next day's date;
    ``"start"`` dates it by the day it covers.
    """
    if date_from not in ("end", "start"):
        raise ValueError(f"date_from must be end or start, not {date_from}")
    dated = windows.withColumn("_date", utc_date(F.col(f"window_{date_from}")))
    renamed = {
        "h3_commune": "h3_cell",
        "event_time": "window_end",
        "event_date": "_date",
        "humidity_min": "min_humidity",
        "temperature_moy": "avg_temp",
        "wind_speed_max": "max_wind_speed",
        "precipitation_1d_mm": "total_precipitation_1d",
        "precipitation_7d_sum_mm": "total_precipitation_7d",
        "soil_moisture": "avg_soil_moisture",
        "vpd_kpa": "avg_vpd",
    }
    plain = [c for c in SNAPSHOT_COLUMNS if c not in CALENDAR_COLUMNS]
    columns = [f"{renamed.get(c, c)} AS {c}" for c in plain]
    return dated.selectExpr(*columns).select("*", *calendar_columns(F.col("event_date"))).select(*SNAPSHOT_COLUMNS)
