"""Cell dimension lookups, snapshots and unified events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.functions.calendar import CALENDAR_COLUMNS, calendar_columns
from cellwatch.operators.cells import resolve_cell
from cellwatch.schemas import (
    METADATA_COLUMNS,
    SENSOR_MEASURES,
    SNAPSHOT_COLUMNS,
    STATIC_COLUMNS,
    UNIFIED_SCHEMA,
    WEATHER_MEASURES,
)
from cellwatch.sources import decode
from cellwatch.sources.decode import require_keys

# The joins below carry no hint. Spark broadcasts a dimension while its size
# is under spark.sql.autoBroadcastJoinThreshold, checked again by AQE on the
# real size; a larger one is joined by sort-merge, where AQE splits hot cells.


def locate(events: DataFrame, index: DataFrame | None) -> DataFrame:
    """Cell from the coordinates where a grid index is given, else as received."""
    return events if index is None else resolve_cell(events, index)


# What a refused row says about itself: where it fell out, and why.
STAGE, REASON = "stage", "reason"


def refuse(df: DataFrame, stage: str, reason: Column) -> DataFrame:
    """Marks rows that have a ``reason`` now and had none before."""
    first = F.col(REASON).isNull() & reason.isNotNull()
    return df.withColumns(
        {STAGE: F.when(first, F.lit(stage)).otherwise(F.col(STAGE)), REASON: F.coalesce(F.col(REASON), reason)}
    )


def marked_keys(events: DataFrame) -> DataFrame:
    """Adds ``stage`` and ``reason``: of decoding where it refused the row, or for a missing key."""
    refused = F.col(decode.REASON) if decode.REASON in events.columns else F.lit(None).cast("string")
    marked = events.withColumns({STAGE: F.when(refused.isNotNull(), F.lit("decode")), REASON: refused})
    missing = F.col("h3_cell").isNull() | F.col("event_date").isNull() | F.col("event_time").isNull()
    return refuse(marked, "decode", F.when(missing, "missing_key"))


def marked_snapshots(events: DataFrame, static: DataFrame, index: DataFrame | None = None, extra: tuple = ()):
    """``weather_snapshots`` that keeps every row, the lost ones with ``stage`` and ``reason``."""
    marked = marked_keys(locate(events, index))
    joined = marked.join(static.select("h3_cell", *STATIC_COLUMNS, F.lit(True).alias("_there")), "h3_cell", "left")
    found = refuse(joined, "static", F.when(F.col("_there").isNull(), "no_static"))
    return _snapshots(found, (*extra, STAGE, REASON))


def weather_snapshots(events: DataFrame, static: DataFrame, index: DataFrame | None = None, extra: tuple = ()):
    """Weather events to feature snapshots; cells without static data drop out.

    The one precipitation reading fills both the 1-day and the 7-day column.
    """
    located = require_keys(locate(events, index))
    return _snapshots(located.join(static.select("h3_cell", *STATIC_COLUMNS), "h3_cell"), extra)


def _snapshots(joined: DataFrame, extra: tuple) -> DataFrame:
    renamed = {
        "h3_commune": "h3_cell",
        "humidity_min": "humidity",
        "temperature_moy": "temperature",
        "wind_speed_max": "wind_speed",
        "precipitation_1d_mm": "precipitation",
        "precipitation_7d_sum_mm": "precipitation",
        "vpd_kpa": "vpd",
    }
    plain = [c for c in SNAPSHOT_COLUMNS if c not in CALENDAR_COLUMNS]
    columns = [f"{renamed.get(c, c)} AS {c}" for c in plain]
    return joined.selectExpr(*columns, *extra).select("*", *calendar_columns(F.col("event_date"))).select(
        *SNAPSHOT_COLUMNS, *extra
    )


def static_misses(events: DataFrame, static: DataFrame) -> DataFrame:
    """Events dropped by the snapshot join, counted per cell."""
    missed = require_keys(events).join(static.select("h3_cell"), "h3_cell", "left_anti")
    return missed.groupBy("h3_cell").agg(F.count(F.lit(1)).alias("n_events"))


def _unified(events: DataFrame, static: DataFrame | None, source: str, given: dict[str, str], extra: tuple) -> DataFrame:
    """All unified columns; those the source does not have are typed nulls.

    Without a dimension the static columns are the events' own, or null.
    """
    joined = events if static is None else events.join(static.select("h3_cell", *STATIC_COLUMNS), "h3_cell", "left")
    own = {c: c for c in ("h3_cell", "event_time", "event_date", "lat", "lon", *STATIC_COLUMNS) if c in joined.columns}
    values = {**own, "source_type": f"'{source}'", **given}
    columns = [
        f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in UNIFIED_SCHEMA.fields
    ]
    return require_keys(joined.selectExpr(*columns, *extra))


def unify_sensor(events: DataFrame, static: DataFrame | None, index: DataFrame | None = None, extra: tuple = ()):
    """Sensor events as unified events; alert level and fire flag are dropped."""
    return _unified(locate(events, index), static, "sensor", {c: c for c in SENSOR_MEASURES}, extra)


def unify_fire(events: DataFrame, static: DataFrame | None, index: DataFrame | None = None, extra: tuple = ()):
    """Fire reports as unified events; an absent declaration counts as none."""
    given = {
        "fire_declared": "CASE WHEN declared THEN 1 ELSE 0 END",
        "intensity": "intensity",
        "burned_area": "burned_area",
    }
    return _unified(locate(events, index), static, "fire", given, extra)


def unify_weather(events: DataFrame, static: DataFrame | None, index: DataFrame | None = None, extra: tuple = ()):
    """Weather events as unified events, the third source of the cell window."""
    return _unified(locate(events, index), static, "meteo", {c: c for c in WEATHER_MEASURES}, extra)


def control_events(sensor: DataFrame, fire: DataFrame) -> DataFrame:
    """Sensor and fire events as one bag of rows."""
    return sensor.unionByName(fire)


def with_metadata(df: DataFrame, metadata: DataFrame) -> DataFrame:
    return df.join(metadata.select("h3_cell", *METADATA_COLUMNS), "h3_cell", "left")
