"""Window aggregates that are kept unfinished, so that batches of events can be added one after another.

``partial_windows`` turns a batch of unified events into one row per cell and
window with what the measures need: counts, sums, extremes, and the last known
values with their order. ``merge_partials`` adds such rows up to rows of the
same kind, in any order and grouping, and ``finished_windows`` makes the table
of ``aggregate.cell_windows`` of them. Stored partials replace the events:
adding a batch reads no earlier event, and a table of committed batches keeps a
batch that is written twice from counting twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.functions.scalars import same_text
from cellwatch.operators.aggregate import FIRE_AGGREGATES, METEO_AGGREGATES, SENSOR_AGGREGATES
from cellwatch.schemas import STATIC_COLUMNS

KEY = ["h3_cell", "window_start", "window_end"]

# Measures by what is kept of them: the column of the events and the source it counts for.
_MEANS = {
    "avg_fire_intensity": ("intensity", "fire"),
    "avg_temp": ("temperature", "meteo"),
    "avg_vpd": ("vpd", "meteo"),
    "avg_soil_moisture": ("soil_moisture", "meteo"),
    "avg_co2": ("co2", "sensor"),
    "avg_smoke": ("smoke", "sensor"),
    "avg_sensor_temp": ("sensor_temperature", "sensor"),
    "avg_lat": ("lat", None),
    "avg_lon": ("lon", None),
}
_LARGEST = {
    "max_fire_intensity": ("intensity", "fire"),
    "max_wind_speed": ("wind_speed", "meteo"),
    "max_co2": ("co2", "sensor"),
    "max_smoke": ("smoke", "sensor"),
    "max_sensor_temp": ("sensor_temperature", "sensor"),
}
_SMALLEST = {"min_humidity": ("humidity", "meteo"), "min_battery": ("battery", "sensor")}
_TOTALS = {"total_burned_area": ("burned_area", "fire"), "total_precipitation_1d": ("precipitation", "meteo")}
_COUNTS = {"fire_count": "fire", "meteo_count": "meteo", "sensor_count": "sensor"}


def _of(name: str, source: str | None) -> Column:
    return F.col(name) if source is None else F.when(same_text(F.col("source_type"), source), F.col(name))


def partial_windows(unified: DataFrame, length: str = "1 day") -> DataFrame:
    """One row per cell and tumbling UTC window of a batch of unified events, with ``seq``."""
    grouped = unified.withColumn("event_ts", F.timestamp_millis("event_time")).groupBy(
        "h3_cell", F.window("event_ts", length).alias("w")
    )
    declared = F.when(F.col("fire_declared") > 0, F.col("fire_declared"))
    measures = [F.count_if(same_text(F.col("source_type"), s)).alias(c) for c, s in _COUNTS.items()]
    measures.append(F.sum(F.when(same_text(F.col("source_type"), "fire"), declared)).alias("fire_declared_count"))
    for c, (name, source) in _MEANS.items():
        measures += [F.sum(_of(name, source)).alias(f"{c}_sum"), F.count(_of(name, source)).alias(f"{c}_n")]
    measures += [F.max(_of(*m)).alias(c) for c, m in _LARGEST.items()]
    measures += [F.min(_of(*m)).alias(c) for c, m in _SMALLEST.items()]
    measures += [F.sum(_of(*m)).alias(c) for c, m in _TOTALS.items()]
    last = [*STATIC_COLUMNS, "event_date"]
    measures += [F.max(F.when(F.col(c).isNotNull(), F.struct("seq", F.col(c).alias("value")))).alias(f"{c}_last") for c in last]
    measures += [F.min("event_time").alias("first_event_time"), F.max("event_time").alias("last_event_time")]
    rows = grouped.agg(*measures)
    bounds = [F.unix_millis("w.start").alias("window_start"), F.unix_millis("w.end").alias("window_end")]
    return rows.select("h3_cell", *bounds, *[c for c in rows.columns if c not in ("h3_cell", "w")])


def merge_partials(partials: DataFrame) -> DataFrame:
    """Rows of the same cell and window become one; the result can be merged again."""
    smallest = {*_SMALLEST, "first_event_time"}
    largest = {*_LARGEST, "last_event_time"}

    def merged(c: str) -> Column:
        if c in smallest:
            return F.min(c)
        return F.max(c) if c in largest or c.endswith("_last") else F.sum(c)

    columns = [c for c in partials.columns if c not in KEY]
    return partials.groupBy(*KEY).agg(*[merged(c).alias(c) for c in columns]).select(*KEY, *columns)


def finished_windows(partials: DataFrame, static: DataFrame | None = None) -> DataFrame:
    """The table of ``aggregate.cell_windows`` from merged partials."""
    zero = {"total_burned_area": 0.0, "total_precipitation_1d": 0.0, "fire_declared_count": 0}
    values = {c: F.coalesce(F.col(c), F.lit(z)) for c, z in zero.items()}
    values["total_precipitation_7d"] = values["total_precipitation_1d"]
    values |= {c: F.try_divide(f"{c}_sum", f"{c}_n") for c in _MEANS}
    names = [*FIRE_AGGREGATES, *METEO_AGGREGATES, *SENSOR_AGGREGATES, "avg_lat", "avg_lon"]
    own = [F.col(f"{c}_last.value").alias(c) for c in STATIC_COLUMNS] if static is None else []
    rows = partials.select(
        "h3_cell", F.col("event_date_last.value").alias("event_date"), "window_start", "window_end", "first_event_time",
        "last_event_time", *[values.get(c, F.col(c)).alias(c) for c in names], *own,
    )
    if static is not None:
        rows = rows.join(static.select("h3_cell", *STATIC_COLUMNS), "h3_cell", "left")
    return rows
