"""Fire history, recent maxima and latest readings per cell.

Day-level products aggregate to one row per cell and day first, so their
windows run over days, not events. The ten-minute maxima need the events
themselves and are cut into short time segments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellwatch.functions.scalars import same_text


def _daily_fires(unified: DataFrame) -> DataFrame:
    is_fire = same_text(F.col("source_type"), "fire")
    return (
        unified.groupBy("h3_cell", "event_date")
        .agg(F.count_if(is_fire).alias("fires"))
        .withColumn("_day", F.unix_date("event_date").cast("bigint"))
    )


def fire_history(unified: DataFrame) -> DataFrame:
    """Per cell and day with events: fires of the days before it.

    ``fires_cell_last_7d`` and ``_30d`` count the 7 and 30 days before the day,
    ``seasonal_fire_count`` earlier days of the same year, and
    ``never_burned_before`` is 1 until a day after the first fire.
    """
    by_day = Window.partitionBy("h3_cell").orderBy("_day")
    earlier = by_day.rowsBetween(Window.unboundedPreceding, -1)
    season = Window.partitionBy("h3_cell", "_year").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    last_fire = F.max(F.when(F.col("fires") > 0, F.col("_day"))).over(earlier)
    days = _daily_fires(unified).withColumn("_year", F.year("event_date"))
    return days.select(
        "h3_cell",
        "event_date",
        F.coalesce(F.sum("fires").over(by_day.rangeBetween(-7, -1)), F.lit(0)).alias("fires_cell_last_7d"),
        F.coalesce(F.sum("fires").over(by_day.rangeBetween(-30, -1)), F.lit(0)).alias("fires_cell_last_30d"),
        (F.col("_day") - last_fire).cast("int").alias("days_since_last_fire"),
        F.coalesce(F.sum("fires").over(season), F.lit(0)).alias("seasonal_fire_count"),
        F.when(last_fire.isNull(), 1).otherwise(0).alias("never_burned_before"),
    )


def precipitation_7d(unified: DataFrame) -> DataFrame:
    """Rain of the day and of the seven days ending with it, per cell."""
    is_meteo = same_text(F.col("source_type"), "meteo")
    days = (
        unified.groupBy("h3_cell", "event_date")
        .agg(F.coalesce(F.sum(F.when(is_meteo, F.col("precipitation"))), F.lit(0.0)).alias("precipitation_1d"))
        .withColumn("_day", F.unix_date("event_date").cast("bigint"))
    )
    week = Window.partitionBy("h3_cell").orderBy("_day").rangeBetween(-6, 0)
    return days.select(
        "h3_cell",
        "event_date",
        "precipitation_1d",
        F.sum("precipitation_1d").over(week).alias("precipitation_true_7d"),
    )


def recent_maxima(unified: DataFrame, span_ms: int = 600_000) -> DataFrame:
    """Sensor maxima and event times over the ten minutes up to each event, ends included.

    Time is cut into segments as long as the span, so the span of an event is
    the start of its own segment up to the event, plus the end of the segment
    before. Every event therefore lies in its segment and, one span later, in
    the next. The first part is a running maximum forwards over the segment's
    own events; the second is one backwards over the shifted ones. Both read
    the same shuffle, take one pass however dense the events are, and a (cell,
    segment) is the unit of work.
    """
    fire, sensor = (same_text(F.col("source_type"), s) for s in ("fire", "sensor"))
    values = {
        "smoke": F.when(sensor, F.col("smoke")),
        "co2": F.when(sensor, F.col("co2")),
        "sensor_temperature": F.when(sensor, F.col("sensor_temperature")),
        "sensor_time": F.when(sensor, F.col("event_time")),
        "fire_time": F.when(fire, F.col("event_time")),
    }
    rows = unified.select("h3_cell", "seq", "event_time", *[v.alias(n) for n, v in values.items()])
    placed = rows.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("_later")).withColumns(
        {
            "_at": F.col("event_time") + F.col("_later") * span_ms,
            "_segment": F.floor(F.col("event_time") / F.lit(span_ms)).cast("bigint") + F.col("_later"),
        }
    )
    segment = Window.partitionBy("h3_cell", "_segment")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    forwards = segment.orderBy("_at").rangeBetween(*so_far)
    backwards = segment.orderBy(F.desc("_at")).rangeBetween(*so_far)

    def own(value: str):
        return F.when(F.col("_later") == 0, F.col(value))

    def shifted(value: str):
        return F.when(F.col("_later") == 1, F.col(value))

    def newest(value: str):
        return F.greatest(F.max(own(value)).over(forwards), F.max(shifted(value)).over(backwards))

    alerts = F.count(own("sensor_time")).over(forwards) + F.count(shifted("sensor_time")).over(backwards)
    return placed.select(
        "h3_cell",
        "seq",
        "event_time",
        "_later",
        newest("smoke").alias("max_smoke_10m"),
        newest("co2").alias("max_co2_10m"),
        newest("sensor_temperature").alias("max_sensor_temp_10m"),
        alerts.alias("sensor_alerts_10m"),
        newest("sensor_time").alias("last_sensor_time"),
        newest("fire_time").alias("last_fire_time"),
    ).filter("_later = 0").drop("_later")


def latest_weather(unified: DataFrame) -> DataFrame:
    """Newest weather reading per cell; ties in time go to the later arrival."""
    reading = F.struct("event_time", "temperature", "humidity", "wind_speed", "precipitation", "soil_moisture", "vpd")
    return (
        unified.filter(same_text(F.col("source_type"), "meteo"))
        .groupBy("h3_cell")
        .agg(F.max_by(reading, F.struct("event_time", "seq")).alias("r"))
        .select("h3_cell", "r.*")
    )
