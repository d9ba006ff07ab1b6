"""History of cells carried from batch to batch: earlier events are not read again.

``history_step`` takes a batch of unified events and one state row per cell, and
gives the rows of ``history.fire_history`` and ``history.precipitation_7d`` for
the days of the batch, and new states. A state holds the newest day, sums of the
days that windows still reach (at most ``RING_DAYS`` and the newest one), and of
all days before the newest the last one with a fire and the fires of its year;
its size does not grow with time. A batch may go on with a cell's newest day:
that day's row is given again with all its events, so tables are keyed by cell
and day.

``maxima_step`` does the same for ``history.recent_maxima``: what it carries are
the events of the last span of every cell, as rows, however many they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellwatch.functions.scalars import same_text
from cellwatch.operators.history import recent_maxima

# The longest window, in days before a day.
RING_DAYS = 30
HISTORY_STATE = (
    "h3_cell string, newest bigint, days array<struct<day: bigint, fires: bigint, rain: double>>, "
    "last_fire bigint, season_fires bigint"
)
_EVENT = ["h3_cell", "seq", "event_time", "source_type", "smoke", "co2", "sensor_temperature"]


def _year(day: Column) -> Column:
    return F.year(F.date_from_unix_date(day.cast("int")))


def _batch_days(unified: DataFrame) -> DataFrame:
    fire, meteo = (same_text(F.col("source_type"), s) for s in ("fire", "meteo"))
    kept = unified.filter("h3_cell IS NOT NULL AND event_date IS NOT NULL")
    return kept.groupBy("h3_cell", F.unix_date("event_date").cast("bigint").alias("day")).agg(
        F.count_if(fire).alias("fires"), F.coalesce(F.sum(F.when(meteo, F.col("precipitation"))), F.lit(0.0)).alias("rain")
    )


def history_step(unified: DataFrame, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the batch's cells and days, and the new states of its cells; other states stay as they are.

    ``state`` has one row per cell, as given before. Events without a cell or a
    date, and those of days before the newest of their cell's state, are left
    out. Both results read the batch, so it should be a stored table.
    """
    new = _batch_days(unified)
    old = unified.sparkSession.createDataFrame([], HISTORY_STATE) if state is None else state
    old = old.select("h3_cell", "newest", "days", "last_fire", "season_fires")
    new = new.join(old.select("h3_cell", "newest"), "h3_cell", "left").filter("newest IS NULL OR day >= newest").drop("newest")
    fresh = new.select("h3_cell", "day", "fires", "rain", F.lit(True).alias("fresh"))
    seed = F.col("d.day") == F.col("newest")
    carried = (
        old.join(new.select("h3_cell").distinct(), "h3_cell", "left_semi")
        .select("h3_cell", "newest", "last_fire", "season_fires", F.explode("days").alias("d"))
        .select(
            "h3_cell", "d.day", "d.fires", "d.rain", F.lit(False).alias("fresh"), (F.col("d.day") < F.col("newest")).alias("past"),
            F.when(seed, F.col("last_fire")).alias("seed_fire"), F.when(seed, F.col("season_fires")).alias("seed_season"),
        )
    )
    days = (
        fresh.unionByName(carried, allowMissingColumns=True)
        .groupBy("h3_cell", "day")
        .agg(
            F.sum("fires").alias("fires"), F.sum("rain").alias("rain"), F.bool_or("fresh").alias("fresh"),
            F.coalesce(F.bool_or("past"), F.lit(False)).alias("past"), F.max("seed_fire").alias("seed_fire"),
            F.coalesce(F.max("seed_season"), F.lit(0)).alias("seed_season"),
        )
        .withColumn("year", _year(F.col("day")))
    )
    by_day = Window.partitionBy("h3_cell").orderBy("day")
    in_year = Window.partitionBy("h3_cell", "year").orderBy("day")
    first, here, before = Window.unboundedPreceding, Window.currentRow, -1
    # Past days count in windows; for all else the seed at the newest day stands for them.
    own_fires = F.when(F.col("past"), F.lit(0)).otherwise(F.col("fires"))
    fire_day = F.when(~F.col("past") & (F.col("fires") > 0), F.col("day"))
    rows = days.withColumns({
        "week": F.coalesce(F.sum("fires").over(by_day.rangeBetween(-7, -1)), F.lit(0)),
        "month": F.coalesce(F.sum("fires").over(by_day.rangeBetween(-RING_DAYS, -1)), F.lit(0)),
        "rain_week": F.sum("rain").over(by_day.rangeBetween(-6, 0)),
        "fire_before": F.greatest(
            F.max(fire_day).over(by_day.rowsBetween(first, before)), F.max("seed_fire").over(by_day.rowsBetween(first, here))
        ),
        "season": F.coalesce(F.sum(own_fires).over(in_year.rowsBetween(first, before)), F.lit(0))
        + F.sum("seed_season").over(in_year.rowsBetween(first, here)),
    })
    out = rows.filter("fresh").select(
        "h3_cell",
        F.date_from_unix_date(F.col("day").cast("int")).alias("event_date"),
        F.col("week").alias("fires_cell_last_7d"),
        F.col("month").alias("fires_cell_last_30d"),
        (F.col("day") - F.col("fire_before")).cast("int").alias("days_since_last_fire"),
        F.col("season").alias("seasonal_fire_count"),
        F.when(F.col("fire_before").isNull(), 1).otherwise(0).alias("never_burned_before"),
        F.col("rain").alias("precipitation_1d"),
        F.col("rain_week").alias("precipitation_true_7d"),
    )
    newest = F.max("day").over(Window.partitionBy("h3_cell"))
    ring = rows.withColumn("newest", newest).filter(F.col("day") >= F.col("newest") - RING_DAYS)
    states = ring.groupBy("h3_cell", "newest").agg(
        F.sort_array(F.collect_list(F.struct("day", "fires", "rain"))).alias("days"),  # a row per day of the ring
        F.max_by("fire_before", "day").alias("last_fire"),
        F.max_by("season", "day").alias("season_fires"),
    )
    return out, states


def maxima_step(unified: DataFrame, tail: DataFrame | None = None, span_ms: int = 600_000) -> tuple[DataFrame, DataFrame]:
    """Recent maxima of a batch's events, and the tail of events that the next batch needs.

    Batches follow each other in event time within a cell: an event sees all
    kept events of the span up to it, and changes no row given before. Rows of
    ``tail`` are those that this function gave; cells without new events keep
    theirs. Events without a cell or time are left out.
    """
    marked = unified.select(*_EVENT).filter("h3_cell IS NOT NULL AND event_time IS NOT NULL").withColumn("_new", F.lit(True))
    if tail is not None:
        marked = marked.unionByName(tail.select(*_EVENT).withColumn("_new", F.lit(False)))
    recent = recent_maxima(marked.withColumn("seq", F.struct("_new", "seq")).drop("_new"), span_ms)
    rows = recent.filter("seq._new").withColumn("seq", F.col("seq.seq"))
    last = marked.groupBy("h3_cell").agg(F.max("event_time").alias("_last"))
    kept = marked.join(last, "h3_cell").filter(F.col("event_time") >= F.col("_last") - span_ms)
    return rows, kept.select(*_EVENT)
