"""The whole risk job: events in, five tables out, batch or micro-batch."""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.operators import confirm
from cellwatch.operators.enrich import (
    REASON,
    STAGE,
    control_events,
    locate,
    marked_keys,
    marked_snapshots,
    unify_fire,
    unify_sensor,
    weather_snapshots,
)
from cellwatch.operators.scoring import RiskModel
from cellwatch.operators.skew import SplitPolicy
from cellwatch.schemas import (
    OUTCOME_SCHEMA,
    PREDICTION_COLUMNS,
    PREDICTION_SCHEMA,
    QUARANTINE_COLUMNS,
    QUARANTINE_SCHEMA,
    SNAPSHOT_COLUMNS,
    SNAPSHOT_SCHEMA,
    TRAINING_SCHEMA,
)
from cellwatch.session import materialise
from cellwatch.sinks.tables import DATE, Table
from cellwatch.sources.dimensions import one_per_cell
from cellwatch.sources.streams import decoded

_ROW = ["h3_cell", "seq", "event_date", "event_time", "source", "snapshot", "prediction"]


@dataclass(frozen=True)
class RiskJob:
    """Dimensions and model of a job, and the frames it derives from events.

    Event frames are typed (``sources.decode``) and carry ``seq``, the arrival
    order within a cell. ``static`` is reduced to one row per cell: the last by
    the column ``static_order`` where that is given.
    """

    static: DataFrame
    adjacency: DataFrame
    model: RiskModel
    index: DataFrame | None = None
    policy: SplitPolicy = SplitPolicy()
    late: str = "rollover"
    static_order: str | None = None

    def __post_init__(self):
        if self.static is not None:
            order = F.col(self.static_order) if self.static_order else None
            object.__setattr__(self, "static", one_per_cell(self.static, order))

    def snapshots(self, weather: DataFrame) -> DataFrame:
        return weather_snapshots(weather, self.static, self.index, ("seq",))

    def scored(self, weather: DataFrame) -> DataFrame:
        return self.model.predict_regular(self.snapshots(weather))

    def control(self, sensor: DataFrame, fire: DataFrame) -> DataFrame:
        """Control events; the confirmation reads nothing of the dimension, so it is not joined."""
        return control_events(
            unify_sensor(sensor, None, self.index, ("seq",)), unify_fire(fire, None, self.index, ("seq",))
        )

    def rows(self, weather: DataFrame, sensor: DataFrame, fire: DataFrame) -> DataFrame:
        """Keyed input of the confirmation; works on tables and on streams."""
        return confirm.merge_inputs(self.scored(weather), self.control(sensor, fire))

    def marked_rows(self, weather: DataFrame, sensor: DataFrame, fire: DataFrame) -> DataFrame:
        """A row for every event: those of ``rows``, and the lost ones with ``stage``, ``reason`` and ``raw``."""
        weather, sensor, fire = (_with_raw(e) for e in (weather, sensor, fire))
        scored = self.model.predict_marked(marked_snapshots(weather, self.static, self.index, ("seq", "raw")))
        meteo = scored.select(
            "h3_cell",
            "seq",
            "event_date",
            "event_time",
            F.lit("meteo").alias("source"),
            F.struct(*SNAPSHOT_COLUMNS).cast(SNAPSHOT_SCHEMA).alias("snapshot"),
            F.struct(*[f"p.{c}" for c in PREDICTION_COLUMNS]).cast(PREDICTION_SCHEMA).alias("prediction"),
            STAGE,
            REASON,
            "raw",
        )
        parts = [meteo]
        for source, events in (("sensor", sensor), ("fire", fire)):
            parts.append(
                marked_keys(locate(events, self.index)).select(
                    "h3_cell",
                    "seq",
                    "event_date",
                    "event_time",
                    F.lit(source).alias("source"),
                    F.lit(None).cast(SNAPSHOT_SCHEMA).alias("snapshot"),
                    F.lit(None).cast(PREDICTION_SCHEMA).alias("prediction"),
                    STAGE,
                    REASON,
                    "raw",
                )
            )
        return reduce(DataFrame.unionByName, parts)

    def marked_rows_of(self, records: DataFrame) -> DataFrame:
        """``marked_rows`` of event records that have ``seq`` (``sources.streams``)."""
        events = decoded(records)
        return self.marked_rows(events["weather"], events["sensor"], events["fire"])

    def timeline(self, weather: DataFrame, sensor: DataFrame, fire: DataFrame, state: DataFrame | None = None):
        rows = self.rows(weather, sensor, fire)
        return confirm.timeline_of_rows(rows, state, self.policy, self.pairs(weather, sensor, fire), self.late)

    def pairs(self, *events: DataFrame) -> DataFrame:
        """Cell and order of all events, before any lookup or score."""
        parts = [locate(e, self.index).select("h3_cell", "seq") for e in events]
        return reduce(DataFrame.unionByName, parts).dropna()

    def alerts(self, alerts: DataFrame) -> DataFrame:
        return confirm.alert_predictions(alerts)

    def neighbors(self, alerts: DataFrame) -> DataFrame:
        return confirm.neighbor_predictions(alerts, self.adjacency, self.model.predict_neighbor)

    def predictions(self, rows: DataFrame, alerts: DataFrame) -> DataFrame:
        """Regular, alert and neighbour predictions, all with ``seq``.

        ``rows`` are the scored rows and ``alerts`` the few alert rows of one
        walk over them (``confirm.alert_rows``); both are best written first.
        """
        regular = rows.filter("source = 'meteo'").select("prediction.*", "seq")
        return (
            regular.select(*PREDICTION_COLUMNS, "seq").unionByName(self.alerts(alerts)).unionByName(self.neighbors(alerts))
        )

    def all_predictions(self, weather: DataFrame, sensor: DataFrame, fire: DataFrame) -> DataFrame:
        """Every prediction of a batch: events are read and scored once, and walked once."""
        rows = materialise(self.rows(weather, sensor, fire), "scored")
        walked = confirm.timeline_of_rows(rows, None, self.policy, late=self.late)
        return self.predictions(rows, materialise(confirm.alert_rows(walked), "alerts"))


def _with_raw(events: DataFrame) -> DataFrame:
    return events if "raw" in events.columns else events.withColumn("raw", F.lit(None).cast("string"))


@dataclass(frozen=True)
class Tables:
    """The output tables under one root; ``run`` names the checkpoint that writes them."""

    root: str
    run: str = "main"

    def _table(self, name: str, schema, *keys: str) -> Table:
        return Table(os.path.join(self.root, name), schema, keys)

    @property
    def snapshots(self) -> Table:
        return self._table("feature_snapshots", SNAPSHOT_SCHEMA)

    @property
    def predictions(self) -> Table:
        return self._table("predictions", PREDICTION_SCHEMA)

    @property
    def outcomes(self) -> Table:
        return self._table("daily_h3_outcomes", OUTCOME_SCHEMA, "h3_cell", DATE)

    @property
    def training(self) -> Table:
        return self._table("daily_h3_training_dataset", TRAINING_SCHEMA, "h3_cell", DATE)

    @property
    def quarantine(self) -> Table:
        return self._table("quarantine", QUARANTINE_SCHEMA)

    @property
    def state(self) -> Table:
        """Newest state of every cell, of this run alone: a new run starts from nothing."""
        return self._table(f"state-{self.run}", confirm.STATE_SCHEMA, "h3_cell")

    def all(self) -> list[Table]:
        return [self.snapshots, self.predictions, self.outcomes, self.training, self.quarantine, self.state]


def _quarantined(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.to_json(F.struct("seq")).alias("seq") if c == "seq" else F.col(c) for c in QUARANTINE_COLUMNS]
    )


def write_batch(job: RiskJob, rows: DataFrame, tables: Tables, batch_id: int, fold_every: int = 60) -> None:
    """Confirm one batch of keyed rows, starting from the state of the batches before.

    Each table is committed on its own and the state last, so a batch that died
    half-way is run again in full: what it had committed is replaced by equal
    rows. A batch whose forerunner has no committed state stops the run rather
    than start from nothing. ``rows`` come from ``RiskJob.rows`` or, with their
    lost events, from ``RiskJob.marked_rows``; input rows are then the rows
    walked plus the rows in quarantine before the stage ``neighbor``. Rows and
    alerts are kept for the steps that share them; lost blocks are recomputed.
    Only cells with rows get new state. Every ``fold_every`` batches the tables
    are folded, which removes what is not needed any more.
    """
    spark, run = rows.sparkSession, tables.run
    if batch_id and not tables.state.has(spark, run, batch_id - 1):
        raise ValueError(f"no state of batch {batch_id - 1} of run {run} under {tables.root}")
    rows = rows.persist()
    walked = alerts = None
    try:
        good = rows
        if STAGE in rows.columns:
            good = rows.filter(F.col(STAGE).isNull())
        good = good.select(_ROW).dropna(subset=["h3_cell", "event_date", "seq"])
        cells = good.select("h3_cell").distinct()
        state = tables.state.read(spark, run, batch_id).join(cells, "h3_cell", "left_semi") if batch_id else None
        if state is not None:
            state = state.select(confirm.STATE_SCHEMA.fieldNames())
        walked = confirm.timeline_of_rows(good, state, job.policy, late=job.late).persist()
        alerts = confirm.alert_rows(walked).persist()
        snapshots = good.filter("source = 'meteo'").select("snapshot.*").select(*SNAPSHOT_COLUMNS)
        tables.snapshots.write(snapshots, run, batch_id)
        tables.predictions.write(job.predictions(good, alerts).select(*PREDICTION_COLUMNS), run, batch_id)
        tables.outcomes.write(confirm.daily_outcomes(walked), run, batch_id)
        tables.training.write(confirm.daily_training(walked), run, batch_id)
        if STAGE in rows.columns:
            lost = job.model.unscorable(confirm.neighbor_snapshots(alerts, job.adjacency)).select(
                F.lit("neighbor").alias("stage"),
                F.col("reject_reason").alias("reason"),
                F.lit("meteo").alias("source"),
                "h3_cell",
                "event_date",
                "event_time",
                "seq",
                F.lit(None).cast("string").alias("raw"),
            )
            refused = rows.filter(F.col(STAGE).isNotNull()).select(QUARANTINE_COLUMNS)
            tables.quarantine.write(_quarantined(refused.unionByName(lost)), run, batch_id)
        tables.state.write(confirm.final_state(walked), run, batch_id)
        if batch_id and batch_id % fold_every == 0:
            for table in tables.all():
                table.compact(spark, run, batch_id)
    finally:
        for kept in (alerts, walked, rows):
            if kept is not None:
                kept.unpersist()


def snapshot_scores(snapshots: DataFrame, model: RiskModel) -> tuple[DataFrame, DataFrame]:
    """Window snapshots and their scores; a snapshot that cannot be scored stays in the first."""
    scored = model.predict(snapshots, "window")
    return snapshots, scored.select(*[F.col(f"p.{c}").alias(c) for c in PREDICTION_COLUMNS])
