"""Confirmation of incidents by following each cell through each day.

Rows of a cell are read in ``seq`` order. A run of rows with one event date is
an *island*; a row with another date closes it and opens the next. Inside an
island the operator remembers the latest scored snapshot, whether a sensor and
a fire were seen, and whether an alert went out.

``timeline`` computes that memory for every row with running windows that all
share one partitioning and one sort. Cells that hold a large share of the rows
are cut into ordered parts (see ``skew``). Each part is first walked on its
own, the state at the part ends is folded in part order, and every later part
then starts from a seed row with the state the parts before it left behind.
The same seed rows let a run continue from the state of an earlier run.

``seq`` may be of any type that sorts, such as a number or the struct that
``sources.streams`` makes. Rows of a cell with equal ``seq`` are ordered by
their source, time and contents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwatch.functions.calendar import slot_label
from cellwatch.functions.scalars import same_text
from cellwatch.operators.skew import CUTS, PART, SplitPolicy, cut_points, part_of
from cellwatch.schemas import (
    OUTCOME_COLUMNS,
    PREDICTION_COLUMNS,
    PREDICTION_SCHEMA,
    SNAPSHOT_COLUMNS,
    SNAPSHOT_SCHEMA,
    TRAINING_COLUMNS,
)
from cellwatch.session import materialise

SEED = "state"

_SEED_FLAGS = ["seed_sensor", "seed_fire", "seed_alert"]

# Columns of the state frame handed from one run to the next.
STATE_SCHEMA = T.StructType(
    [
        T.StructField("h3_cell", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("snapshot", SNAPSHOT_SCHEMA),
        T.StructField("prediction", PREDICTION_SCHEMA),
        T.StructField("sensor_on", T.BooleanType()),
        T.StructField("fire_on", T.BooleanType()),
        T.StructField("alerted", T.BooleanType()),
    ]
)


def _meteo_rows(scored: DataFrame) -> DataFrame:
    return scored.filter("p.prediction is not null").select(
        "h3_cell",
        "seq",
        "event_date",
        "event_time",
        F.lit("meteo").alias("source"),
        F.struct(*SNAPSHOT_COLUMNS).cast(SNAPSHOT_SCHEMA).alias("snapshot"),
        F.struct(*[f"p.{c}" for c in PREDICTION_COLUMNS]).cast(PREDICTION_SCHEMA).alias("prediction"),
    )


def _control_rows(control: DataFrame) -> DataFrame:
    return control.select(
        "h3_cell",
        "seq",
        "event_date",
        "event_time",
        F.lower("source_type").alias("source"),
        F.lit(None).cast(SNAPSHOT_SCHEMA).alias("snapshot"),
        F.lit(None).cast(PREDICTION_SCHEMA).alias("prediction"),
    )


def merge_inputs(scored: DataFrame, control: DataFrame) -> DataFrame:
    """Scored snapshots and control events as one keyed, ordered input.

    ``scored`` has the snapshot columns, ``seq`` and the prediction in a struct
    ``p``; ``control`` has the unified event columns and ``seq``. Rows without
    a cell or date take no part.
    """
    rows = _meteo_rows(scored).unionByName(_control_rows(control))
    return rows.filter("h3_cell is not null and event_date is not null and seq is not null")


def _with_seed_flags(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.lit(False) for c in _SEED_FLAGS})


def _seed_rows(state: DataFrame, seq_type: T.DataType) -> DataFrame:
    return state.select(
        "h3_cell",
        F.lit(None).cast(seq_type).alias("seq"),
        "event_date",
        F.lit(None).cast("bigint").alias("event_time"),
        F.lit(SEED).alias("source"),
        F.col("snapshot").cast(SNAPSHOT_SCHEMA).alias("snapshot"),
        F.col("prediction").cast(PREDICTION_SCHEMA).alias("prediction"),
        F.col("sensor_on").alias("seed_sensor"),
        F.col("fire_on").alias("seed_fire"),
        F.col("alerted").alias("seed_alert"),
        *[F.col(c) for c in (PART,) if c in state.columns],
    )


def _at_or_after(position: Column, start: Column) -> Column:
    return F.coalesce(position >= start, F.lit(False))


def _ranked(rows: DataFrame) -> DataFrame:
    """Columns that order a cell's rows: seeds first, and what tells rows of equal ``seq`` apart."""
    return rows.withColumns(
        {"_rank": F.col("source") != SEED, "_tie": F.xxhash64("source", "event_time", "event_date", "snapshot")}
    )


def _in_order(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("_rank", "seq", "_tie")


def _walk(rows: DataFrame, keys: list[str]) -> DataFrame:
    """State of every row's island after the row, by running windows over row numbers."""
    in_order = _in_order(keys)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = _ranked(rows)

    def latest(condition: Column) -> Column:
        return F.max(F.when(condition, F.col("pos"))).over(so_far)

    is_sensor = F.col("source") == "sensor"
    is_fire = F.col("source") == "fire"
    has_row = F.col("snapshot").isNotNull()

    step = rows.withColumns(
        {
            "pos": F.row_number().over(in_order),
            "prev_date": F.lag("event_date").over(in_order),
            "next_date": F.lead("event_date").over(in_order),
            "next_seq": F.lead("seq").over(in_order),
        }
    ).withColumn("opens", F.col("prev_date").isNull() | (F.col("prev_date") != F.col("event_date")))
    step = step.withColumns(
        {
            "island_at": latest(F.col("opens")),
            "snap_at": latest(has_row),
            "sensor_at": latest(is_sensor | F.col("seed_sensor")),
            "fire_at": latest(is_fire | F.col("seed_fire")),
            "held": F.last(F.when(has_row, F.struct("snapshot", "prediction")), ignorenulls=True).over(so_far),
        }
    ).drop("snapshot", "prediction")
    step = step.withColumns(
        {
            "has_snapshot": _at_or_after(F.col("snap_at"), F.col("island_at")),
            "sensor_on": _at_or_after(F.col("sensor_at"), F.col("island_at")),
            "fire_on": _at_or_after(F.col("fire_at"), F.col("island_at")),
        }
    ).withColumns(
        {
            "held": F.when(F.col("has_snapshot"), F.col("held")),
            "candidate": F.col("has_snapshot") & (is_sensor | (is_fire & F.col("sensor_on"))),
        }
    )
    alerting = F.max(F.when(F.col("candidate") | F.col("seed_alert"), F.col("pos")))
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    step = step.withColumns({"alert_at": alerting.over(so_far), "_earlier_alert_at": alerting.over(before)})
    step = step.withColumns(
        {
            "alerted": _at_or_after(F.col("alert_at"), F.col("island_at")),
            "alert": F.col("candidate") & ~_at_or_after(F.col("_earlier_alert_at"), F.col("island_at")),
            "is_last": F.col("next_date").isNull(),
        }
    )
    return step.withColumn(
        "negative",
        F.coalesce(F.col("next_date") != F.col("event_date"), F.lit(False))
        & F.col("has_snapshot")
        & ~F.col("alerted"),
    ).drop("_earlier_alert_at")


def _part_seeds(hot_rows: DataFrame) -> DataFrame:
    """Seed rows for every part of a cut cell after its first one."""
    keys = ["h3_cell", PART]
    so_far = _in_order(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_control = F.col("source").isin("sensor", "fire")

    walked = _walk(hot_rows, keys).withColumns(
        {
            "first_date": F.first("event_date").over(so_far),
            "changed": F.max(F.col("opens") & F.col("prev_date").isNotNull()).over(so_far),
            "control_at": F.max(F.when(is_control, F.col("pos"))).over(so_far),
            "informed_at": F.max(F.when(is_control & F.col("has_snapshot"), F.col("pos"))).over(so_far),
        }
    )
    # One row per part: what its last island looks like on its own, and whether
    # it would alert given a snapshot and/or a sensor from the parts before.
    ends = walked.filter("is_last").select(
        "h3_cell",
        PART,
        "first_date",
        "event_date",
        "changed",
        "has_snapshot",
        "held",
        "sensor_on",
        "fire_on",
        F.col("alerted").alias("alerts_alone"),
        F.col("sensor_on").alias("alerts_with_snapshot"),
        _at_or_after(F.col("informed_at"), F.col("island_at")).alias("alerts_with_sensor"),
        _at_or_after(F.col("control_at"), F.col("island_at")).alias("alerts_with_both"),
    )
    by_part = Window.partitionBy("h3_cell").orderBy(PART)
    up_to = by_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = by_part.rowsBetween(Window.unboundedPreceding, -1)

    def last_part(condition: Column, frame) -> Column:
        return F.max(F.when(condition, F.col(PART))).over(frame)

    ends = ends.withColumn("before", F.lag("event_date").over(by_part)).withColumn(
        "fresh", F.col("changed") | F.col("before").isNull() | (F.col("before") != F.col("first_date"))
    )
    ends = ends.withColumns(
        {
            "run_at": last_part(F.col("fresh"), up_to),
            "snap_earlier": last_part(F.col("has_snapshot"), earlier),
            "sensor_earlier": last_part(F.col("sensor_on"), earlier),
            "snap_part": last_part(F.col("has_snapshot"), up_to),
            "sensor_part": last_part(F.col("sensor_on"), up_to),
            "fire_part": last_part(F.col("fire_on"), up_to),
            "held": F.last(F.when(F.col("has_snapshot"), F.col("held")), ignorenulls=True).over(up_to),
        }
    )
    knew_snapshot = _at_or_after(F.col("snap_earlier"), F.col("run_at"))
    knew_sensor = _at_or_after(F.col("sensor_earlier"), F.col("run_at"))
    ends = ends.withColumn(
        "alerts",
        F.when(knew_snapshot & knew_sensor, F.col("alerts_with_both"))
        .when(knew_snapshot, F.col("alerts_with_snapshot"))
        .when(knew_sensor, F.col("alerts_with_sensor"))
        .otherwise(F.col("alerts_alone")),
    ).withColumn("alert_part", last_part(F.col("alerts"), up_to))

    keeps = _at_or_after(F.col("snap_part"), F.col("run_at"))
    state = ends.select(
        "h3_cell",
        "event_date",
        F.when(keeps, F.col("held.snapshot")).alias("snapshot"),
        F.when(keeps, F.col("held.prediction")).alias("prediction"),
        _at_or_after(F.col("sensor_part"), F.col("run_at")).alias("sensor_on"),
        _at_or_after(F.col("fire_part"), F.col("run_at")).alias("fire_on"),
        _at_or_after(F.col("alert_part"), F.col("run_at")).alias("alerted"),
        F.lead(PART).over(by_part).alias(PART),
    ).filter(F.col(PART).isNotNull())
    return _seed_rows(state, hot_rows.schema["seq"].dataType)


def _without_late(rows: DataFrame) -> DataFrame:
    """Rows whose date is not before the newest date that their cell had until then.

    Parts look back within themselves; the newest date of the parts before
    comes from one row per part.
    """
    keys = ["h3_cell", PART]
    so_far = _in_order(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("h3_cell").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    newest = rows.groupBy(*keys).agg(F.max("event_date").alias("_date")).withColumn("_before", F.max("_date").over(earlier))
    dated = _ranked(rows).withColumn("_newest", F.max("event_date").over(so_far)).join(newest.select(*keys, "_before"), keys)
    return dated.filter(F.col("event_date") >= F.greatest("_newest", "_before")).select(rows.columns)


LATE = ("rollover", "ignore")


def timeline(
    scored: DataFrame,
    control: DataFrame,
    state: DataFrame | None = None,
    policy: SplitPolicy = SplitPolicy(),
    late: str = "rollover",
) -> DataFrame:
    """Every input row with the state of its cell and day after that row.

    ``alert`` marks the row that confirms the incident of its island and
    ``negative`` the last row of an island that had none when the row at
    ``next_seq`` closed it. Rows of source ``state`` carry earlier state into
    the run; of these only an island closed by the run's first row is emitted.
    A date change in either direction closes the day; with ``late="ignore"``
    rows dated before the newest date that their cell has had are left out.
    """
    return timeline_of_rows(merge_inputs(scored, control), state, policy, late=late)


def timeline_of_rows(
    rows: DataFrame,
    state: DataFrame | None = None,
    policy: SplitPolicy = SplitPolicy(),
    pairs: DataFrame | None = None,
    late: str = "rollover",
) -> DataFrame:
    """``timeline`` over rows that ``merge_inputs`` has already put together.

    ``pairs`` is any frame of (h3_cell, seq) that covers the rows and is cheap
    to read, such as the events before scoring; cells to cut are found from it.
    Their rows are written once, so that both walks over them share the scores.
    """
    if late not in LATE:
        raise ValueError(f"late must be one of {', '.join(LATE)}, not {late}")
    cuts = cut_points(rows if pairs is None else pairs, "h3_cell", "seq", policy)
    rows = _with_seed_flags(rows)
    if state is not None:
        rows = rows.unionByName(_seed_rows(state, rows.schema["seq"].dataType))
    if not cuts.head(1):
        whole = rows.withColumn(PART, F.lit(0))
        return _walk(_without_late(whole) if late == "ignore" else whole, ["h3_cell", PART])
    cut = rows.join(cuts, "h3_cell").withColumn(PART, part_of(F.col(CUTS), F.col("seq"))).drop(CUTS)
    whole = rows.join(cuts.select("h3_cell"), "h3_cell", "left_anti").withColumn(PART, F.lit(0))
    if late == "ignore":
        cut, whole = _without_late(cut), _without_late(whole)
    cut = materialise(cut, "cut-rows")
    return _walk(cut.unionByName(_part_seeds(cut)).unionByName(whole), ["h3_cell", PART])


def final_state(walked: DataFrame) -> DataFrame:
    """State of each cell after its last row, to start the next run from."""
    newest = Window.partitionBy("h3_cell").orderBy(F.desc(PART))
    return (
        walked.filter("is_last")
        .withColumn("_rank", F.row_number().over(newest))
        .filter("_rank = 1")
        .select(
            "h3_cell",
            "event_date",
            F.col("held.snapshot").alias("snapshot"),
            F.col("held.prediction").alias("prediction"),
            "sensor_on",
            "fire_on",
            "alerted",
        )
    )


def suspected_voluntary(fire_observed: Column, risk_level: Column) -> Column:
    """1 where a fire was observed although the last risk was low."""
    return F.when(fire_observed & same_text(risk_level, "low"), 1).otherwise(0)


def _confirmation_source(fire_observed: Column) -> Column:
    return F.when(fire_observed, "sensor_fire").otherwise("sensor")


def alert_rows(walked: DataFrame) -> DataFrame:
    """The confirming rows, with the snapshot and prediction they rest on."""
    return walked.filter("alert").select(
        "h3_cell", "seq", "event_date", "event_time", "fire_on", F.col("held.snapshot").alias("snapshot"),
        F.col("held.prediction").alias("last"),
    )


def alert_predictions(alerts: DataFrame) -> DataFrame:
    """The last prediction of each confirmed cell, restated as an alert."""
    replaced = {
        "h3_cell": F.col("last.h3_cell"),
        "event_time": F.col("event_time"),
        "event_date": F.col("event_date"),
        "trigger_type": F.lit("confirmed_alert"),
        "trigger_source": _confirmation_source(F.col("fire_on")),
        "is_neighbor_prediction": F.lit(False),
        "trigger_h3_cell": F.col("h3_cell"),
        "confirmed_alert": F.lit(True),
        "fire_observed": F.col("fire_on"),
        "sensor_confirmed": F.lit(True),
        "confirmation_time": F.col("event_time"),
        "suspected_voluntary": suspected_voluntary(F.col("fire_on"), F.col("last.risk_level")),
    }
    return alerts.select(
        *[replaced[c].alias(c) if c in replaced else f"last.{c}" for c in PREDICTION_COLUMNS], "seq"
    )


def neighbor_snapshots(alerts: DataFrame, adjacency: DataFrame) -> DataFrame:
    """Snapshots of alerting cells, taken over by each adjacent cell.

    The neighbour takes over everything except the two cell ids. Equal pairs in
    ``adjacency`` count once.
    """
    pairs = adjacency.select(F.col("h3_cell").alias("origin"), "neighbor").filter("neighbor <> origin").distinct()
    spread = alerts.select(
        F.col("h3_cell").alias("origin"), "seq", F.col("event_time").alias("confirmed_at"), "fire_on", "snapshot"
    ).join(pairs, "origin")
    own = {"h3_cell": F.col("neighbor"), "h3_commune": F.col("neighbor")}
    return spread.select(
        *[own[c].alias(c) if c in own else f"snapshot.{c}" for c in SNAPSHOT_COLUMNS],
        "origin",
        "seq",
        "confirmed_at",
        "fire_on",
    )


def neighbor_predictions(
    alerts: DataFrame, adjacency: DataFrame, score: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Alerts propagated to the adjacent cells and scored again there.

    ``score`` maps snapshots to predictions in a struct ``p``.
    """
    snapshots = neighbor_snapshots(alerts, adjacency)
    replaced = {
        "trigger_type": F.lit("neighbor_propagation"),
        "trigger_source": _confirmation_source(F.col("fire_on")),
        "is_neighbor_prediction": F.lit(True),
        "trigger_h3_cell": F.col("origin"),
        "confirmed_alert": F.lit(True),
        "fire_observed": F.col("fire_on"),
        "sensor_confirmed": F.lit(True),
        "confirmation_time": F.col("confirmed_at"),
        "prediction_slot": slot_label(F.col("event_time")),
        "suspected_voluntary": F.lit(0),
    }
    return score(snapshots).select(
        *[replaced[c].alias(c) if c in replaced else f"p.{c}" for c in PREDICTION_COLUMNS], "seq"
    )


def outcome_log(walked: DataFrame) -> DataFrame:
    """Every outcome in emission order: pending at each fire, final at the alert.

    ``sub`` orders the outcomes of one event, so that the later one wins.
    """
    is_fire = F.col("source") == "fire"

    def outcome(sub: int, sensor_confirmed: Column, fire_observed: Column, with_sensor: Column, origin: Column):
        last = F.col("held.prediction")
        snapshot_time = F.col("held.snapshot.event_time")
        values = {
            "h3_cell": F.col("h3_cell"),
            "event_date": F.col("event_date"),
            "sensor_confirmed": sensor_confirmed,
            "fire_observed": fire_observed,
            "fire_confirmed_with_sensor": with_sensor,
            "confirmation_time": F.col("event_time"),
            "confirmation_source": origin,
            "last_prediction_before_alert": last["prediction"],
            "last_probability_before_alert": last["probability"],
            "last_risk_before_alert": last["risk_level"],
            "suspected_voluntary": suspected_voluntary(fire_observed, last["risk_level"]),
            "latest_meteo_event_time": snapshot_time,
            "latest_meteo_slot": slot_label(snapshot_time),
        }
        return F.struct(
            *[values[c].alias(c) for c in OUTCOME_COLUMNS], F.col("seq").alias("seq"), F.lit(sub).alias("sub")
        )

    yes = F.lit(True)
    pending = outcome(
        0,
        F.col("sensor_on"),
        yes,
        F.col("sensor_on"),
        F.when(F.col("sensor_on"), "sensor_fire").otherwise("fire_pending"),
    )
    confirmed = outcome(1, yes, F.col("fire_on"), F.col("fire_on"), _confirmation_source(F.col("fire_on")))
    return (
        walked.filter(is_fire | F.col("alert"))
        .select(
            F.inline(
                F.array_compact(F.array(F.when(is_fire, pending), F.when(F.col("alert"), confirmed)))
            )
        )
    )


def training_log(walked: DataFrame) -> DataFrame:
    """Labelled rows: 1 at an alert, 0 for a closed day without one.

    ``seq`` is the order of the event that emitted the row.
    """
    alert = F.col("alert")
    snapshot_time = F.col("held.snapshot.event_time")
    time = F.when(alert, F.col("event_time")).otherwise(snapshot_time)
    values = {
        "event_date": F.col("event_date"),
        "input_event_time": time,
        "input_slot": slot_label(time),
        "label": F.when(alert, 1).otherwise(0),
        "confirmation_source": F.when(alert, _confirmation_source(F.col("fire_on"))).otherwise("none"),
        "suspected_voluntary": suspected_voluntary(alert & F.col("fire_on"), F.col("held.prediction.risk_level")),
        "fire_observed": F.col("fire_on"),
        "sensor_confirmed": F.col("sensor_on"),
    }
    return walked.filter(alert | F.col("negative")).select(
        *[values[c].alias(c) if c in values else f"held.snapshot.{c}" for c in TRAINING_COLUMNS],
        F.when(alert, F.col("seq")).otherwise(F.col("next_seq")).alias("seq"),
    )


def flush_open_days(walked: DataFrame) -> DataFrame:
    """Labelled rows of days that are still open, for a run that ends for good.

    Off by default everywhere: an open day normally waits for its next row.
    """
    open_days = final_state(walked).filter("snapshot is not null and not alerted")
    values = {
        "input_event_time": F.col("snapshot.event_time"),
        "input_slot": slot_label(F.col("snapshot.event_time")),
        "label": F.lit(0),
        "confirmation_source": F.lit("none"),
        "suspected_voluntary": F.lit(0),
        "fire_observed": F.col("fire_on"),
        "sensor_confirmed": F.col("sensor_on"),
        "h3_cell": F.col("h3_cell"),
        "event_date": F.col("event_date"),
    }
    return open_days.select(*[values[c].alias(c) if c in values else f"snapshot.{c}" for c in TRAINING_COLUMNS])


def latest_per_key(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last write per key. The rank filter is applied before the shuffle too."""
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return log.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def daily_outcomes(walked: DataFrame) -> DataFrame:
    return latest_per_key(outcome_log(walked), ["h3_cell", "event_date"], ["seq", "sub"]).select(OUTCOME_COLUMNS)


def daily_training(walked: DataFrame) -> DataFrame:
    return latest_per_key(training_log(walked), ["h3_cell", "event_date"], ["seq"]).select(TRAINING_COLUMNS)
