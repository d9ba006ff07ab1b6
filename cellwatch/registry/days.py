"""Queries over the day confirmation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwatch.operators import confirm
from cellwatch.plans import driver_tables as dt
from cellwatch.registry.common import EV, UNIFIED, day, num, query, scores, slot, sql
from cellwatch.registry.inputs import ADJACENCY
from cellwatch.registry.scores import PREDICTION_SELECT, REGULAR, SCORED
from cellwatch.schemas import PREDICTION_COLUMNS, TRAINING_FEATURES


def walked(spark, sf_dir):
    ev = dt.events(spark, sf_dir)
    return dt.job(spark, sf_dir).timeline(dt.weather(ev), dt.sensors(ev), dt.fires(ev))


# The same rules in SQL, from per-island facts: first snapshot, first sensor
# event, first row that can alert. Snapshots are looked up by their order.
ISLANDS = """rows AS (
  SELECT seq, h3_cell, event_date, event_time, source_type FROM uni WHERE source_type <> 'meteo'
  UNION ALL SELECT seq, h3_cell, event_date, event_time, 'meteo' FROM sc),
marked AS (
  SELECT *, CASE WHEN event_date = lag(event_date) OVER w THEN 0 ELSE 1 END AS change FROM rows
  WINDOW w AS (PARTITION BY h3_cell ORDER BY seq)),
isl AS (
  SELECT *, sum(change) OVER (PARTITION BY h3_cell ORDER BY seq) AS island FROM marked),
facts AS (
  SELECT h3_cell, island, any_value(event_date) AS event_date, min(seq) FILTER (source_type = 'meteo') AS first_snap,
         max(seq) FILTER (source_type = 'meteo') AS last_snap, min(seq) FILTER (source_type = 'sensor') AS first_sensor,
         min(seq) FILTER (source_type = 'fire') AS first_fire,
         island < max(island) OVER (PARTITION BY h3_cell) AS closed
  FROM isl GROUP BY h3_cell, island),
firsts AS (
  SELECT i.h3_cell, i.island, min(i.seq) AS alert_seq
  FROM isl i JOIN facts f ON f.h3_cell = i.h3_cell AND f.island = i.island
  WHERE i.seq > f.first_snap AND (i.source_type = 'sensor' OR (i.source_type = 'fire' AND i.seq > f.first_sensor))
  GROUP BY i.h3_cell, i.island),
ctl AS (
  SELECT i.seq, i.h3_cell, i.event_date, i.event_time, i.source_type, coalesce(i.seq = a.alert_seq, false) AS alert,
         coalesce(f.first_sensor <= i.seq, false) AS sensor_on, coalesce(f.first_fire <= i.seq, false) AS fire_on,
         (SELECT max(m.seq) FROM isl m WHERE m.h3_cell = i.h3_cell AND m.island = i.island
            AND m.source_type = 'meteo' AND m.seq < i.seq) AS snap_seq
  FROM isl i JOIN facts f ON f.h3_cell = i.h3_cell AND f.island = i.island
  LEFT JOIN firsts a ON a.h3_cell = i.h3_cell AND a.island = i.island
  WHERE i.source_type <> 'meteo' AND (i.source_type = 'fire' OR i.seq = a.alert_seq)),
held AS (
  SELECT c.*, s.prediction, s.probability, s.risk_level, s.event_time AS snap_time
  FROM ctl c LEFT JOIN sc s ON s.seq = c.snap_seq)"""

CONFIRM = (*SCORED, UNIFIED, ISLANDS)

_SOURCE = "CASE WHEN fire_on THEN 'sensor_fire' ELSE 'sensor' END"
_LOW = "CASE WHEN fire_on AND risk_level = 'LOW' THEN 1 ELSE 0 END"

ALERTS = f"""alerts AS (
  SELECT seq, h3_cell, event_time, event_date, prediction, probability, risk_level, {_LOW} AS suspected_voluntary,
         'confirmed_alert' AS trigger_type, {_SOURCE} AS trigger_source, false AS is_neighbor_prediction,
         h3_cell AS trigger_h3_cell, true AS confirmed_alert, fire_on AS fire_observed, true AS sensor_confirmed,
         event_time AS confirmation_time, {slot("snap_time")} AS prediction_slot
  FROM held WHERE alert)"""

NEIGHBORS = (
    ADJACENCY,
    """spread AS (
  SELECT s.* REPLACE (adj.neighbor AS h3_commune, adj.neighbor AS h3_cell, h.seq AS seq), h.h3_cell AS origin,
         h.event_time AS confirmed_at, h.fire_on
  FROM held h JOIN snap s ON s.seq = h.snap_seq JOIN adj ON adj.h3_cell = h.h3_cell WHERE h.alert)""",
    scores("spread", "ns"),
    f"""nb AS (
  SELECT seq, h3_cell, event_time, event_date, prediction, probability, risk_level, 0 AS suspected_voluntary,
         'neighbor_propagation' AS trigger_type, {_SOURCE} AS trigger_source, true AS is_neighbor_prediction,
         origin AS trigger_h3_cell, true AS confirmed_alert, fire_on AS fire_observed, true AS sensor_confirmed,
         confirmed_at AS confirmation_time, {slot("event_time")} AS prediction_slot
  FROM ns)""",
)


@query("confirmed_alerts", sql(*CONFIRM, ALERTS, select=f"SELECT {PREDICTION_SELECT} FROM alerts"))
def confirmed_alerts(spark, sf_dir):
    return confirm.alert_predictions(confirm.alert_rows(walked(spark, sf_dir)))


@query("neighbor_propagation", sql(*CONFIRM, *NEIGHBORS, select=f"SELECT {PREDICTION_SELECT} FROM nb"))
def neighbor_propagation(spark, sf_dir):
    job = dt.job(spark, sf_dir)
    return job.neighbors(confirm.alert_rows(walked(spark, sf_dir)))


@query(
    "all_predictions",
    sql(
        *CONFIRM,
        ALERTS,
        REGULAR,
        *NEIGHBORS,
        select=f"""SELECT {PREDICTION_SELECT} FROM
  (SELECT * FROM alerts UNION ALL BY NAME SELECT * FROM reg UNION ALL BY NAME SELECT * FROM nb)""",
    ),
)
def all_predictions(spark, sf_dir):
    ev = dt.events(spark, sf_dir)
    found = dt.job(spark, sf_dir).all_predictions(dt.weather(ev), dt.sensors(ev), dt.fires(ev))
    return found.select("seq", *PREDICTION_COLUMNS)


OUTCOMES = f"""outs AS (
  SELECT seq, 0 AS sub, h3_cell, event_date, sensor_on AS sensor_confirmed, true AS fire_observed,
         sensor_on AS fire_confirmed_with_sensor, event_time AS confirmation_time,
         CASE WHEN sensor_on THEN 'sensor_fire' ELSE 'fire_pending' END AS confirmation_source,
         prediction AS last_prediction_before_alert, probability AS last_probability_before_alert,
         risk_level AS last_risk_before_alert, CASE WHEN risk_level = 'LOW' THEN 1 ELSE 0 END AS suspected_voluntary,
         snap_time AS latest_meteo_event_time, {slot("snap_time")} AS latest_meteo_slot
  FROM held WHERE source_type = 'fire'
  UNION ALL
  SELECT seq, 1, h3_cell, event_date, true, fire_on, fire_on, event_time, {_SOURCE}, prediction, probability,
         risk_level, {_LOW}, snap_time, {slot("snap_time")}
  FROM held WHERE alert)"""
_OUTCOME_SELECT = f"""h3_cell, {day()}, sensor_confirmed, fire_observed, fire_confirmed_with_sensor, confirmation_time,
  confirmation_source, last_prediction_before_alert, {num("last_probability_before_alert")}, last_risk_before_alert,
  suspected_voluntary, latest_meteo_event_time, latest_meteo_slot"""
DAILY_OUTCOMES_SQL = sql(
    *CONFIRM,
    OUTCOMES,
    select=f"""SELECT {_OUTCOME_SELECT} FROM (SELECT *, row_number() OVER
  (PARTITION BY h3_cell, event_date ORDER BY seq DESC, sub DESC) AS rn FROM outs) WHERE rn = 1""",
)


@query("outcome_log", sql(*CONFIRM, OUTCOMES, select=f"SELECT seq, sub, {_OUTCOME_SELECT} FROM outs"))
def outcome_log(spark, sf_dir):
    return confirm.outcome_log(walked(spark, sf_dir))


@query("daily_outcomes", DAILY_OUTCOMES_SQL)
def daily_outcomes(spark, sf_dir):
    return confirm.daily_outcomes(walked(spark, sf_dir))


_FEATURES = ", ".join(f"s.{c}" for c in TRAINING_FEATURES)
_FEATURE_NUM = [c for c in TRAINING_FEATURES if c not in ("h3_commune", "month", "is_weekend")]
TRAINING = f"""train AS (
  SELECT h.seq, s.h3_cell, h.event_date, {_FEATURES}, h.event_time AS input_event_time, 1 AS label,
         {_SOURCE} AS confirmation_source, {_LOW.replace("risk_level", "h.risk_level")} AS suspected_voluntary,
         fire_on AS fire_observed, true AS sensor_confirmed
  FROM held h JOIN snap s ON s.seq = h.snap_seq WHERE h.alert
  UNION ALL
  SELECT f.last_snap, s.h3_cell, f.event_date, {_FEATURES}, s.event_time, 0, 'none', 0,
         f.first_fire IS NOT NULL, f.first_sensor IS NOT NULL
  FROM facts f JOIN snap s ON s.seq = f.last_snap
  WHERE f.closed AND NOT EXISTS (SELECT 1 FROM firsts a WHERE a.h3_cell = f.h3_cell AND a.island = f.island))"""
DAILY_TRAINING_SQL = sql(
    *CONFIRM,
    TRAINING,
    select=f"""SELECT h3_cell, {day()}, h3_commune, {num(*_FEATURE_NUM)}, month, is_weekend, input_event_time,
  {slot("input_event_time")} AS input_slot, label, confirmation_source, suspected_voluntary, fire_observed,
  sensor_confirmed FROM (SELECT *, row_number() OVER (PARTITION BY h3_cell, event_date ORDER BY seq DESC) AS rn
  FROM train) WHERE rn = 1""",
)


@query("daily_training", DAILY_TRAINING_SQL)
def daily_training(spark, sf_dir):
    return confirm.daily_training(walked(spark, sf_dir))


OPEN_DAYS = """SELECT f.h3_cell, strftime(f.event_date, '%Y-%m-%d') AS event_date, 0 AS label,
  f.first_fire IS NOT NULL AS fire_observed, f.first_sensor IS NOT NULL AS sensor_confirmed
FROM facts f WHERE NOT f.closed AND f.last_snap IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM firsts a WHERE a.h3_cell = f.h3_cell AND a.island = f.island)"""


@query("open_days", sql(*CONFIRM, select=OPEN_DAYS))
def open_days(spark, sf_dir):
    rows = confirm.flush_open_days(walked(spark, sf_dir))
    return rows.select("h3_cell", "event_date", "label", "fire_observed", "sensor_confirmed")


# ---- dates that go back ----

# Every tenth value of k puts an event on the day before.
EV_BACK = EV.replace(
    "CAST(ts AS DATE) AS event_date",
    "CAST(ts AS DATE) - CASE WHEN CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 10 = 3 THEN 1 ELSE 0 END AS event_date",
)
_NOT_LATE = """rows AS (
  SELECT * EXCLUDE (newest) FROM (SELECT *, max(event_date) OVER (PARTITION BY h3_cell ORDER BY seq) AS newest FROM all_rows)
  WHERE event_date >= newest)"""


def _with_dates_back(text: str, ignore: bool) -> str:
    text = text.replace(EV, EV_BACK)
    return text.replace("WITH rows AS", "WITH all_rows AS").replace(",\nrows AS (", ",\nall_rows AS (").replace(
        "'meteo' FROM sc),\nmarked", f"'meteo' FROM sc),\n{_NOT_LATE},\nmarked"
    ) if ignore else text


def walked_back(spark, sf_dir, late):
    ev = dt.events(spark, sf_dir).withColumn("event_date", F.date_sub("event_date", F.when(F.col("k") % 10 == 3, 1).otherwise(0)))
    return dt.job(spark, sf_dir, late=late).timeline(dt.weather(ev), dt.sensors(ev), dt.fires(ev))


@query("rollover_outcomes", _with_dates_back(DAILY_OUTCOMES_SQL, False))
def rollover_outcomes(spark, sf_dir):
    return confirm.daily_outcomes(walked_back(spark, sf_dir, "rollover"))


@query("rollover_training", _with_dates_back(DAILY_TRAINING_SQL, False))
def rollover_training(spark, sf_dir):
    return confirm.daily_training(walked_back(spark, sf_dir, "rollover"))


@query("ignore_late_outcomes", _with_dates_back(DAILY_OUTCOMES_SQL, True))
def ignore_late_outcomes(spark, sf_dir):
    return confirm.daily_outcomes(walked_back(spark, sf_dir, "ignore"))


@query("ignore_late_training", _with_dates_back(DAILY_TRAINING_SQL, True))
def ignore_late_training(spark, sf_dir):
    return confirm.daily_training(walked_back(spark, sf_dir, "ignore"))
