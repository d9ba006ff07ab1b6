"""Day confirmation as a keyed operator of a stream: one small typed state per cell.

Where ``confirm_stream`` runs the table form on every micro-batch, this keeps
the open day of each cell in the stream's state store: its date, what was seen,
the latest scored snapshot and the last row. Rows of a cell pass a bounded
buffer that puts them in order and are then taken many at a time: running
maxima over row positions give every row's state, as the windows of the table
form do. What leaves the operator has the columns of that form, so outcomes,
labelled rows, alerts and neighbours follow from the same functions.

State follows the order of arrival. Inside a micro-batch a row may come up to
``BUFFER`` rows of its cell too late and is still put in order; what comes later
than that counts where it arrives, as between micro-batches. All rows of a cell
in a micro-batch meet in one task, which holds a buffer of them; inputs where
single cells dominate are for ``confirm_stream``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cellwatch.operators import confirm
from cellwatch.plans.risk import RiskJob, Tables
from cellwatch.schemas import PREDICTION_COLUMNS, PREDICTION_SCHEMA, SNAPSHOT_SCHEMA
from cellwatch.session import materialise
from cellwatch.streaming.outputs import start_batches

BUFFER = 20_000
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

HELD = T.StructType([T.StructField("snapshot", SNAPSHOT_SCHEMA), T.StructField("prediction", PREDICTION_SCHEMA)])
STATE = "day int, held string, sensor_on boolean, fire_on boolean, alerted boolean, seq bigint, event_time bigint"
IN = "h3_cell string, seq bigint, day int, event_time bigint, source string, held string"
OUT = f"{IN}, alert boolean, negative boolean, sensor_on boolean, fire_on boolean, next_seq bigint"

_ORDER = ["seq", "source", "event_time", "day"]


def in_order(frames: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    """The rows of the frames in order, as far as a buffer of ``limit`` rows can put them there."""
    pool = None
    for frame in frames:
        pool = frame if pool is None else pd.concat([pool, frame], ignore_index=True)
        if len(pool) >= 2 * limit:
            pool = pool.sort_values(_ORDER, kind="stable", ignore_index=True)
            yield pool.iloc[:-limit]
            pool = pool.iloc[-limit:]
    if pool is not None and len(pool):
        yield pool.sort_values(_ORDER, kind="stable", ignore_index=True)


def advance(rows: pd.DataFrame, state: tuple | None) -> tuple[pd.DataFrame, tuple]:
    """Rows that say something (fires, alerts, days closed without one), and the state behind the last row."""
    n = len(rows) + (state is not None)

    def column(name: str, first) -> np.ndarray:
        values = rows[name].to_numpy(dtype=object)
        return values if state is None else np.concatenate([np.array([first], dtype=object), values])

    day, held, sensor_seed, fire_seed, alert_seed, last_seq, last_time = state or (None,) * 7
    days = column("day", day).astype(np.int64)
    source, kept = column("source", confirm.SEED), column("held", held)
    at, seeded = np.arange(n), np.zeros((3, n), dtype=bool)
    if state is not None:
        seeded[:, 0] = sensor_seed, fire_seed, alert_seed

    def latest(condition: np.ndarray) -> np.ndarray:
        return np.maximum.accumulate(np.where(condition, at, -1))

    opens = np.append(True, days[1:] != days[:-1])
    island = latest(opens)
    snapshot = latest(pd.notna(kept))
    has = snapshot >= island
    sensor_on = latest((source == "sensor") | seeded[0]) >= island
    fire_on = latest((source == "fire") | seeded[1]) >= island
    candidate = has & ((source == "sensor") | ((source == "fire") & sensor_on))
    alerting = latest(candidate | seeded[2])
    alerted = alerting >= island
    alert = candidate & ~(np.append(-1, alerting[:-1]) >= island)
    closes = np.append(opens[1:], False)
    negative = closes & has & ~alerted
    now = np.where(has, kept[np.maximum(snapshot, 0)], None)
    seq = column("seq", last_seq).astype(np.int64)
    time = pd.array(column("event_time", last_time), dtype="Int64")
    out = pd.DataFrame(
        {
            "seq": seq, "day": days, "event_time": time, "source": source, "held": now, "alert": alert,
            "negative": negative, "sensor_on": sensor_on, "fire_on": fire_on,
            "next_seq": pd.array(np.append(seq[1:], 0), dtype="Int64"),
        }
    )
    out.loc[n - 1, "next_seq"] = pd.NA
    said = out[(source == "fire") | alert | negative]
    end = n - 1
    new = (
        int(days[end]), now[end], bool(sensor_on[end]), bool(fire_on[end]), bool(alerted[end]), int(seq[end]),
        None if pd.isna(time[end]) else int(time[end]),
    )
    return said, new


class OpenDay(StatefulProcessor):
    """Keeps the open day of a cell and passes on what its rows say."""

    def __init__(self, limit: int = BUFFER):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.day = handle.getValueState("open_day", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.day.get() if self.day.exists() else None
        state = None if state is None else tuple(state)
        for some in in_order(rows, self.limit):
            said, state = advance(some, state)
            if len(said):
                said.insert(0, "h3_cell", key[0])
                yield said
        if state is not None:
            self.day.update(state)

    def close(self) -> None:
        pass


def open_days(rows: DataFrame, limit: int = BUFFER) -> DataFrame:
    """Stream of what keyed rows (``RiskJob.rows``) say, with the columns of ``confirm.timeline``.

    ``seq`` must be a whole number. The session's state store has to be RocksDB.
    """
    keyed = rows.filter("h3_cell is not null and event_date is not null and seq is not null").select(
        "h3_cell",
        F.col("seq").cast("bigint").alias("seq"),
        F.unix_date("event_date").alias("day"),
        "event_time",
        "source",
        F.when(F.col("snapshot").isNotNull(), F.to_json(F.struct("snapshot", "prediction"))).alias("held"),
    )
    said = keyed.groupBy("h3_cell").transformWithStateInPandas(
        OpenDay(limit), T.StructType.fromDDL(OUT), "Append", "None"
    )
    return said.withColumns(
        {"event_date": F.date_from_unix_date("day"), "held": F.from_json("held", HELD)}
    ).drop("day")


def confirm_with_state(job: RiskJob, rows: DataFrame, tables: Tables, checkpoint: str, limit: int = BUFFER, **trigger):
    """Start the keyed confirmation of a stream of rows; outcomes, labelled rows, alerts and neighbours are written.

    A micro-batch leaves the operator once and is written before its tables are
    made from it. Tables are committed by the query's id and batch number, so a
    batch that is run again after a restart replaces its own rows.
    """
    rows.sparkSession.conf.set(STORE, ROCKSDB)

    def write(batch: DataFrame, batch_id: int, run: str) -> None:
        said = materialise(batch, "said")
        alerts = confirm.alert_rows(said)
        tables.outcomes.write(confirm.daily_outcomes(said), run, batch_id)
        tables.training.write(confirm.daily_training(said), run, batch_id)
        confirmed = job.alerts(alerts).unionByName(job.neighbors(alerts))
        tables.predictions.write(confirmed.select(*PREDICTION_COLUMNS), run, batch_id)

    return start_batches(open_days(rows, limit), write, checkpoint, trigger)
