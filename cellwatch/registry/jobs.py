"""Queries that run the sinks and the streams and read back what they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwatch.operators import aggregate, confirm
from cellwatch.operators.enrich import unify_fire, unify_sensor, unify_weather
from cellwatch.plans import driver_tables as dt
from cellwatch.plans.risk import RiskJob, Tables, write_batch
from cellwatch.registry.common import BASE, EV, SNAPSHOTS, UNIFIED, day, num, query, sql
from cellwatch.registry.days import (
    ALERTS,
    CONFIRM,
    DAILY_OUTCOMES_SQL,
    DAILY_TRAINING_SQL,
    NEIGHBORS,
)
from cellwatch.registry.inputs import SNAPSHOT_SELECT
from cellwatch.registry.scores import PREDICTION_SELECT, REGULAR, SCORED
from cellwatch.registry.windows import WINDOWS
from cellwatch.schemas import (
    OUTCOME_COLUMNS,
    PREDICTION_COLUMNS,
    SNAPSHOT_COLUMNS,
    SNAPSHOT_SCHEMA,
    TRAINING_COLUMNS,
)
from cellwatch.session import materialise, scratch_path
from cellwatch.sinks.manifests import read_transactions, start_transactions, write_transaction
from cellwatch.sinks.tables import Table
from cellwatch.sources.decode import accepted, decode_events, require_keys
from cellwatch.sources.record_log import log_records, write_log
from cellwatch.sources.streams import json_file_events, table_stream, with_arrival_order
from cellwatch.streaming.confirm_stream import confirm_batches, confirm_records
from cellwatch.streaming.day_state import confirm_with_state
from cellwatch.streaming.outputs import append_stream

STEPS = 3


def steps_of(df, order: str):
    """The rows in ``STEPS`` steps of equal width in ``order``."""
    low, high = df.agg(F.min(order), F.max(order)).first()
    cuts = [low + (high + 1 - low) * k // STEPS for k in range(STEPS + 1)]
    return [df.filter((F.col(order) >= a) & (F.col(order) < b)) for a, b in zip(cuts, cuts[1:])]


def files_of(df) -> int:
    """How many files a step of the table gets: as many as the scan has tasks, and several anyway."""
    return max(4, df.rdd.getNumPartitions())


def arriving(df, order: str, path: str, start: int = 0, stop: int = STEPS):
    """Write ``df`` step by step, each as equally many files; a stream that takes so many at a time takes a step."""
    for step in steps_of(df, order)[start:stop]:
        step.repartition(files_of(df)).write.mode("append").parquet(path)
    return path


def _events_arriving(spark, sf_dir):
    raw = dt.table(spark, sf_dir, "events")
    path = arriving(raw, "event_id", scratch_path(spark, "events"))
    return dt.shape_events(table_stream(spark, path, raw.schema, max_files=files_of(raw)))


def _rows(job: RiskJob, ev):
    return job.rows(dt.weather(ev), dt.sensors(ev), dt.fires(ev))


def finish(running, batches: int = STEPS):
    """Wait for a stream over all that has arrived; it must have taken so many micro-batches."""
    running.awaitTermination()
    if running.exception():
        raise running.exception()
    taken = sum(1 for p in running.recentProgress if p["numInputRows"])
    if taken < batches:
        raise ValueError(f"the stream took {taken} micro-batches, not {batches}")


def _ordered_records(spark, sf_dir):
    """Records in arrival order; they are made up at some cost here and read several times, so they are written first."""
    return with_arrival_order(materialise(dt.records(spark, sf_dir), "log"))


def _halves(spark, sf_dir):
    """The events in two batches, split where half of the cells' time is over."""
    ev = dt.events(spark, sf_dir)
    middle = ev.agg(F.expr("min(seq) + (max(seq) - min(seq)) div 2").alias("m")).scalar()
    return ev.filter(F.col("seq") <= middle), ev.filter(F.col("seq") > middle)


@query("append_replayed", sql(*BASE, SNAPSHOTS, select=f"SELECT {SNAPSHOT_SELECT} FROM snap"))
def append_replayed(spark, sf_dir):
    """Batches of two runs with the same numbers; one is written twice, as after a restart."""
    table = Table(scratch_path(spark, "append"), SNAPSHOT_SCHEMA)
    snapshots = dt.job(spark, sf_dir).snapshots(dt.weather(dt.events(spark, sf_dir)))
    for run, batch, part in (("a", 0, 0), ("a", 1, 1), ("a", 0, 0), ("b", 0, 2)):
        table.write(snapshots.filter(F.col("seq") % 3 == part).select(SNAPSHOT_COLUMNS), run, batch)
    return table.read(spark)


@query("append_transactions", sql(*BASE, SNAPSHOTS, select=f"SELECT {SNAPSHOT_SELECT} FROM snap"))
def append_transactions(spark, sf_dir):
    """The same batches, each a transaction of all tasks that write it."""
    path = scratch_path(spark, "transactions")
    snapshots = dt.job(spark, sf_dir).snapshots(dt.weather(dt.events(spark, sf_dir)))
    for run, batch, part in (("a", 0, 0), ("a", 1, 1), ("a", 0, 0), ("b", 0, 2)):
        write_transaction(snapshots.filter(F.col("seq") % 3 == part).select(SNAPSHOT_COLUMNS), path, run, batch)
    return read_transactions(spark, path, SNAPSHOT_SCHEMA)


@query("stream_transactions", sql(*BASE, SNAPSHOTS, select=f"SELECT {SNAPSHOT_SELECT} FROM snap"))
def stream_transactions(spark, sf_dir):
    """A stream of snapshots, a transaction each micro-batch; it stops after two steps and goes on from its checkpoint."""
    path, arrived, checkpoint = (scratch_path(spark, n) for n in ("transactions", "events", "stream"))
    raw = dt.table(spark, sf_dir, "events")
    for start, stop in ((0, STEPS - 1), (STEPS - 1, STEPS)):
        arriving(raw, "event_id", arrived, start, stop)
        ev = dt.shape_events(table_stream(spark, arrived, raw.schema, max_files=files_of(raw)))
        snapshots = dt.job(spark, sf_dir).snapshots(dt.weather(ev)).select(SNAPSHOT_COLUMNS)
        finish(start_transactions(snapshots, path, "main", checkpoint, availableNow=True), stop - start)
    return read_transactions(spark, path, SNAPSHOT_SCHEMA)


_LAST_OF_DAY = sql(
    *BASE,
    select=f"""SELECT h3_cell, {day()}, seq, event_type, k, round(value, 6) + 0.0 AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY h3_cell, event_date ORDER BY seq DESC) AS rn FROM ev) WHERE rn = 1""",
)


def _last_of_day(spark, sf_dir, fold: bool):
    ev = dt.events(spark, sf_dir).drop("event_time")
    table = Table(scratch_path(spark, "upsert"), ev.schema, ("h3_cell", "event_date"))
    third = F.floor(F.col("seq") * 3 / (ev.agg(F.max("seq")).first()[0] + 1))
    for batch in range(3):
        newest = confirm.latest_per_key(ev.filter(third == batch), ["h3_cell", "event_date"], ["seq"])
        table.write(newest, "a", batch)
        if fold:
            table.compact(spark, "a", batch)
    return table.read(spark).select("h3_cell", "event_date", "seq", "event_type", "k", "value")


@query("upsert_batches", _LAST_OF_DAY)
def upsert_batches(spark, sf_dir):
    """The last event of every cell and day, written in three upserts that overlap."""
    return _last_of_day(spark, sf_dir, False)


@query("upsert_folded", _LAST_OF_DAY)
def upsert_folded(spark, sf_dir):
    """The same, with what came before folded after every upsert."""
    return _last_of_day(spark, sf_dir, True)


def _two_batches(spark, sf_dir):
    """The whole job over two halves, the second starting from the state of the first."""
    job, tables = dt.job(spark, sf_dir), Tables(scratch_path(spark, "job"))
    for batch, ev in enumerate(_halves(spark, sf_dir)):
        write_batch(job, _rows(job, ev), tables, batch)
    return tables


@query("incremental_outcomes", DAILY_OUTCOMES_SQL)
def incremental_outcomes(spark, sf_dir):
    return _two_batches(spark, sf_dir).outcomes.read(spark).select(OUTCOME_COLUMNS)


@query("incremental_training", DAILY_TRAINING_SQL)
def incremental_training(spark, sf_dir):
    return _two_batches(spark, sf_dir).training.read(spark).select(TRAINING_COLUMNS)


@query("incremental_predictions", sql(
    *CONFIRM, ALERTS, REGULAR, *NEIGHBORS,
    select=f"""SELECT {PREDICTION_SELECT.removeprefix("seq, ")} FROM
  (SELECT * FROM alerts UNION ALL BY NAME SELECT * FROM reg UNION ALL BY NAME SELECT * FROM nb)""",
))
def incremental_predictions(spark, sf_dir):
    return _two_batches(spark, sf_dir).predictions.read(spark).select(PREDICTION_COLUMNS)


@query(
    "incremental_snapshots",
    sql(*SCORED, select=f"SELECT {SNAPSHOT_SELECT} FROM snap WHERE seq IN (SELECT seq FROM sc)"),
)
def incremental_snapshots(spark, sf_dir):
    return _two_batches(spark, sf_dir).snapshots.read(spark).select(SNAPSHOT_COLUMNS)


# ---- the whole job from JSON text with coordinates to its five tables ----

# The log in arrival order: the newest broker time of a topic partition so far, then topic, partition and offset.
_LOG = f"""given AS ({EV.removeprefix("ev AS (").removesuffix(")")}),
log AS (
  SELECT g.*, CASE WHEN event_type = 'error' THEN 2 WHEN event_type = 'purchase' THEN 3 ELSE 1 END AS topic,
         CAST(substr(h3_cell, 2) AS BIGINT) % 4 AS part, seq // 64 - CASE WHEN k % 9 = 0 THEN 3 ELSE 0 END AS stamp
  FROM given g),
clocked AS (SELECT *, max(stamp) OVER (PARTITION BY topic, part ORDER BY seq) AS clock FROM log),
ev AS (
  SELECT * REPLACE (row_number() OVER (ORDER BY clock, topic, part, seq) AS seq) FROM clocked
  QUALIFY k NOT IN (11, 15))"""
_PARTS = [c if c is not EV else _LOG for c in CONFIRM]


def _of_log(*ctes: str, select: str) -> str:
    return sql(*_PARTS, *ctes, select=select)


_written: dict[tuple, Tables] = {}


def _once(make):
    """One run of a job per session and version of its input, whichever of its tables is asked for."""

    def tables(spark, sf_dir):
        versions = [
            dt.table(spark, sf_dir, t).agg(F.max("_metadata.file_modification_time"), F.count(F.lit(1))).first()
            for t in ("events", "customer")
        ]
        key = (make.__name__, spark.sparkContext.applicationId, sf_dir, *versions)
        if key not in _written:
            _written[key] = make(spark, sf_dir)
        return _written[key]

    return tables


@_once
def _job_tables(spark, sf_dir):
    """Two batches of records, decoded, located, scored, confirmed and written."""
    job = dt.job(spark, sf_dir, index=dt.index(spark, sf_dir))
    tables = Tables(scratch_path(spark, "job"))
    records = materialise(_ordered_records(spark, sf_dir), "records")
    middle = records.agg(F.expr("(min(seq.clock) + max(seq.clock)) div 2")).first()[0]
    for batch, part in enumerate((F.col("seq.clock") <= middle, F.col("seq.clock") > middle)):
        write_batch(job, job.marked_rows_of(records.filter(part)), tables, batch)
    return tables


@query(
    "job_snapshots",
    _of_log(select=f"SELECT {SNAPSHOT_SELECT} FROM snap WHERE seq IN (SELECT seq FROM sc)"),
)
def job_snapshots(spark, sf_dir):
    return _job_tables(spark, sf_dir).snapshots.read(spark).select(SNAPSHOT_COLUMNS)


@query("job_predictions", _of_log(
    ALERTS, REGULAR, *NEIGHBORS,
    select=f"""SELECT {PREDICTION_SELECT.removeprefix("seq, ")} FROM
  (SELECT * FROM alerts UNION ALL BY NAME SELECT * FROM reg UNION ALL BY NAME SELECT * FROM nb)""",
))
def job_predictions(spark, sf_dir):
    return _job_tables(spark, sf_dir).predictions.read(spark).select(PREDICTION_COLUMNS)


@query("job_outcomes", DAILY_OUTCOMES_SQL.replace(EV, _LOG))
def job_outcomes(spark, sf_dir):
    return _job_tables(spark, sf_dir).outcomes.read(spark).select(OUTCOME_COLUMNS)


@query("job_training", DAILY_TRAINING_SQL.replace(EV, _LOG))
def job_training(spark, sf_dir):
    return _job_tables(spark, sf_dir).training.read(spark).select(TRAINING_COLUMNS)


@query("job_quarantine", _of_log(
    ALERTS, *NEIGHBORS,
    select="""SELECT stage, reason, source, count(*) AS n_rows FROM (
  SELECT 'decode' AS stage, CASE k WHEN 11 THEN 'malformed_json' ELSE 'missing_key' END AS reason,
         CASE topic WHEN 1 THEN 'meteo' WHEN 2 THEN 'sensor' ELSE 'fire' END AS source
  FROM clocked WHERE k IN (11, 15)
  UNION ALL SELECT 'static', 'no_static', 'meteo' FROM weather WHERE h3_cell NOT IN (SELECT h3_cell FROM st)
  UNION ALL SELECT 'encoder', 'unknown_cell', 'meteo' FROM snap WHERE h3_commune NOT IN (SELECT class FROM enc)
  UNION ALL SELECT 'neighbor', 'unknown_cell', 'meteo' FROM spread WHERE h3_commune NOT IN (SELECT class FROM enc))
GROUP BY ALL""",
))
def job_quarantine(spark, sf_dir):
    rows = _job_tables(spark, sf_dir).quarantine.read(spark)
    return rows.groupBy("stage", "reason", "source").agg(F.count(F.lit(1)).alias("n_rows"))


@query("job_counts", sql(EV, select="SELECT count(*) AS n_in, count(*) AS n_out FROM ev"))
def job_counts(spark, sf_dir):
    """Records in, and rows kept plus rows in quarantine; nothing gets lost between the two."""
    job = dt.job(spark, sf_dir, index=dt.index(spark, sf_dir))
    records = _ordered_records(spark, sf_dir)
    rows = job.marked_rows_of(records)
    kept = rows.agg(F.count_if(F.col("stage").isNull()).alias("kept"), F.count("stage").alias("refused"))
    counted = records.agg(F.count(F.lit(1)).alias("n_in"))
    both = counted.withColumn("_", F.lit(1)).join(kept.withColumn("_", F.lit(1)), "_")
    return both.select("n_in", (F.col("kept") + F.col("refused")).alias("n_out"))


# ---- streams: three micro-batches at least, compared with the tables ----


@query("stream_snapshots", sql(*BASE, SNAPSHOTS, select=f"SELECT {SNAPSHOT_SELECT} FROM snap"))
def stream_snapshots(spark, sf_dir):
    table, checkpoint = Table(scratch_path(spark, "snapshots"), SNAPSHOT_SCHEMA), scratch_path(spark, "stream")
    snapshots = dt.job(spark, sf_dir).snapshots(dt.weather(_events_arriving(spark, sf_dir)))
    finish(append_stream(snapshots.select(SNAPSHOT_COLUMNS), table, checkpoint, availableNow=True))
    return table.read(spark)


@query(
    "stream_json_text",
    sql(
        EV,
        select=f"""SELECT h3_cell, event_time, {day()}, round(value + 400, 6) + 0.0 AS co2,
  CAST(100 - k AS DOUBLE) AS battery FROM ev WHERE event_type = 'error'""",
    ),
)
def stream_json_text(spark, sf_dir):
    """Lines of JSON text from a folder, decoded as they arrive."""
    sensors = dt.sensors(dt.events(spark, sf_dir)).withColumns(
        {"alert_level": F.lit(None).cast("string"), "fire_related": F.lit(None).cast("boolean")}
    )
    folder, files = scratch_path(spark, "lines"), files_of(sensors)
    for step in steps_of(sensors, "seq"):
        step.select(dt.event_json("sensor")).repartition(files).write.mode("append").text(folder)
    typed = require_keys(accepted(decode_events(json_file_events(spark, folder, max_files=files), "sensor")))
    kept = typed.select("h3_cell", "event_time", "event_date", "co2", "battery")
    table = Table(scratch_path(spark, "typed"), kept.schema)
    finish(append_stream(kept, table, scratch_path(spark, "stream"), availableNow=True))
    return table.read(spark)


@_once
def _stream_tables(spark, sf_dir):
    job, tables = dt.job(spark, sf_dir), Tables(scratch_path(spark, "job"))
    rows = _rows(job, _events_arriving(spark, sf_dir))
    finish(confirm_batches(job, rows, tables, scratch_path(spark, "stream"), availableNow=True))
    return tables


@query("stream_batch_outcomes", DAILY_OUTCOMES_SQL)
def stream_batch_outcomes(spark, sf_dir):
    return _stream_tables(spark, sf_dir).outcomes.read(spark).select(OUTCOME_COLUMNS)


@query("stream_batch_training", DAILY_TRAINING_SQL)
def stream_batch_training(spark, sf_dir):
    return _stream_tables(spark, sf_dir).training.read(spark).select(TRAINING_COLUMNS)


@_once
def _restarted_tables(spark, sf_dir):
    """A log of records grows by steps; the stream over it stops after two of them and goes on from its checkpoint."""
    job = dt.job(spark, sf_dir, index=dt.index(spark, sf_dir))
    tables, checkpoint, path = Tables(scratch_path(spark, "job")), scratch_path(spark, "stream"), scratch_path(spark, "log")
    records = materialise(_ordered_records(spark, sf_dir).withColumn("at", F.col("seq.clock")), "records")
    taken, running = 0, None
    for i, step in enumerate(steps_of(records, "at")):
        write_log(step, path)
        if running is None:
            stream = log_records(spark, path, progress=f"{checkpoint}-progress")
            running = confirm_records(job, stream, tables, checkpoint, fold_every=1, processingTime="0 seconds")
        running.processAllAvailable()
        if i >= STEPS - 2:
            taken += sum(1 for p in running.recentProgress if p["numInputRows"])
            running.stop()
            running = None
    if taken < STEPS:
        raise ValueError(f"the stream took {taken} micro-batches, not {STEPS}")
    return tables


def _stateful_tables(spark, sf_dir):
    """Keyed state in the stream's store; the stream stops after two steps and goes on from its checkpoint."""
    job, tables = dt.job(spark, sf_dir), Tables(scratch_path(spark, "job"))
    raw, path, checkpoint = dt.table(spark, sf_dir, "events"), scratch_path(spark, "events"), scratch_path(spark, "stream")
    for start, stop in ((0, STEPS - 1), (STEPS - 1, STEPS)):
        arriving(raw, "event_id", path, start, stop)
        rows = _rows(job, dt.shape_events(table_stream(spark, path, raw.schema, max_files=files_of(raw))))
        finish(confirm_with_state(job, rows, tables, checkpoint, availableNow=True), stop - start)
    return tables


@query("stateful_outcomes", DAILY_OUTCOMES_SQL)
def stateful_outcomes(spark, sf_dir):
    return _stateful_tables(spark, sf_dir).outcomes.read(spark).select(OUTCOME_COLUMNS)


@query("stateful_training", DAILY_TRAINING_SQL)
def stateful_training(spark, sf_dir):
    return _stateful_tables(spark, sf_dir).training.read(spark).select(TRAINING_COLUMNS)


@query("stream_restart_outcomes", DAILY_OUTCOMES_SQL.replace(EV, _LOG))
def stream_restart_outcomes(spark, sf_dir):
    return _restarted_tables(spark, sf_dir).outcomes.read(spark).select(OUTCOME_COLUMNS)


@query("stream_restart_training", DAILY_TRAINING_SQL.replace(EV, _LOG))
def stream_restart_training(spark, sf_dir):
    return _restarted_tables(spark, sf_dir).training.read(spark).select(TRAINING_COLUMNS)


@query(
    "stream_windows",
    sql(
        *BASE,
        UNIFIED,
        WINDOWS,
        select=f"""SELECT h3_cell, {day()}, window_start, window_end, fire_count, sensor_count, meteo_count,
  {num("avg_temp", "max_co2", "altitude_moy")} FROM win
WHERE window_end <= (SELECT max(event_time) - 3600000 FROM uni)""",
    ),
)
def stream_windows(spark, sf_dir):
    """Windows the watermark has closed; the last day stays open."""
    path, checkpoint = scratch_path(spark, "windows"), scratch_path(spark, "stream")
    ev, static = _events_arriving(spark, sf_dir), dt.static(spark, sf_dir)
    unified = (
        unify_sensor(dt.sensors(ev), None, extra=("seq",))
        .unionByName(unify_fire(dt.fires(ev), None, extra=("seq",)))
        .unionByName(unify_weather(dt.weather(ev), None, extra=("seq",)))
    )
    windows = aggregate.cell_windows(unified, watermark="1 hour", static=static)
    running = (
        windows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    finish(running)
    return spark.read.parquet(path).select(
        "h3_cell", "event_date", "window_start", "window_end", "fire_count", "sensor_count", "meteo_count", "avg_temp",
        "max_co2", "altitude_moy",
    )

