"""Streams over several micro-batches against the state machine, and sinks that are run twice."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from cellwatch.operators import confirm
from cellwatch.operators.aggregate import cell_windows
from cellwatch.operators.skew import SplitPolicy
from cellwatch.plans.risk import RiskJob, Tables, write_batch
from cellwatch.schemas import PREDICTION_SCHEMA, UNIFIED_SCHEMA
from cellwatch.sinks import tables as sinks
from cellwatch.sources.streams import RECORD_SCHEMA, table_stream, with_arrival_order
from cellwatch.streaming.confirm_stream import confirm_batches

from tests import day_machine
from tests.test_confirm import expected, frames, random_events


class _Fixed:
    """Stands in for the model: every neighbour gets one fixed score."""

    def predict_neighbor(self, snapshots):
        members = [
            F.lit({"prediction": 1, "probability": 0.4, "risk_level": "MEDIUM"}.get(f.name)).cast(f.dataType).alias(f.name)
            if f.name not in ("h3_cell", "event_time", "event_date")
            else F.col(f.name)
            for f in PREDICTION_SCHEMA.fields
        ]
        return snapshots.withColumn("p", F.struct(*members))


def make_job(spark, policy=SplitPolicy()):
    ring = spark.createDataFrame([(f"c{i}", f"c{(i + 1) % 6}") for i in range(6)], "h3_cell string, neighbor string")
    return RiskJob(static=None, adjacency=ring, model=_Fixed(), policy=policy)


@pytest.fixture(scope="module")
def events():
    return random_events(21, 6, 400, 5, hot=0.4)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, events):
    """Keyed rows in five files that arrive one after the other."""
    path = tmp_path_factory.mktemp("rows")
    cuts = [0, 90, 91, 200, 310, 400]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        rows = confirm.merge_inputs(*frames(spark, events[a:b])).coalesce(1)
        part = str(path / f"part{i}")
        rows.write.parquet(part)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        target = path / "all"
        target.mkdir(exist_ok=True)
        os.link(os.path.join(part, name), target / f"{i}.parquet")
        os.utime(target / f"{i}.parquet", (1_700_000_000 + i * 10,) * 2)
    return str(path / "all")


def rows_stream(spark, folder):
    return table_stream(spark, folder, spark.read.parquet(folder).schema, max_files=1)


_OUTCOME = [
    "h3_cell", "event_date", "sensor_confirmed", "fire_observed", "fire_confirmed_with_sensor", "confirmation_time",
    "confirmation_source", "latest_meteo_event_time", "suspected_voluntary",
]
_TRAINING = [
    "h3_cell", "event_date", "label", "confirmation_source", "input_event_time", "fire_observed", "sensor_confirmed",
    "suspected_voluntary",
]


def picked(df, columns):
    return sorted(tuple(r) for r in df.select(columns).collect())


@pytest.mark.parametrize("policy", [SplitPolicy(), SplitPolicy(20)])
def test_batch_stream_over_micro_batches(spark, folder, events, tmp_path, policy):
    out = Tables(str(tmp_path / "tables"))
    q = confirm_batches(
        make_job(spark, policy), rows_stream(spark, folder), out, str(tmp_path / "c"), fold_every=2, availableNow=True
    )
    q.awaitTermination()
    assert sum(1 for p in q.recentProgress if p["numInputRows"]) == 5
    check_tables(spark, out, events)


def check_tables(spark, out, events):
    _, _, final, training = expected(events)
    assert picked(out.outcomes.read(spark), _OUTCOME) == final
    assert picked(out.training.read(spark), _TRAINING) == training
    alerts, *_ = day_machine.run(events)
    predictions = out.predictions.read(spark)
    assert predictions.filter("trigger_type = 'confirmed_alert'").count() == len(alerts)
    assert predictions.filter("is_neighbor_prediction").count() == len(alerts)
    weather = sum(e["kind"] == "meteo" for e in events)
    assert out.snapshots.read(spark).count() == weather and predictions.count() == weather + 2 * len(alerts)


def test_a_repeated_batch_changes_nothing(spark, events, tmp_path):
    job, out = make_job(spark), Tables(str(tmp_path / "tables"))
    first, second = (confirm.merge_inputs(*frames(spark, part)) for part in (events[:250], events[250:]))
    write_batch(job, first, out, 0)
    for _ in range(2):
        write_batch(job, second, out, 1, fold_every=1)
    check_tables(spark, out, events)


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", range(0, 12, 2))
def test_a_job_that_dies_in_any_step_can_run_again(spark, events, tmp_path, monkeypatch, step):
    """Dies after ``step`` writes, of data folders and of commits alike, then runs the batch again."""
    job, out = make_job(spark), Tables(str(tmp_path / "tables"))
    parts = [confirm.merge_inputs(*frames(spark, part)) for part in (events[:250], events[250:])]
    write_batch(job, parts[0], out, 0)
    left = [step]
    commit = sinks.Table._commit

    def dying(self, *args):
        if left[0] <= 0:
            raise Stop  # the data folder is written, the commit is not
        left[0] -= 1
        commit(self, *args)
        if left[0] <= 0:
            raise Stop
        left[0] -= 1

    monkeypatch.setattr(sinks.Table, "_commit", dying)
    try:
        write_batch(job, parts[1], out, 1, fold_every=1)
    except Stop:
        pass
    monkeypatch.setattr(sinks.Table, "_commit", commit)
    write_batch(job, parts[1], out, 1, fold_every=1)
    check_tables(spark, out, events)


def test_missing_state_stops_the_run(spark, events, tmp_path):
    rows = confirm.merge_inputs(*frames(spark, events[:20]))
    with pytest.raises(ValueError, match="no state"):
        write_batch(make_job(spark), rows, Tables(str(tmp_path / "tables")), 3)


def test_a_new_run_goes_next_to_the_old_one(spark, tmp_path):
    table = sinks.Table(str(tmp_path / "t"), "k int, v int", ("k",))
    log = sinks.Table(str(tmp_path / "l"), "k int, v int")
    for t in (table, log):
        for run, batch, rows in (("a", 0, [(1, 1), (2, 1)]), ("a", 1, [(1, 2)]), ("b", 0, [(2, 3)])):
            t.write(spark.createDataFrame(rows, "k int, v int"), run, batch)
    assert picked(table.read(spark), ["k", "v"]) == [(1, 2), (2, 3)]
    assert picked(log.read(spark), ["k", "v"]) == [(1, 1), (1, 2), (2, 1), (2, 3)]
    assert picked(table.read(spark, "a", 1), ["k", "v"]) == [(1, 1), (2, 1)]
    table.write(spark.createDataFrame([(1, 9)], "k int, v int"), "a", 1)  # again, keeps its place
    assert picked(table.read(spark), ["k", "v"]) == [(1, 9), (2, 3)]


def test_folding_keeps_rows_and_removes_folders(spark, tmp_path):
    table = sinks.Table(str(tmp_path / "t"), "k int, v int", ("k",))
    for batch in range(6):
        table.write(spark.createDataFrame([(batch % 2, batch), (9, batch)], "k int, v int"), "a", batch)
        table.compact(spark, "a", batch)
        assert dict(picked(table.read(spark), ["k", "v"]))[9] == batch
        assert dict(picked(table.read(spark, "a", batch), ["k", "v"])).get(9, -1) == batch - 1
    assert picked(table.read(spark), ["k", "v"]) == [(0, 4), (1, 5), (9, 5)]
    kept = [f for f in glob.glob(f"{tmp_path}/t/data/*/*") if glob.glob(f"{f}/*.parquet")]
    assert len(kept) == 2
    table.write(spark.createDataFrame([(9, 50)], "k int, v int"), "a", 5)
    assert dict(picked(table.read(spark), ["k", "v"])) == {0: 4, 1: 3, 9: 50}


def test_stream_windows_equal_batch_windows(spark, tmp_path):
    rng = random.Random(3)
    names = [*UNIFIED_SCHEMA.fieldNames(), "seq"]
    rows = [
        tuple(
            {
                "source_type": rng.choice(["meteo", "fire", "sensor"]), "h3_cell": rng.choice("ab"), "seq": i,
                "event_time": 1_748_736_000_000 + i * 3_600_000, "temperature": rng.random(), "co2": rng.random(),
            }.get(n)
            for n in names
        )
        for i in range(200)
    ]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in UNIFIED_SCHEMA.fields) + ", seq long"
    df = spark.createDataFrame(rows, schema)
    source = str(tmp_path / "in")
    df.coalesce(1).write.parquet(source)
    windows = cell_windows(table_stream(spark, source, df.schema), watermark="1 hour")
    q = (
        windows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    q.awaitTermination()
    closed = df.agg(F.max("event_time") - 3_600_000).first()[0]
    key = ["h3_cell", "window_start", "fire_count", "meteo_count", "max_co2"]
    got = picked(spark.read.parquet(str(tmp_path / "out")), key)
    assert got and got == picked(cell_windows(df).filter(F.col("window_end") <= closed), key)


def test_arrival_order_is_complete(spark):
    """Offsets across 2^19 in one millisecond, times that go back, and equal offsets of other partitions."""
    rows = [("weather", "v", 1_750_000_000_000, 0, 2**19 - 1 + i) for i in range(3)]
    rows += [("weather", "v", 1_750_000_000_000 - 60_000, 0, 2**19 + 2), ("weather", "v", 1_750_000_000_000, 1, 2**19 - 1)]
    rows += [("fire", "v", 1_750_000_000_000, 0, 2**19 - 1), ("sensor", "v", 1_749_999_999_999, 0, 2**40)]
    ordered = with_arrival_order(spark.createDataFrame(rows, RECORD_SCHEMA)).orderBy("seq").collect()
    assert [(r.kind, r.partition, r.offset - 2**19) for r in ordered] == [
        ("sensor", 0, 2**40 - 2**19), ("weather", 0, -1), ("weather", 0, 0), ("weather", 0, 1), ("weather", 0, 2),
        ("weather", 1, -1), ("fire", 0, -1),
    ]
    assert len({r.seq for r in ordered}) == len(rows)


def test_upsert_statement():
    text = sinks.upsert_statement("t", "s", ["h3_cell", "event_date", "label"])
    assert text == (
        "INSERT INTO t (h3_cell, event_date, label) SELECT h3_cell, event_date, label FROM s "
        "ON CONFLICT (h3_cell, event_date) DO UPDATE SET label = EXCLUDED.label"
    )
