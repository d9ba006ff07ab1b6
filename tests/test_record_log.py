"""The folder log as a stream: offsets, limits, restarts and unfinished appends; arrival order over cut partitions."""

import random

import pytest

from cellwatch.operators.skew import SplitPolicy
from cellwatch.sources.record_log import RecordLogReader, log_records, write_log
from cellwatch.sources.streams import RECORD_SCHEMA, with_arrival_order


def records(spark, begin, end):
    """Two kinds, three partitions, offsets with gaps."""
    rows = [(("weather", "fire")[i % 2], f"v{i}", i - i % 5, i % 3, 1000 + i) for i in range(begin, end)]
    return rows, spark.createDataFrame(rows, RECORD_SCHEMA)


def drained(spark, path, checkpoint, batches, **options):
    def take(batch, i):
        batches.append((i, [tuple(r) for r in batch.collect()], batch.rdd.getNumPartitions()))

    stream = log_records(spark, path, **options)
    running = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    running.processAllAvailable()
    running.stop()


def test_log_comes_back_once_and_in_bounded_batches(spark, tmp_path):
    path, checkpoint, note = (str(tmp_path / n) for n in ("log", "check", "note"))
    first, frame = records(spark, 0, 300)
    write_log(frame, path)
    batches = []
    drained(spark, path, checkpoint, batches, rows_per_batch="150", rows_per_task="20", progress=note)
    assert sorted(r for _, rows, _ in batches for r in rows) == sorted(first)
    assert len(batches) > 3 and max(n for _, _, n in batches) > 6
    before = len(batches)
    second, frame = records(spark, 300, 500)
    write_log(frame, path)
    # A new reader goes on from the checkpoint, under the same limit.
    drained(spark, path, checkpoint, batches, rows_per_batch="150", rows_per_task="20", progress=note)
    later = [r for _, rows, _ in batches[before:] for r in rows]
    assert sorted(later) == sorted(second) and len(batches) - before > 1
    # Every topic partition comes in the order of its offsets.
    taken = [r for _, rows, _ in batches for r in sorted(rows, key=lambda r: r[4])]
    for log in {(r[0], r[3]) for r in taken}:
        offsets = [r[4] for r in taken if (r[0], r[3]) == log]
        assert offsets == sorted(offsets)


def test_unfinished_appends_are_not_seen(spark, tmp_path):
    path = str(tmp_path / "log")
    rows, frame = records(spark, 0, 60)
    write_log(frame, path)
    frame.write.partitionBy("kind", "partition").parquet(f"{path}/appends/00000001-died")
    (tmp_path / "log" / "manifests" / "00000001.part").write_text("{")
    reader = RecordLogReader({"path": path})
    end = reader.latestOffset()
    found = sum(b.num_rows for p in reader.partitions({}, end) for b in reader.read(p))
    assert found == 60 and len(end) == 6
    assert RecordLogReader({"path": str(tmp_path / "none")}).latestOffset() == {}


@pytest.mark.parametrize("ranges", [1, 7])
def test_arrival_order_over_cut_partitions(spark, ranges):
    rng = random.Random(3)
    rows = [("weather", "v", rng.randrange(10_000), int(rng.random() < 0.2), i) for i in range(600)]
    rows += [("fire", "v", 5, 0, i) for i in range(30)]
    clock, want = {}, {}
    for kind, _, stamp, part, offset in sorted(rows, key=lambda r: r[4]):
        clock[kind, part] = max(stamp, clock.get((kind, part), 0))
        want[kind, part, offset] = clock[kind, part]
    frame = spark.createDataFrame(rows, RECORD_SCHEMA)
    out = with_arrival_order(frame, SplitPolicy(ranges))
    assert out.columns == [*frame.columns, "seq"]
    assert {(r.kind, r.partition, r.offset): r.seq.clock for r in out.collect()} == want
    assert with_arrival_order(frame.limit(0)).count() == 0
