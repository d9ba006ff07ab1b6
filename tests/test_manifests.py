"""Batches as transactions: tasks that die, replays, restarts of a stream, files that nobody lists."""

import os

import pytest
from pyspark.sql import functions as F

from cellwatch.sinks.manifests import manifests, read_transactions, start_transactions, sweep, write_transaction

SCHEMA = "id bigint, name string, at timestamp, parts array<struct<k:int,v:double>>"


def rows(spark, begin, end):
    return spark.range(begin, end, numPartitions=6).selectExpr(
        "id", "CASE WHEN id % 7 > 0 THEN concat('n', id) END AS name", "timestamp_millis(id * 1000) AS at",
        "CASE WHEN id % 5 > 0 THEN array(struct(int(id) AS k, id / 3.0D AS v)) END AS parts",
    )


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def data_files(path):
    return [f for f in os.listdir(os.path.join(path, "data")) if f.endswith(".parquet")]


def test_batches_replays_and_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_transactions(spark, path, SCHEMA).count() == 0 and sweep(path) == 0
    write_transaction(rows(spark, 0, 50), path, "a", 0)
    write_transaction(rows(spark, 50, 80), path, "a", 1)
    before = len(data_files(path))
    write_transaction(rows(spark, 0, 50), path, "a", 0)
    assert len(data_files(path)) == before and sweep(path) == 0
    write_transaction(rows(spark, 80, 90), path, "b", 0)
    write_transaction(rows(spark, 0, 0), path, "b", 1)
    assert same(read_transactions(spark, path, SCHEMA), rows(spark, 0, 90))
    assert [m["rows"] for m in manifests(path)] == [50, 30, 10, 0]


def test_a_task_that_dies_half_way_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    write_transaction(rows(spark, 0, 20), path, "a", 0)

    def dies(batches):
        for frame in batches:
            yield frame
            if frame["id"].max() >= 9_000:
                raise RuntimeError("this task dies")

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        broken = spark.range(0, 10_000, numPartitions=4).mapInPandas(dies, "id bigint")
        with pytest.raises(Exception, match="this task dies"):
            write_transaction(broken.selectExpr("id", "'x' AS name", "timestamp_millis(id) AS at", "NULL AS parts"), path, "a", 1)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert same(read_transactions(spark, path, SCHEMA), rows(spark, 0, 20))
    # The same batch run again is whole, and what the dead tasks left can go.
    write_transaction(rows(spark, 20, 60), path, "a", 1)
    sweep(path)
    assert same(read_transactions(spark, path, SCHEMA), rows(spark, 0, 60))
    assert len(data_files(path)) == sum(len(m["files"]) for m in manifests(path))


def test_overwriting_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    write_transaction(rows(spark, 0, 5), path, "a", 0)
    with pytest.raises(Exception, match="only appends"):
        rows(spark, 0, 5).write.format("manifest_table").mode("overwrite").options(path=path, run="a", batch="1").save()
    assert read_transactions(spark, path, SCHEMA).count() == 5


def test_stream_replays_a_batch_whose_commit_spark_did_not_log(spark, tmp_path):
    path, source, checkpoint = (str(tmp_path / n) for n in ("t", "in", "check"))
    for step in range(3):
        rows(spark, step * 30, step * 30 + 30).coalesce(1).write.mode("append").parquet(source)

    def drained():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        running = start_transactions(stream, path, "s", checkpoint, availableNow=True)
        running.awaitTermination()

    drained()
    assert len(manifests(path)) == 3
    before = data_files(path)
    # As if the job had died between the sink's commit and Spark's own log.
    last = max((f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()), key=int)
    os.remove(f"{checkpoint}/commits/{last}")
    if os.path.exists(f"{checkpoint}/commits/.{last}.crc"):
        os.remove(f"{checkpoint}/commits/.{last}.crc")
    rows(spark, 90, 100).coalesce(1).write.mode("append").parquet(source)
    drained()
    out = read_transactions(spark, path, SCHEMA)
    assert same(out, rows(spark, 0, 100)) and len(data_files(path)) == len(before) + 1
    assert out.agg(F.countDistinct("id")).first()[0] == 100
