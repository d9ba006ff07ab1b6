"""Event records and their arrival order. The same transforms run on tables and on streams.

A record has ``kind``, the text ``value``, and where it came from: ``stamp``
(broker time, epoch milliseconds), ``partition`` and ``offset``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellwatch.operators.skew import CUTS, PART, SplitPolicy, cut_points, part_of
from cellwatch.schemas import TOPICS
from cellwatch.sources.decode import decode_events

RECORD_SCHEMA = "kind string, value string, stamp bigint, partition int, offset bigint"


def with_arrival_order(records: DataFrame, policy: SplitPolicy = SplitPolicy()) -> DataFrame:
    """Adds ``seq``, the complete order: clock, then topic, partition and offset.

    The clock is the newest broker time of the topic partition up to the
    record, so times that go back never reorder a partition. No two records
    share a ``seq``, and none of its parts is shortened. Batch only; on streams
    it applies to each micro-batch, which follow one another anyway.

    The clock is a running maximum. A topic partition that fills several ranges
    of a sort by offset is cut where they meet (``operators.skew``): every part
    runs over its own records, and one row per part carries the maximum of the
    parts before it.
    """
    topic = F.array_position(F.array(*[F.lit(k) for k in TOPICS]), F.col("kind")).cast("int")
    logs = records.withColumn("_log", F.struct("kind", "partition"))
    cuts = cut_points(logs, "_log", "offset", policy)
    parts = logs.join(cuts, "_log", "left").withColumn(PART, part_of(F.col(CUTS), F.col("offset"))).drop(CUTS)
    earlier = Window.partitionBy("_log").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    ends = parts.groupBy("_log", PART).agg(F.max("stamp").alias("_end"))
    carried = ends.select("_log", PART, F.max("_end").over(earlier).alias("_carried"))
    own = Window.partitionBy("_log", PART).orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = parts.withColumn("_own", F.max("stamp").over(own)).join(carried, ["_log", PART])
    clock = F.greatest("_own", "_carried")
    seq = F.struct(clock.alias("clock"), topic.alias("topic"), F.col("partition"), F.col("offset"))
    return run.withColumn("seq", seq).select(*records.columns, "seq")


def decoded(records: DataFrame) -> dict[str, DataFrame]:
    """Typed events by kind, refused ones with their reason; ``seq`` stays."""
    return {
        kind: decode_events(records.filter(F.col("kind") == kind).select("seq", "value"), kind) for kind in TOPICS
    }


def _records(reader, kind: str, servers: str, options: dict[str, str]) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    records = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", TOPICS[kind])
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )
    return records.select(
        F.lit(kind).alias("kind"),
        F.col("value").cast("string").alias("value"),
        F.unix_millis("timestamp").alias("stamp"),
        "partition",
        "offset",
    )


def kafka_records(spark: SparkSession, servers: str, max_offsets: int | None = None, **options: str) -> DataFrame:
    """All topics as one stream from their earliest offsets."""
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    kinds = [_records(spark.readStream, kind, servers, options) for kind in TOPICS]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


def kafka_records_batch(spark: SparkSession, servers: str, **options: str) -> DataFrame:
    """The same topics as one bounded table, for backfills."""
    kinds = [_records(spark.read, kind, servers, options) for kind in TOPICS]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


def json_file_events(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of JSON-lines files as a stream of text values."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def table_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A folder of Parquet files as a stream, the oldest first."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
