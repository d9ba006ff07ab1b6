"""A log of event records in a folder, read as a stream by offsets.

``write_log`` appends records: files sorted by topic partition and offset in a
folder of their own, and then one manifest with the offsets of each topic
partition. Readers go by manifests, which appear whole or not at all, so an
append that is still running or has died is not seen. The source ``record_log``
reads the log back like a broker's topics: every topic partition has its own
offsets, a micro-batch takes the records between two sets of offsets, and is
read by as many tasks as its ranges fill. ``rows_per_batch`` limits what one
micro-batch takes of all topic partitions together, and ``rows_per_task`` what
one task reads.

The reader remembers the offsets it gave last, so that the limit holds from one
micro-batch to the next. With ``progress``, a folder, it also leaves a note
there before it gives offsets; then the limit holds for the first micro-batch after a
restart too, where it would otherwise take all that waits. Every checkpoint needs
a ``progress`` of its own. What is read never depends on that note: offsets are
Spark's.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from cellwatch.sources.streams import RECORD_SCHEMA

_COLUMNS = [c.split(" ")[0] for c in RECORD_SCHEMA.split(", ")]
_SCHEMA = pa.schema(
    [("kind", pa.string()), ("value", pa.string()), ("stamp", pa.int64()), ("partition", pa.int32()), ("offset", pa.int64())]
)


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _manifests(path: str) -> list[str]:
    """Paths of the manifests, the oldest first."""
    files, root = _files(path)
    found = files.get_file_info(pafs.FileSelector(f"{root}/manifests", allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.endswith(".json"))


def write_log(records: DataFrame, path: str) -> None:
    """Append records (kind, value, stamp, partition, offset) to the log; one writer at a time.

    A topic partition is written by as many tasks as its offsets fill ranges.
    Offsets must be above those already there, may have gaps, and are not null.
    """
    spark, (files, root) = records.sparkSession, _files(path)
    number = len(_manifests(path))
    folder = f"appends/{number:08d}-{uuid.uuid4().hex}"
    placed = records.select(*_COLUMNS, F.col("kind").alias("_kind"), F.col("partition").alias("_part"))
    dealt = placed.repartitionByRange("_kind", "_part", "offset").sortWithinPartitions("_kind", "_part", "offset")
    dealt.write.partitionBy("_kind", "_part").parquet(f"{path}/{folder}")
    # A row per topic partition.
    spans = (
        spark.read.schema("kind string, partition int, offset bigint").parquet(f"{path}/{folder}")
        .groupBy("kind", "partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high")).collect()
    )
    logs = {f"{r['kind']}/{r['partition']}": [r["low"], r["high"] + 1] for r in spans}
    files.create_dir(f"{root}/manifests", recursive=True)
    waiting = f"{root}/manifests/{number:08d}.part"
    with files.open_output_stream(waiting) as out:
        out.write(json.dumps({"folder": folder, "logs": logs}).encode())
    files.move(waiting, f"{root}/manifests/{number:08d}.json")


class Range(InputPartition):
    """Offsets of one topic partition inside one append, the end exclusive."""

    def __init__(self, folder: str, log: str, begin: int, end: int):
        self.folder, self.log, self.begin, self.end = folder, log, begin, end


class RecordLogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.rows_per_batch = int(options.get("rows_per_batch", 0))
        self.rows_per_task = max(1, int(options.get("rows_per_task", 250_000)))
        self.progress = options.get("progress")
        self.given: dict[str, int] | None = self._noted()
        self.read_before: dict[str, dict] = {}

    def _note(self) -> tuple[pafs.FileSystem, str] | None:
        if not self.progress:
            return None
        files, folder = _files(self.progress)
        return files, f"{folder}/offsets.json"

    def _noted(self) -> dict[str, int] | None:
        note = self._note()
        if note is None:
            return None
        if note[0].get_file_info(note[1]).type == pafs.FileType.NotFound:
            return {}
        with note[0].open_input_stream(note[1]) as source:
            return json.loads(source.read())

    def _appends(self) -> list[dict]:
        files = _files(self.path)[0]
        for name in _manifests(self.path):
            if name not in self.read_before:
                with files.open_input_stream(name) as source:
                    self.read_before[name] = json.loads(source.read())
        return list(self.read_before.values())

    def initialOffset(self) -> dict:
        """The earliest offsets. Spark asks after the first ``latestOffset``, so nothing is forgotten here."""
        return {}

    def latestOffset(self) -> dict:
        """Offsets up to which the next micro-batch reads."""
        there: dict[str, int] = {}
        for append in self._appends():
            there |= {log: end for log, (_, end) in append["logs"].items()}
        if self.given is None or not self.rows_per_batch:
            return self._gives(there)
        new = {log: end - self._begin(log, self.given) for log, end in there.items()}
        waiting = sum(new.values())
        if waiting <= self.rows_per_batch:
            return self._gives(there)
        # Every topic partition gives its share; at least one gives a record.
        taken = {log: n * self.rows_per_batch // waiting for log, n in new.items()}
        if not any(taken.values()):
            taken[max(new, key=new.get)] = 1
        return self._gives({log: self._begin(log, self.given) + n for log, n in taken.items()})

    def _gives(self, offsets: dict[str, int]) -> dict[str, int]:
        """Notes offsets before Spark logs them: the note may be ahead of Spark after a crash, never behind."""
        note = self._note()
        if note is not None and offsets != self.given:
            note[0].create_dir(note[1].rsplit("/", 1)[0], recursive=True)
            with note[0].open_output_stream(note[1]) as out:
                out.write(json.dumps(offsets).encode())
        self.given = offsets
        return offsets

    def _begin(self, log: str, offsets: dict) -> int:
        """Where a topic partition goes on; at its first record if it is new."""
        if log in offsets:
            return offsets[log]
        return next(a["logs"][log][0] for a in self._appends() if log in a["logs"])

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for log, stop in sorted(end.items()):
            begin = self._begin(log, start)
            for append in self._appends():
                low, high = append["logs"].get(log, (0, 0))
                for at in range(max(low, begin), min(high, stop), self.rows_per_task):
                    out.append(Range(append["folder"], log, at, min(high, stop, at + self.rows_per_task)))
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        files, root = _files(self.path)
        kind, part = partition.log.split("/")
        folder = f"{root}/{partition.folder}/_kind={kind}/_part={part}"
        rows = ds.dataset(folder, schema=_SCHEMA, filesystem=files, format="parquet", exclude_invalid_files=True)
        wanted = (pc.field("offset") >= partition.begin) & (pc.field("offset") < partition.end)
        yield from rows.to_batches(filter=wanted, batch_size=10_000)

    def commit(self, end: dict) -> None:
        """Nothing to do: the log keeps its records."""


class RecordLog(DataSource):
    """Stream source ``record_log``; the option ``path`` names the folder."""

    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return RECORD_SCHEMA

    def streamReader(self, schema) -> RecordLogReader:
        return RecordLogReader(self.options)


def log_records(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The records of a log as a stream, from their earliest offsets."""
    spark.dataSource.register(RecordLog)
    return spark.readStream.format("record_log").options(path=path, **options).load()
