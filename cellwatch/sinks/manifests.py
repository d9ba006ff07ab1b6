"""A data source that writes every batch as one transaction of many tasks.

Each task attempt streams its rows into a file of its own name and tells the
driver that name. ``commit`` lists the files of the attempts that counted in a
manifest, which appears whole or not at all; readers go by manifests. So a task
that dies half-way, a second attempt, a speculative copy or a job that ends
before its commit leaves files that nobody lists, and the table is as it was.

A batch is known by its run and number, and the first commit of it counts: a
replay finds the manifest and takes its own files away. The sink serves batches
(options ``run`` and ``batch``) and streams, where the micro-batch number is the
batch and ``run`` names the checkpoint.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

NAME = "manifest_table"


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """What one task attempt wrote: its file, None without rows, and the number of rows."""

    file: str | None
    rows: int


class _Transaction:
    """The steps that batches and micro-batches share."""

    def __init__(self, options: dict):
        self.path, self.run = options["path"], options["run"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files, root = _files(self.path)
        name, out, rows = f"data/{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                if out is None:
                    files.create_dir(f"{root}/data", recursive=True)
                    out = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=files)
                out.write_batch(batch)
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(name if rows else None, rows)

    def _list(self, messages: list, batch: int) -> None:
        """The commit: the manifest of the batch, unless an earlier one is there."""
        files, root = _files(self.path)
        folder, name = f"{root}/manifests/{self.run}", f"{int(batch):012d}"
        if files.get_file_info(f"{folder}/{name}.json").type != pafs.FileType.NotFound:
            return self._undo(messages)
        files.create_dir(folder, recursive=True)
        listed = {"files": [m.file for m in messages if m and m.file], "rows": sum(m.rows for m in messages if m)}
        with files.open_output_stream(f"{folder}/{name}.part") as out:
            out.write(json.dumps(listed).encode())
        files.move(f"{folder}/{name}.part", f"{folder}/{name}.json")

    def _undo(self, messages: list) -> None:
        """Take away what attempts wrote that did not come to a commit; dead attempts send no message."""
        files, root = _files(self.path)
        for m in messages:
            if m and m.file:
                files.delete_file(f"{root}/{m.file}")


class BatchTransaction(_Transaction, DataSourceArrowWriter):
    def __init__(self, options: dict):
        super().__init__(options)
        self.batch = int(options["batch"])

    def commit(self, messages: list) -> None:
        self._list(messages, self.batch)

    def abort(self, messages: list) -> None:
        self._undo(messages)


class StreamTransaction(_Transaction, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self._list(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self._undo(messages)


class ManifestTable(DataSource):
    """Sink ``manifest_table``: options ``path``, ``run`` and, for batches, ``batch``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> BatchTransaction:
        if overwrite:
            raise ValueError(f"{NAME} only appends; a batch that was committed stays as it is")
        return BatchTransaction(self.options)

    def streamWriter(self, schema, overwrite: bool) -> StreamTransaction:
        return StreamTransaction(self.options)


def write_transaction(df: DataFrame, path: str, run: str, batch: int) -> None:
    """Write ``df`` as one batch of a run; nothing changes if that batch was committed before."""
    df.sparkSession.dataSource.register(ManifestTable)
    df.write.format(NAME).mode("append").options(path=path, run=run, batch=str(batch)).save()


def start_transactions(stream: DataFrame, path: str, run: str, checkpoint: str, **trigger):
    """Append a stream to the table, a transaction each micro-batch. Every checkpoint needs its own ``run``."""
    stream.sparkSession.dataSource.register(ManifestTable)
    return (
        stream.writeStream.format(NAME)
        .options(path=path, run=run, checkpointLocation=checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )


def manifests(path: str) -> list[dict]:
    """files and rows of every committed batch."""
    files, root = _files(path)
    found = files.get_file_info(pafs.FileSelector(f"{root}/manifests", recursive=True, allow_not_found=True))
    out = []
    for name in sorted(f.path for f in found if f.base_name.endswith(".json")):
        with files.open_input_stream(name) as source:
            out.append(json.loads(source.read()))
    return out


def read_transactions(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all committed batches, an ordinary Parquet scan of the files that manifests list."""
    listed = [f"{path}/{name}" for m in manifests(path) for name in m["files"]]
    return spark.read.schema(schema).parquet(*listed) if listed else spark.createDataFrame([], schema)


def sweep(path: str) -> int:
    """Delete files that no manifest lists, left by dead attempts; only while nobody writes. How many they were."""
    files, root = _files(path)
    listed = {f"{root}/{name}" for m in manifests(path) for name in m["files"]}
    found = files.get_file_info(pafs.FileSelector(f"{root}/data", allow_not_found=True))
    left = [f.path for f in found if f.path not in listed]
    for name in left:
        files.delete_file(name)
    return len(left)
