"""Token-id files of compressed bit or byte planes with a chunk index.

A file holds the ids of its documents one after another, cut into blocks of a
fixed number of ids. A block of unsigned 32-bit ids is transposed into planes
(all lowest bytes, then all second bytes, ... or the same by bits), and every
plane is compressed on its own with zstandard; the planes that never change
shrink to a few bytes. The footer has the chunk index (ids, place and plane
sizes of every block) and the document index, so one block or one document can
be read alone.

    magic | blocks | footer (compressed) | footer length, u64 | magic

``write_ids`` sorts documents by id over the cluster, writes one file per range
and returns the files; ``read_documents`` reads files back, one task each.
Paths are URIs that pyarrow understands (file, hdfs, s3, gs) in a folder that
all executors share. A file gets its name by a rename after its last byte, so a
task that is run again replaces it by an equal one.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.tokens import encoded

MAGIC = b"IDPLANE1"
BLOCK_IDS = 1 << 16
LEVEL = 3


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Planes of ``ids``, lowest first: four byte planes or 32 bit planes."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [raw[:, i].tobytes() for i in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class PlaneWriter:
    """Writes documents to a binary file, holding one block and the index in memory."""

    def __init__(self, out: BinaryIO, kind: str = "byte", block_ids: int = BLOCK_IDS, level: int = LEVEL):
        import zstandard

        if kind not in ("byte", "bit"):
            raise ValueError("planes are of bytes or of bits")
        self.out, self.kind, self.block_ids = out, kind, block_ids
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.waiting = bytearray()
        self.at = len(MAGIC)
        self.blocks: list[list] = []
        self.doc_ids: list[int | None] = []
        self.doc_sizes: list[int] = []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids`` are little-endian unsigned 32-bit integers."""
        self.doc_ids.append(doc_id)
        self.doc_sizes.append(len(ids) // 4)
        self.waiting += ids
        size = 4 * self.block_ids
        if len(self.waiting) >= size:
            done = len(self.waiting) // size * size
            for i in range(0, done, size):
                self._block(bytes(self.waiting[i : i + size]))
            del self.waiting[:done]

    def _block(self, raw: bytes) -> None:
        planes = [self.compress(p) for p in to_planes(np.frombuffer(raw, "<u4"), self.kind)]
        self.blocks.append([len(raw) // 4, self.at, [len(p) for p in planes]])
        for p in planes:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> int:
        """Finish the file; the number of ids in it."""
        if self.waiting:
            self._block(bytes(self.waiting))
        footer = {"kind": self.kind, "blocks": self.blocks, "doc_ids": self.doc_ids, "doc_sizes": self.doc_sizes}
        packed = self.compress(json.dumps(footer).encode())
        self.out.write(packed + struct.pack("<Q", len(packed)) + MAGIC)
        return sum(self.doc_sizes)


class PlaneReader:
    """Reads a file that can seek, a block at a time."""

    def __init__(self, source: BinaryIO):
        import zstandard

        self.source = source
        self.expand = zstandard.ZstdDecompressor().decompress
        end = source.seek(0, io.SEEK_END)
        tail = len(MAGIC) + 8
        source.seek(end - tail)
        size, magic = struct.unpack("<Q", source.read(8))[0], source.read(len(MAGIC))
        source.seek(0)
        if magic != MAGIC or source.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a file of id planes")
        source.seek(end - tail - size)
        footer = json.loads(self.expand(source.read(size)))
        self.kind, self.blocks = footer["kind"], footer["blocks"]
        self.doc_ids, self.doc_sizes = footer["doc_ids"], footer["doc_sizes"]

    def block(self, k: int) -> np.ndarray:
        n, at, sizes = self.blocks[k]
        self.source.seek(at)
        return from_planes([self.expand(self.source.read(s)) for s in sizes], n, self.kind)

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """doc_id, ids before it in the file, its ids; one block and one document in memory."""
        at, k, held = 0, 0, bytearray()
        for doc_id, n in zip(self.doc_ids, self.doc_sizes):
            while len(held) < 4 * n:
                held += self.block(k).tobytes()
                k += 1
            yield doc_id, at, bytes(held[: 4 * n])
            del held[: 4 * n]
            at += n


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_ids(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    *,
    end_id: int = 0,
    kind: str = "byte",
    block_ids: int = BLOCK_IDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> list[dict]:
    """Write every document's ids and ``end_id`` in ascending id order; the files in order.

    Each file is a dict of part, file, n_docs, n_ids and base, the ids in the
    files before it. Null texts are empty texts; null ids come first; rows that
    share an id stand side by side, ordered by their text's hash. An empty
    table gives no files. The driver gets one row per file.
    """
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _file_system(folder)
        part = TaskContext.get().partitionId()
        out = writer = None
        for batch in batches:
            if writer is None and batch.num_rows:
                fs.create_dir(top, recursive=True)
                draft = f"{top}/.part-{part:06d}-{uuid.uuid4().hex}"
                out = fs.open_output_stream(draft)
                writer = PlaneWriter(out, kind, block_ids)
            for i, ids in zip(batch.column(0).to_pylist(), encoded(tokenizer, batch.column(1).to_pylist())):
                writer.add(i, ids + end)
        if writer is not None:
            n_ids = writer.close()
            out.close()
            fs.move(draft, f"{top}/part-{part:06d}.ids")
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "file": [f"{folder}/part-{part:06d}.ids"],
                    "n_docs": [len(writer.doc_ids)],
                    "n_ids": [n_ids],
                }
            )

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    files = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(write, "part int, file string, n_docs long, n_ids long")
        .collect()
    )
    base, out = 0, []
    for f in sorted(files, key=lambda r: r["part"]):
        out.append({**f.asDict(), "base": base})
        base += f["n_ids"]
    return out


READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_documents(spark, files: list[dict]) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32, read from the files."""
    if not files:
        return spark.createDataFrame([], READ_SCHEMA)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                fs, path = _file_system(file)
                with fs.open_input_file(path) as source:
                    rows = []
                    for doc_id, at, ids in PlaneReader(source).documents():
                        rows.append((doc_id, base + at, len(ids) // 4, zlib.crc32(ids)))
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    listed = spark.createDataFrame([(f["part"], f["file"], f["base"]) for f in files], "part int, file string, base long")
    return listed.repartitionByRange(len(files), "part").mapInArrow(read, READ_SCHEMA)
