"""Token ids in files of compressed planes (operator 1).

Documents are range-partitioned and sorted by id; every task encodes its
documents and writes one file:

    MAGIC  chunk ...  index  length of the index (8 bytes)  MAGIC

A chunk holds CHUNK_IDS consecutive ids, whatever documents they belong to. Its
ids are transposed into planes: plane k has byte k (or bit k) of every id, and
each plane is a Zstandard frame of its own. High planes hold almost nothing.
The index, at the end, has each chunk's place, number of ids, bytes per plane
and checksum, and each document's id and number of ids, so a reader can fetch
any document by reading the chunks it lies in.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import (
    id_and_text,
    input_file,
    output_stream,
    shuffle_partitions,
    stored,
    work_folder,
)
from wordloom.llm.encoder import encoder

MAGIC = b"IDPLANE1"
CHUNK_IDS = 1 << 16
LEVEL = 3
FILES = "part int, path string, n_docs bigint, n_ids bigint"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """The planes of uint32 ids, lowest first, without those above the largest id."""
    width = max(1, (int(ids.max(initial=0)).bit_length() + 7) // 8)
    table = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    if kind == "bit":
        bits = np.unpackbits(table, axis=1, bitorder="little")
        return [row.tobytes() for row in np.packbits(bits.T, axis=1, bitorder="little")]
    return [column.tobytes() for column in table.T]


def from_planes(planes: list[bytes], count: int, kind: str = "byte") -> np.ndarray:
    rows = np.frombuffer(b"".join(planes), np.uint8).reshape(len(planes), -1)
    if kind == "bit":
        bits = np.unpackbits(rows, axis=1, count=count, bitorder="little")
        rows = np.packbits(bits.T, axis=1, bitorder="little").T
    table = np.zeros((count, 4), np.uint8)
    table[:, : len(rows)] = rows.T
    return table.view("<u4").ravel()


class PlaneWriter:
    """Appends documents to a file; ``close`` writes the index."""

    def __init__(self, stream: pa.NativeFile, kind: str) -> None:
        self.stream, self.kind, self.pending = stream, kind, bytearray()
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.chunks: list[tuple[int, int, int]] = []
        self.plane_bytes: list[list[int]] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.pending += ids
        while len(self.pending) >= 4 * CHUNK_IDS:
            self._chunk(bytes(self.pending[: 4 * CHUNK_IDS]))
            del self.pending[: 4 * CHUNK_IDS]

    def _chunk(self, data: bytes) -> None:
        ids = np.frombuffer(data, "<u4")
        frames = [self.compress(plane) for plane in to_planes(ids, self.kind)]
        self.chunks.append((self.stream.tell(), len(ids), zlib.crc32(data)))
        self.plane_bytes.append([len(frame) for frame in frames])
        self.stream.write(b"".join(frames))

    def close(self) -> None:
        if self.pending:
            self._chunk(bytes(self.pending))
        index = io.BytesIO()
        np.savez(
            index,
            kind=np.array(self.kind),
            chunks=np.array(self.chunks, np.int64).reshape(-1, 3),
            planes=np.array([len(x) for x in self.plane_bytes], np.int64),
            plane_bytes=np.array([n for x in self.plane_bytes for n in x], np.int64),
            doc_ids=np.array([i or 0 for i in self.doc_ids], np.int64),
            no_id=np.array([i is None for i in self.doc_ids], bool),
            counts=np.array(self.counts, np.int64),
        )
        packed = self.compress(index.getvalue())
        self.stream.write(packed + len(packed).to_bytes(8, "little") + MAGIC)
        self.stream.close()


def read_planes(path: str) -> Iterator[tuple[int | None, int, bytes]]:
    """``doc_id, ids before it in the file, its ids`` in the file's order, chunk by chunk."""
    decompress = zstandard.ZstdDecompressor().decompress
    with input_file(path) as file:
        size = file.size()
        tail = file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"not a file of id planes: {path}")
        length = int.from_bytes(tail[:8], "little")
        index = np.load(io.BytesIO(decompress(file.read_at(length, size - 16 - length))))
        kind, chunks, counts = str(index["kind"]), index["chunks"], index["counts"]
        plane_bytes = np.split(index["plane_bytes"], np.cumsum(index["planes"])[:-1])
        doc_ids, no_id = index["doc_ids"].tolist(), index["no_id"].tolist()
        data, at, before, chunk = bytearray(), 0, 0, 0
        for doc, count in enumerate(counts.tolist()):
            while len(data) - at < 4 * count:
                offset, n_ids, crc = chunks[chunk].tolist()
                sizes = plane_bytes[chunk]
                blob = file.read_at(int(sizes.sum()), offset)
                ends = np.cumsum(sizes)
                frames = [decompress(blob[e - n : e]) for e, n in zip(ends, sizes, strict=True)]
                raw = from_planes(frames, n_ids, kind).tobytes()
                if zlib.crc32(raw) != crc:
                    raise ValueError(f"chunk {chunk} of {path} is damaged")
                del data[:at]
                data += raw
                at, chunk = 0, chunk + 1
            yield (None if no_id[doc] else doc_ids[doc]), before, bytes(data[at : at + 4 * count])
            at += 4 * count
            before += count


def write_ids(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    kind: str = "byte",
) -> DataFrame:
    """Encode and write all documents in ascending id order; one row per file, FILES.

    ``kind`` is "byte" or "bit" planes. ``end_id`` follows each document's ids.
    Files ascend with ``part``. A null text is empty, so it has only the end id;
    a null id sorts first; rows of one id are ordered by a hash of the text;
    an empty table gives no files. The texts are shuffled once. Every attempt
    of a task writes a file of its own and only the rows of the attempt that
    counts are returned, so a repeated task does no harm. The rows are stored:
    reading them does not write again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, end_id.to_bytes(4, "little")
        part = TaskContext.get().partitionId()
        path, writer = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.ids", None
        for batch in batches:
            ids, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text"))
            for doc_id, text in zip(ids, texts, strict=True):
                writer = writer or PlaneWriter(output_stream(path), kind)
                writer.add(doc_id, encode(text) + end)
        if writer:
            writer.close()
            row = [[part], [path], [len(writer.counts)], [sum(writer.counts)]]
            yield pa.record_batch(
                [pa.array(v, t) for v, t in zip(
                    row, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["part", "path", "n_docs", "n_ids"],
            )

    rows = id_and_text(docs, id_column, text_column)
    order = ["doc_id", F.xxhash64("text")]
    ranged = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), *order)
    return stored(ranged.sortWithinPartitions(*order).mapInArrow(write, FILES), "id-files")


def read_ids(files: DataFrame) -> DataFrame:
    """DOCUMENTS of the files of ``write_ids``: ids are little-endian uint32.

    ``start`` counts the ids of all documents before it, over all files. Files
    are spread over tasks; a task reads one chunk at a time.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(batch.column(c).to_pylist() for c in ("path", "base")),
                                  strict=True):
                rows, size = [], 0
                for doc_id, before, ids in read_planes(path):
                    rows.append((doc_id, base + before, len(ids) // 4, ids))
                    size += len(ids)
                    if size > 16 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    # One row per file, so one task can number them.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    spread = starts.repartitionByRange(shuffle_partitions(files.sparkSession), "part")
    return spread.mapInArrow(read, DOCUMENTS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids"])


def encoded_and_read_back(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write all documents to new files in the shared folder, and read those files."""
    folder = work_folder(docs.sparkSession, "id-planes")
    return read_ids(write_ids(docs, folder, tokenizer, end_id))
