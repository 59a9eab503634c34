"""Token ids of documents in bit-plane files.

A *segment* holds whole documents as one run of ids. The run is cut into blocks of a fixed number of ids; each block is
transposed into byte planes (or bit planes), so that the rarely changing high bytes stand together, and every plane is
compressed with zstandard. A segment starts with its chunk index: for each block the place of its planes and the number
of ids. Segments are rows of a Parquet table in the order of ``doc_id``; the other columns index them, so that a reader
of some documents opens only their segments, and Spark's writer commits a task's files once, whatever executors are lost.

Null texts are empty documents (the end id alone); equal or null ``doc_id`` values stay separate documents, nulls first.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievemark.llm.inputs import id_and_text, texts_of
from sievemark.llm.tokens import default_path, encoder

# Fixed values of the format.
MAGIC = b"SMBP"
HEADER = struct.Struct("<4sBxHI")  # magic, kind of planes, planes of a block, blocks
ENTRY = struct.Struct("<II")  # ids of a block, bytes of a plane
BYTE_PLANES, BIT_PLANES = 0, 1
PLANES = {BYTE_PLANES: 4, BIT_PLANES: 32}

BLOCK_IDS = 65_536
SEGMENT_IDS = 1_000_000
SEGMENT_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("first_id", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("segment", pa.binary()),
    ]
)


def to_planes(ids: np.ndarray, kind: int) -> list[bytes]:
    """Planes of a block of unsigned 32-bit ids, lowest byte or bit first."""
    as_bytes = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == BYTE_PLANES:
        return [plane.tobytes() for plane in as_bytes.T]
    bits = np.unpackbits(as_bytes, axis=1, bitorder="little")
    return [np.packbits(plane, bitorder="little").tobytes() for plane in bits.T]


def from_planes(planes: list[bytes], n_ids: int, kind: int) -> np.ndarray:
    """The block that `to_planes` took apart."""
    rows = [np.frombuffer(plane, dtype=np.uint8) for plane in planes]
    if kind == BIT_PLANES:
        bits = np.stack([np.unpackbits(row, count=n_ids, bitorder="little") for row in rows], axis=1)
        rows = list(np.packbits(bits, axis=1, bitorder="little").T)
    return np.ascontiguousarray(np.stack(rows, axis=1)).view("<u4").ravel()


def pack_segment(ids: np.ndarray, kind: int = BYTE_PLANES, block_ids: int = BLOCK_IDS, level: int = 3) -> bytes:
    """One segment: header, chunk index, compressed planes."""
    squeeze = zstandard.ZstdCompressor(level=level).compress
    blocks = [ids[at : at + block_ids] for at in range(0, len(ids), block_ids)]
    index, body = [], []
    for block in blocks:
        for plane in map(squeeze, to_planes(block, kind)):
            index.append(ENTRY.pack(len(block), len(plane)))
            body.append(plane)
    return b"".join([HEADER.pack(MAGIC, kind, PLANES[kind], len(blocks)), *index, *body])


def blocks_of(segment: bytes) -> Iterator[np.ndarray]:
    """Blocks of a segment, one at a time."""
    magic, kind, planes, blocks = HEADER.unpack_from(segment)
    if magic != MAGIC or planes != PLANES.get(kind):
        raise ValueError("not a segment of bit-plane ids")
    expand = zstandard.ZstdDecompressor().decompress
    at = HEADER.size + blocks * planes * ENTRY.size
    for block in range(blocks):
        parts = []
        for plane in range(planes):
            n_ids, size = ENTRY.unpack_from(segment, HEADER.size + (block * planes + plane) * ENTRY.size)
            parts.append(expand(segment[at : at + size]))
            at += size
        yield from_planes(parts, n_ids, kind)


def unpack_segment(segment: bytes) -> np.ndarray:
    """All ids of a segment."""
    return np.concatenate([np.empty(0, "<u4"), *blocks_of(segment)])


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, kind: int = BYTE_PLANES) -> None:
    """Encode whole texts and store their ids, each document closed by the end id, in ascending order of ``doc_id``."""

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer or default_path()).document
        part, written, size = TaskContext.get().partitionId(), 0, 0
        keys, lengths, held = [], [], []

        def close() -> pa.RecordBatch:
            nonlocal written, size
            ids = np.frombuffer(b"".join(held), "<u4")
            row = [[part], [written], [len(ids)], [list(keys)], [list(lengths)], [pack_segment(ids, kind)]]
            written, size = written + len(ids), 0
            for held_list in (keys, lengths, held):
                held_list.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, SEGMENT_SCHEMA)], schema=SEGMENT_SCHEMA)

        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                ids = encode(text)
                keys.append(key)
                lengths.append(len(ids) // 4)
                held.append(ids)
                size += lengths[-1]
                if size >= SEGMENT_IDS:
                    yield close()
        if keys:
            yield close()

    ordered = id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = "part int, first_id long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, segment binary"
    ordered.mapInArrow(segments, schema).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a stored id table from its files: doc_id, start (ids of all documents before it), ids (binary, little-endian)."""
    stored = spark.read.parquet(path)
    # One row for each written part: bounded by the number of write tasks.
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("base"))

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_segment(row["segment"])
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                values = [ids[a:b].tobytes() for a, b in zip(starts, ends)]
                first = starts + (row["base"] + row["first_id"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(first, pa.int64()), pa.array(values, pa.binary())],
                    names=["doc_id", "start", "ids"],
                )

    return stored.join(bases, "part").mapInArrow(documents, "doc_id long, start long, ids binary")


def id_digest(spark: SparkSession, path: str) -> DataFrame:
    """Place, length and checksum of each stored document."""
    read = read_ids(spark, path)
    return read.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def crc32_of(ids: bytes) -> int:
    """Checksum as `id_digest` gives it."""
    return zlib.crc32(ids)
