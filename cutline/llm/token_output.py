"""Token ids in binary files: blocks of ids in bit or byte planes, each plane compressed, with a chunk index.

A file holds the ids of consecutive documents in ascending key order. Its bytes are: magic ``CPL1``, six little-endian
unsigned 32-bit numbers (planes a block: 32 bit planes or 4 byte planes, ids a block, documents, blocks, documents without a
key, which come first, 0), an unsigned 64-bit number of ids, then the document index (key as signed 64-bit, first id and number of ids as unsigned 64-bit each),
then the chunk index (compressed size of every plane of every block, unsigned 32-bit) and the planes in that order. Files
travel as binary values of one Parquet table, so any storage that Spark reaches can hold them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cutline.llm.common import shared_folder, stored, text_batches
from cutline.llm.encoding import encoder

MAGIC = b"CPL1"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 20  # a file is closed at the first document end beyond so many ids
LEVEL = 3
RANGE_BYTES = 32 << 20  # text bytes of one range of keys, about


def planes_of(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Byte planes (4) or bit planes (32) of unsigned 32-bit ids, least significant first."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [raw[:, i].tobytes() for i in range(4)]
    return [np.packbits((raw[:, i >> 3] >> (i & 7)) & 1).tobytes() for i in range(32)]


def ids_of(planes: list[bytes], n: int) -> np.ndarray:
    raw = np.zeros((n, 4), np.uint8)
    if len(planes) == 4:
        for i, plane in enumerate(planes):
            raw[:, i] = np.frombuffer(plane, np.uint8)
    else:
        for i, plane in enumerate(planes):
            raw[:, i >> 3] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n) << (i & 7)
    return raw.reshape(-1).view("<u4")


def pack_file(keys: list[int | None], parts: list[bytes], bits: bool = False, block: int = BLOCK_IDS) -> bytes:
    """The bytes of a file with the given documents; those without a key come first."""
    nameless = sum(k is None for k in keys)
    ids = np.frombuffer(b"".join(parts), "<u4")
    lengths = np.array([len(p) // 4 for p in parts], "<u8")
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype("<u8") if len(parts) else lengths
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    chunks = [squeeze(p) for at in range(0, len(ids), block) for p in planes_of(ids[at : at + block], bits)]
    width = 32 if bits else 4
    head = MAGIC + struct.pack("<6IQ", width, block, len(keys), len(chunks) // width, nameless, 0, len(ids))
    index = np.zeros(len(keys), np.dtype([("key", "<i8"), ("start", "<u8"), ("n", "<u8")]))
    index["key"], index["start"], index["n"] = [k or 0 for k in keys], starts, lengths
    return b"".join([head, index.tobytes(), np.array([len(c) for c in chunks], "<u4").tobytes(), *chunks])


def nameless_documents(data: bytes) -> int:
    """How many documents at the start of a file have no key."""
    return struct.unpack_from("<6IQ", data, 4)[4]


def unpack_file(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The document index and all ids of a file."""
    if data[:4] != MAGIC:
        raise ValueError("not a file of token planes")
    width, block, n_docs, n_blocks, _, _, n_ids = struct.unpack_from("<6IQ", data, 4)
    at = 4 + struct.calcsize("<6IQ")
    index = np.frombuffer(data, np.dtype([("key", "<i8"), ("start", "<u8"), ("n", "<u8")]), n_docs, at)
    at += index.nbytes
    sizes = np.frombuffer(data, "<u4", n_blocks * width, at)
    at += sizes.nbytes
    expand = zstandard.ZstdDecompressor().decompress
    out = []
    for b in range(n_blocks):
        planes = []
        for size in sizes[b * width : (b + 1) * width].tolist():
            planes.append(expand(data[at : at + size]))
            at += size
        out.append(ids_of(planes, min(block, n_ids - b * block)))
    return index, np.concatenate(out) if out else np.zeros(0, "<u4")


def write_files(docs: DataFrame, path: str, end_id: int = 0, key: str = "doc_id", text: str = "text", bits: bool = False, folder: str | None = None) -> DataFrame:
    """Encode all documents and write their files; the table of files (first_key, n_docs, n_ids, payload, file_no) comes back.

    Documents go to ranges of ascending key (equal keys by a hash of the text, so any run gives the same order), a task
    streams its range and closes a file after ``FILE_IDS`` ids, so it never holds more than that and one document. Null
    texts are empty; every document ends with ``end_id``. Documents without a key come first. Keys are integers; rows may repeat and
    each is written; other columns are ignored; an empty table gives no files.
    """
    narrow = docs.select(F.col(key).cast("long").alias("__key"), F.coalesce(text, F.lit("")).alias("__text"))
    size = narrow.agg(F.sum(F.octet_length("__text")).alias("b")).first()["b"] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    ordered = narrow.repartitionByRange(int(ranges), "__key", F.xxhash64("__text")).sortWithinPartitions("__key", F.xxhash64("__text"))
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        keys: list[int] = []
        parts: list[bytes] = []
        held = 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "first_key": pa.array([keys[0]], pa.int64()), "n_docs": pa.array([len(keys)], pa.int64()),
                "n_ids": pa.array([held], pa.int64()), "payload": pa.array([pack_file(keys, parts, bits)], pa.binary())})

        for batch in batches:
            for k, ids in zip(batch.column("__key").to_pylist(), encode(batch.column("__text").to_pylist())):
                keys.append(k)
                parts.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= FILE_IDS:
                    yield closed()
                    keys, parts, held = [], [], 0
        if keys:
            yield closed()

    files = text_batches(ordered, run, "first_key long, n_docs long, n_ids long, payload binary", keeps=True)
    numbered = files.withColumn("file_no", F.monotonically_increasing_id())
    return stored(numbered, folder or shared_folder(docs.sparkSession))


def read_files(files: DataFrame) -> DataFrame:
    """One row per document read back from its file: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Files are unpacked where they lie; only one row per file moves to sum up the ids of the files before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, data in zip(batch.column("file_no").to_pylist(), batch.column("payload").to_pylist()):
                index, ids = unpack_file(data)
                raw = ids.tobytes()
                first, n = index["start"].astype("i8"), index["n"].astype("i8")
                crc = [zlib.crc32(raw[a * 4 : (a + b) * 4]) for a, b in zip(first.tolist(), n.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "file_no": pa.array(np.full(len(n), no, "i8")), "doc_id": pa.array(index["key"].astype("i8"), mask=np.arange(len(n)) < nameless_documents(data)), "__start": pa.array(first),
                    "n_tokens": pa.array(n), "ids_crc32": pa.array(crc, pa.int64())})

    read = text_batches(files.select("file_no", "payload"), run, "file_no long, doc_id long, __start long, n_tokens long, ids_crc32 long")
    bases = file_starts(files)
    return read.join(bases, "file_no").select("doc_id", (F.col("__start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def file_starts(files: DataFrame) -> DataFrame:
    """file_no and base, the number of ids in all files before. Two levels: groups of files, then files in a group."""
    narrow = files.select("file_no", "n_ids").withColumn("__group", F.shiftright("file_no", 33))
    groups = narrow.groupBy("__group").agg(F.sum("n_ids").alias("__n"))
    before = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    first = groups.select("__group", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("__group").orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return narrow.withColumn("__in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(first, "__group").select("file_no", (F.col("__first") + F.col("__in")).alias("base"))
