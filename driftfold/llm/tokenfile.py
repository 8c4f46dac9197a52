"""Token ids as binary segments: each document a zstandard frame of its own, one dictionary shared by all.

A dictionary is trained on the serialized ids of a bounded sample. Documents are encoded, compressed and
sorted by doc_id; each sorted partition is packed into segments, and Spark writes these as rows of a
table, so that any store Spark can write will do and a failed task leaves nothing behind. A segment holds

    magic "DFTS", version u8, bytes an id u8, documents u32, SHA-256 of the dictionary,
    index: doc_id i64, null flag u8, ids u64, first id u64 (within the partition), frame offset u64 (one more than documents)
    frames

so a document is read from its segment alone: two index entries and one short frame.

Edge cases: null text is the empty text, whose only id is the end id; documents of null doc_id come first;
rows of equal doc_id are ordered by length and content; an empty table makes no segment.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftfold.llm.bpe import coder, read_spec
from driftfold.llm.common import column, hash_sample, materialize, slices, small_batches, texts_of

END_ID = 1
MAGIC, VERSION, HEAD = b"DFTS", 1, struct.Struct("<4sBBI32s")
LEVEL = 3
#: Bounds of the dictionary and its sample: documents, bytes of each, bytes of the dictionary.
SAMPLE_DOCS, SAMPLE_BYTES, DICT_BYTES = 2_000, 8_192, 64 * 1024
#: A segment ends at so many documents or bytes of frames.
SEGMENT_DOCS, SEGMENT_BYTES = 2_048, 4_000_000


@dataclass(frozen=True)
class Codec:
    """Bytes an id takes, and the shared dictionary; empty bytes stand for none, where the sample is too small to train one."""

    width: int
    dictionary: bytes

    @property
    def dict_hash(self) -> bytes:
        return hashlib.sha256(self.dictionary).digest()


@cache
def _compressor(codec: Codec):
    import zstandard

    data = zstandard.ZstdCompressionDict(codec.dictionary) if codec.dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=False)


@cache
def _decompressor(codec: Codec):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(codec.dictionary) if codec.dictionary else None)


def serialize(ids: bytes, width: int) -> bytes:
    """Ids as little-endian integers of the codec's width."""
    return np.frombuffer(ids, dtype="<u4").astype(f"<u{width}").tobytes()


def train_dictionary(samples: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def pack(rows: list[tuple[int | None, int, bytes]], first: int, codec: Codec) -> bytes:
    """A segment of (doc_id, ids, frame) rows; first: ids before it in its partition."""
    n = len(rows)
    counts = np.array([r[1] for r in rows], dtype="<u8")
    starts = first + np.concatenate(([0], np.cumsum(counts[:-1]))).astype("<u8")
    offsets = np.concatenate(([0], np.cumsum([len(r[2]) for r in rows]))).astype("<u8")
    index = np.array([r[0] or 0 for r in rows], dtype="<i8").tobytes() + bytes(r[0] is None for r in rows) + counts.tobytes() + starts.astype("<u8").tobytes() + offsets.tobytes()
    return HEAD.pack(MAGIC, VERSION, codec.width, n, codec.dict_hash) + index + b"".join(r[2] for r in rows)


class Segment:
    """A packed segment; documents are decompressed only when asked for."""

    def __init__(self, data: bytes, codec: Codec):
        magic, version, width, n, dict_hash = HEAD.unpack_from(data)
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError("not a token segment of this version")
        if dict_hash != codec.dict_hash or width != codec.width:
            raise ValueError("the segment was written with another dictionary")
        at = HEAD.size
        self.ids_of = np.frombuffer(data, "<i8", n, at)
        self.null = np.frombuffer(data, "u1", n, at + 8 * n)
        self.counts = np.frombuffer(data, "<u8", n, at + 9 * n)
        self.starts = np.frombuffer(data, "<u8", n, at + 17 * n)
        self.offsets = np.frombuffer(data, "<u8", n + 1, at + 25 * n)
        self.frames = memoryview(data)[at + 33 * n + 8 :]
        self.codec = codec

    def __len__(self) -> int:
        return len(self.ids_of)

    def doc_id(self, i: int) -> int | None:
        return None if self.null[i] else int(self.ids_of[i])

    def ids(self, i: int) -> np.ndarray:
        raw = _decompressor(self.codec).decompress(self.frames[self.offsets[i] : self.offsets[i + 1]], max_output_size=int(self.counts[i]) * self.codec.width)
        found = np.frombuffer(raw, f"<u{self.codec.width}")
        if len(found) != self.counts[i]:
            raise ValueError(f"document {self.doc_id(i)}: {len(found)} ids, {self.counts[i]} in the index")
        return found


def fit_codec(docs: DataFrame, path: str) -> Codec:
    """Train the dictionary on SAMPLE_DOCS documents, taken by hash of their id."""
    spec = read_spec(path)
    sent = docs.sparkSession.sparkContext.broadcast(spec)
    width = 2 if len(coder(spec).pieces) <= 1 << 16 else 4

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(sent.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([serialize(code.encode(x), width)[:SAMPLE_BYTES] for x in texts_of(batch)], pa.binary())], names=["ids"])

    samples = hash_sample(docs.select("doc_id", "text"), "doc_id", SAMPLE_DOCS).select("text").mapInArrow(encode, "ids binary").toArrow().column("ids").to_pylist()
    return Codec(width, train_dictionary([x for x in samples if x]))


def write_segments(docs: DataFrame, path: str, codec: Codec, end_id: int = END_ID) -> DataFrame:
    """Encode, sort and pack docs(doc_id, text); the written table (part, nth, n_docs, n_ids, segment)."""
    spark = docs.sparkSession
    spec, sent = spark.sparkContext.broadcast(read_spec(path)), spark.sparkContext.broadcast(codec)
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, codec = coder(spec.value), sent.value
        for batch in slices(batches):
            ids = [code.encode(x) + end for x in texts_of(batch)]
            frames = [_compressor(codec).compress(serialize(x, codec.width)) for x in ids]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id").cast(pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(frames, pa.binary())], names=["doc_id", "n", "crc", "frame"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = sent.value, TaskContext.get().partitionId()
        rows, size, nth, first = [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal size, nth, first
            n = sum(r[1] for r in rows)
            out = pa.RecordBatch.from_pydict({"part": [part], "nth": [nth], "n_docs": [len(rows)], "n_ids": [n], "segment": [pack(rows, first, codec)]}, schema=schema)
            rows.clear()
            size, nth, first = 0, nth + 1, first + n
            return out

        for batch in batches:
            for row in zip(*(column(batch, c).to_pylist() for c in ("doc_id", "n", "frame")), strict=True):
                rows.append(row)
                size += len(row[2])
                if len(rows) >= SEGMENT_DOCS or size >= SEGMENT_BYTES:
                    yield flush()
        if rows:
            yield flush()

    schema = pa.schema([("part", pa.int32()), ("nth", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("segment", pa.binary())])
    # Written first: a range partitioner reads its input twice, and the second time should not encode it again.
    encoded = materialize(docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, n long, crc long, frame binary"), "frames")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = encoded.repartitionByRange(parts, "doc_id", "n", "crc").sortWithinPartitions("doc_id", "n", "crc")
    return materialize(ordered.select("doc_id", "n", "frame").mapInArrow(packed, "part int, nth int, n_docs long, n_ids long, segment binary"), "segments", compression="none")


def read_index(segments: DataFrame, codec: Codec) -> DataFrame:
    """Per document of the segments: doc_id, start, n_tokens and ids_crc32, read from index and frames."""
    spark = segments.sparkSession
    firsts, total = {}, 0
    for row in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        firsts[row["part"]], total = total, total + row["n"]
    sent = spark.sparkContext.broadcast((codec, firsts))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, firsts = sent.value
        for batch in batches:
            for part, data in zip(column(batch, "part").to_pylist(), column(batch, "segment").to_pylist(), strict=True):
                seg = Segment(data, codec)
                crcs = [zlib.crc32(seg.ids(i).astype("<u4").tobytes()) for i in range(len(seg))]
                ids = pa.array([seg.doc_id(i) for i in range(len(seg))], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(seg.starts.astype(np.int64) + firsts[part]), pa.array(seg.counts.astype(np.int64)), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return segments.select("part", "segment").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_index(docs: DataFrame, path: str) -> DataFrame:
    """Write docs as segments and return what reading them back gives."""
    codec = fit_codec(small_batches(docs), path)
    return read_index(write_segments(docs, path, codec), codec)
