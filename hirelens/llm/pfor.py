"""Token-id files of patched frame-of-reference blocks.

A block holds ``BLOCK`` ids. Its minimum is subtracted, and the differences
are packed at the width that ``PERCENTILE`` of them fit; of the others the low
bits are packed as well and the position and high bits go to the block's
exception list. A segment holds the blocks of whole documents, about
``SEGMENT`` ids, with an index of its blocks' starts, so one block can be read
without the others.

Layout of a segment (little-endian): magic ``PFR1``, u32 ids, u32 blocks; then
u32 start of each block and of the end, u32 minima, u8 widths, u8 exception
counts; then per block the packed words (16 bytes per bit of width), the
exceptions' positions (u8) and their high bits (u32).

Files are written by Spark's Parquet writer, a row per segment: ``part`` and
``seq`` number the segments in ascending document order, ``before`` counts the
part's ids before the segment, ``doc_ids`` and ``sizes`` list its documents.
Documents reach the writers by range partitioning on the id, so each task
encodes and writes its own range and nothing is gathered.

Defined results: a null or empty text has the end id alone; a null id sorts
first; rows that share an id follow one another in the order of their texts;
an empty table gives files without segments. Only id and text are read, so
further columns can't clash.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelens.llm import memo
from hirelens.llm.common import binary_array, buffers, column, runs, slices, vocabulary_path

BLOCK = 128
PERCENTILE = 0.9
SEGMENT = 1 << 18
_MAGIC = b"PFR1"
_SCHEMA = "part int, seq int, before long, doc_ids array<bigint>, sizes array<int>, payload binary"


def encode(ids: np.ndarray) -> bytes:
    """A segment's payload."""
    n = len(ids)
    n_blocks = -(-n // BLOCK)
    v = np.zeros((n_blocks, BLOCK), np.uint32)
    v.ravel()[:n] = ids
    if n % BLOCK:
        v[-1, n % BLOCK :] = ids[-1]
    low = v.min(1) if n_blocks else np.empty(0, np.uint32)
    v -= low[:, None]
    # bits of each difference: the exponent of its float, exact below 2^53
    bits = np.frexp(v.astype(np.float64))[1].astype(np.uint8)
    width = np.sort(bits, axis=1)[:, int(np.ceil(PERCENTILE * BLOCK)) - 1] if n_blocks else np.empty(0, np.uint8)
    over = bits > width[:, None]
    n_over = over.sum(1)
    sizes = width.astype(np.int64) * (BLOCK // 8) + 5 * n_over
    starts = np.concatenate([[0], np.cumsum(sizes)])
    body = np.empty(int(starts[-1]), np.uint8)
    for w in np.unique(width):
        if w == 0:
            continue
        own = np.flatnonzero(width == w)
        packed = np.packbits(((v[own][:, :, None] >> np.arange(w, dtype=np.uint32)) & 1).astype(np.uint8).reshape(len(own), -1), axis=1, bitorder="little")
        body[starts[own][:, None] + np.arange(packed.shape[1])] = packed
    at, pos = np.nonzero(over)
    k = runs(n_over)
    lists = starts[:-1] + width.astype(np.int64) * (BLOCK // 8)
    body[lists[at] + k] = pos
    high = (v[at, pos] >> width[at].astype(np.uint32)).astype("<u4").view(np.uint8).reshape(-1, 4)
    body[(lists[at] + n_over[at] + 4 * k)[:, None] + np.arange(4)] = high
    return b"".join([_MAGIC, struct.pack("<II", n, n_blocks), starts.astype("<u4").tobytes(), low.astype("<u4").tobytes(), width.tobytes(), n_over.astype(np.uint8).tobytes(), body.tobytes()])


def decode(payload: bytes, blocks: slice = slice(None)) -> np.ndarray:
    """The ids of a segment, or those of some of its blocks alone."""
    if bytes(payload[:4]) != _MAGIC:
        raise ValueError("not a segment of token ids")
    n, n_blocks = struct.unpack_from("<II", payload, 4)
    raw, at = np.frombuffer(payload, np.uint8), 12

    def take(count: int, kind: str) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(payload, kind, count, at)
        at += out.nbytes
        return out

    starts, low, width, n_over = take(n_blocks + 1, "<u4").astype(np.int64), take(n_blocks, "<u4"), take(n_blocks, "u1"), take(n_blocks, "u1").astype(np.int64)
    body = raw[at:]
    first, last, _ = blocks.indices(n_blocks)
    starts, low, width, n_over = starts[first:last], low[first:last], width[first:last], n_over[first:last]
    v = np.zeros((len(low), BLOCK), np.uint32)
    for w in np.unique(width):
        if w == 0:
            continue
        own = np.flatnonzero(width == w)
        packed = body[starts[own][:, None] + np.arange(int(w) * (BLOCK // 8))]
        bit = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(own), BLOCK, w)
        whole = np.zeros((len(own), BLOCK), np.uint32)
        for b in range(int(w)):
            whole |= bit[:, :, b].astype(np.uint32) << np.uint32(b)
        v[own] = whole
    blk = np.repeat(np.arange(len(low)), n_over)
    k = runs(n_over)
    lists = starts + width.astype(np.int64) * (BLOCK // 8)
    pos = body[lists[blk] + k]
    high = body[(lists[blk] + n_over[blk] + 4 * k)[:, None] + np.arange(4)].copy().view("<u4").ravel()
    v[blk, pos] |= high << width[blk].astype(np.uint32)
    v += low[:, None]
    return v.ravel()[: max(0, min(n, last * BLOCK) - first * BLOCK)]


def write_token_files(docs: DataFrame, to: str, id: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = 2, segment: int = SEGMENT) -> None:
    """Encode every whole text and write the files below ``to``, in ascending
    order of the id."""
    path = path or vocabulary_path("word_bpe_49k.json")
    docs = docs.select(column(docs, id).cast("long").alias("id"), column(docs, text).alias("text"))
    # a hash of the text splits the rows of a frequent id
    docs = docs.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = memo.tokenizer(path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u2").tobytes()
        seq = before = held = 0
        doc_ids: list = []
        found: list[bytes] = []

        def full() -> pa.RecordBatch:
            nonlocal seq, before, held
            ids = np.frombuffer(b"".join(found), "<u2").astype(np.uint32)
            row = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before]), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([[len(x) // 2 for x in found]], pa.list_(pa.int32())), pa.array([encode(ids)], pa.binary())]
            seq, before, held = seq + 1, before + len(ids), 0
            doc_ids.clear()
            found.clear()
            return pa.RecordBatch.from_arrays(row, names=["part", "seq", "before", "doc_ids", "sizes", "payload"])

        for whole in batches:
            for x in slices(whole, "text"):
                data, off = buffers(x.column("text"))
                raw = data.tobytes()
                for i, ids in zip(x.column("id").to_pylist(), encoder.ids([raw[a:b] for a, b in zip(off[:-1], off[1:])])):
                    doc_ids.append(i)
                    found.append(ids + end)
                    held += len(ids) // 2 + 1
                    if held >= segment:
                        yield full()
        if found:
            yield full()

    docs.mapInArrow(run, _SCHEMA).write.option("compression", "none").parquet(to)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it),
    n_tokens, ids (little-endian unsigned 32-bit)."""
    files = spark.read.schema(_SCHEMA).parquet(path)
    sizes = F.aggregate("sizes", F.lit(0).cast("long"), lambda acc, x: acc + x)
    parts = files.select("part", sizes.alias("n")).groupBy("part").agg(F.sum("n").alias("n"))  # two numbers per written file, whatever they hold
    base = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for k in range(x.num_rows):
                ids = decode(x.column("payload")[k].as_buffer()).astype("<u4")
                n = np.array(x.column("sizes")[k].as_py(), np.int64)
                off = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [x.column("doc_ids")[k].values, pa.array(off[:-1] + x.column("first")[k].as_py()), pa.array(n), binary_array(ids.view(np.uint8), off * 4)],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    placed = files.join(F.broadcast(base), "part").select("doc_ids", "sizes", "payload", (F.col("before") + F.col("base")).alias("first"))
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
