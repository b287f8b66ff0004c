"""Sequence packing by non-negative least squares on the length histogram.

Every document becomes ids (public vocabulary, then ``end_id``). Whole windows
of ``WINDOW`` ids are cut off first; what is left of each document has one of
WINDOW - 1 lengths, so the corpus is a histogram of fixed size, and the plan is
made from the histogram alone:

1. Combinations of up to three lengths that fill a window are enumerated, and
   non-negative least squares (coordinate descent) solves how often to repeat
   each so that the histogram is met.
2. The counts are rounded to the nearest that the histogram still holds. What
   rounding leaves is a histogram again, for which 1 and 2 are repeated until a
   round fills windows with less than ``GAIN`` of the ids that are left.
3. Residual lengths are packed greedily: the longest, then the longest that
   still fits, for as long as that fills windows exactly. What no such window
   takes is laid end to end and cut at window edges, and the last, unfilled
   window is cut into sequences of a power of two ids. So there is no padding.

The plan gives each length ranges of ranks with closed-form places, so a
document finds its place from its rank among the documents of its length.
Ranks come from counts per (part, length), summed over parts: no length,
however frequent, meets in one task.

Documents travel in chunks of ``CHUNK`` at most (one row each, its ids in one
buffer), written to shared storage between counting and placing.

Defined results: a null or empty text has the end id alone; repeated rows are
packed each; a null id stays null; an empty table gives no pieces. Only id and
text are read, so further columns can't clash.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelens.llm import memo
from hirelens.llm.common import binary_array, buffers, column, slices, stored, vocabulary_path

WINDOW = 2048
#: documents of a chunk, at most
CHUNK = 1024
#: second lengths tried for each first one in combinations of three
SPLITS = 6
#: passes over the combinations in one round; the next round takes up what they leave
SWEEPS = 12
#: the least share of the ids left that a further round has to place
GAIN = 0.01
#: bytes of ranks that may be broadcast
BROADCAST_BYTES = 16 << 20


def combinations(lengths: list[int], window: int = WINDOW, splits: int = SPLITS) -> list[tuple[int, ...]]:
    """Sorted tuples of one to three of ``lengths`` that fill ``window``."""
    have, out = set(lengths), set()
    for a in lengths:
        if window - a in have:
            out.add(tuple(sorted((a, window - a))))
        rest = window - a
        at = bisect_right(lengths, rest // 2)
        for k in range(splits):  # spread over the lengths up to half of the rest
            if at:
                b = lengths[at * k // splits]
                if rest - b in have:
                    out.add(tuple(sorted((a, b, rest - b))))
    return sorted(out)


def solve(found: list[tuple[int, ...]], counts: dict[int, int], sweeps: int = SWEEPS) -> list[float]:
    """Repeats x >= 0 of each combination that come close to ``counts`` in
    least squares, by coordinate descent."""
    left = {n: float(c) for n, c in counts.items()}
    columns = [[(n, c.count(n)) for n in dict.fromkeys(c)] for c in found]
    x = [0.0] * len(found)
    for _ in range(sweeps):
        for k, col in enumerate(columns):
            step = sum(m * left[n] for n, m in col) / sum(m * m for _, m in col)
            new = max(0.0, x[k] + step)
            if new != x[k]:
                for n, m in col:
                    left[n] -= m * (new - x[k])
                x[k] = new
    return x


class Plan:
    """Where the r-th document of each length goes."""

    def __init__(self, counts: dict[int, int], first: int, window: int = WINDOW):
        self.window = window
        self.ranges: dict[int, list[tuple]] = {n: [] for n in counts}
        self.used = dict.fromkeys(counts, 0)
        self.next = first  # the next sequence
        left = dict(counts)
        while self._solved(left):
            pass
        self.solved = self.next - first  # sequences filled by solved combinations
        present = sorted(n for n, c in left.items() if c > 0)
        stream: list[int] = []
        while present:
            c, gap = [present[-1]], window - present[-1]
            taken = {present[-1]: 1}
            at = bisect_right(present, gap)
            while gap and at:
                n = present[at - 1]
                if left[n] > taken.get(n, 0):
                    c.append(n)
                    taken[n] = taken.get(n, 0) + 1
                    gap -= n
                    at = bisect_right(present, gap)
                else:
                    at -= 1
            if gap:
                stream.append(present.pop())
            else:
                self._repeat(tuple(sorted(c)), min(left[n] // m for n, m in taken.items()), left)
                present = [n for n in present if left[n] > 0]
        self.stream, at = self.next, 0
        for n in stream:
            self.ranges[n].append((self.used[n], None, at, 0, 0))
            at += left[n] * n
        self.stream_ids = at
        self.starts = {n: [r[0] for r in v] for n, v in self.ranges.items()}

    def _solved(self, left: dict[int, int]) -> bool:
        """Places one round of solved combinations; whether it pays to solve
        for the rest of the histogram again."""
        present = {n: left[n] for n in sorted(left) if left[n] > 0}
        ids, before = sum(n * c for n, c in present.items()), self.next
        found = combinations(list(present), self.window)
        x = solve(found, present)
        for k in sorted(range(len(found)), key=lambda k: (-x[k], k)):
            c = found[k]
            self._repeat(c, min(int(x[k] + 0.5), *(left[n] // c.count(n) for n in c)), left)
        return (self.next - before) * self.window > GAIN * ids

    def _repeat(self, c: tuple[int, ...], times: int, left: dict[int, int]) -> None:
        if times <= 0:
            return
        at = 0
        for n in dict.fromkeys(c):
            m = c.count(n)
            self.ranges[n].append((self.used[n], self.next, times, m, at))
            self.used[n] += times * m
            left[n] -= times * m
            at += m * n
        self.next += times

    def place(self, n: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the pieces of a rest."""
        ranges = self.ranges[n]
        r0, seq, a, m, at = ranges[bisect_right(self.starts[n], rank) - 1]
        if seq is not None:
            k = rank - r0
            return [(0, n, seq + k // m, at + k % m * n)]
        out, pos, start = [], a + (rank - r0) * n, 0
        while start < n:
            low, high, seq = self._edges(pos + start)
            size = min(n - start, high - pos - start)
            out.append((start, size, seq, pos + start - low))
            start += size
        return out

    def _edges(self, pos: int) -> tuple[int, int, int]:
        """The sequence of the stream that holds position ``pos``."""
        k = pos // self.window
        low, high = k * self.window, (k + 1) * self.window
        if high <= self.stream_ids:
            return low, high, self.stream + k
        seq, rest = self.stream + k, self.stream_ids - low
        while True:  # the tail: falling powers of two
            size = 1 << (rest.bit_length() - 1)
            if pos < low + size:
                return low, low + size, seq
            low, rest, seq = low + size, rest - size, seq + 1


def _chunks(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(part, chunk, ids of documents, their sizes, all their token ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, part, chunk = memo.tokenizer(path), np.array([end_id], "<u2").tobytes(), TaskContext.get().partitionId(), 0
        for whole in batches:
            for x in slices(whole, "text"):
                data, off = buffers(x.column("text"))
                raw = data.tobytes()
                ids = [i + end for i in encoder.ids([raw[a:b] for a, b in zip(off[:-1], off[1:])])]
                for at in range(0, len(ids), CHUNK):
                    own = ids[at : at + CHUNK]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part]), pa.array([chunk]), pa.array([x.column("id").slice(at, len(own)).to_pylist()], pa.list_(pa.int64())), pa.array([[len(i) // 2 for i in own]], pa.list_(pa.int64())), pa.array([b"".join(own)], pa.binary())],
                        names=["part", "chunk", "doc_ids", "sizes", "ids"],
                    )
                    chunk += 1

    return docs.mapInArrow(run, "part long, chunk long, doc_ids array<bigint>, sizes array<bigint>, ids binary")


def _ranks(chunks: DataFrame, window: int) -> DataFrame:
    """(part, chunk, first ranks by length): how many documents of a length
    come before each chunk; length 0 counts whole windows."""
    sizes = chunks.select("part", "chunk", F.explode("sizes").alias("size"))
    rest = sizes.select("part", "chunk", (F.col("size") % window).alias("n"), F.lit(1).cast("long").alias("c")).where("n > 0")
    full = sizes.select("part", "chunk", F.lit(0).cast("long").alias("n"), F.expr(f"size div {window}").alias("c")).where("c > 0")
    own = rest.union(full).groupBy("part", "chunk", "n").agg(F.sum("c").alias("c"))
    before = lambda w: F.coalesce(F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = own.groupBy("part", "n").agg(F.sum("c").alias("c")).select("part", "n", before(Window.partitionBy("n").orderBy("part")).alias("base"))
    own = own.withColumn("inner", before(Window.partitionBy("n", "part").orderBy("chunk"))).join(parts, ["part", "n"])
    return own.groupBy("part", "chunk").agg(F.map_from_entries(F.collect_list(F.struct("n", (F.col("inner") + F.col("base")).alias("r")))).alias("first"))


def _with_ranks(chunks: DataFrame, window: int, broadcast_bytes: int) -> DataFrame:
    """``chunks`` with their first ranks, by a broadcast while the ranks take
    no more than ``broadcast_bytes``, so that the ids stay where they are."""
    ranks = stored(_ranks(chunks, window), "ranks")
    few = (ranks.agg(F.sum(64 + 16 * F.size("first"))).first()[0] or 0) <= broadcast_bytes
    return chunks.join(F.broadcast(ranks) if few else ranks, ["part", "chunk"])


def pack(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = 1, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset."""
    path = path or vocabulary_path("word_bpe_49k.json")
    docs = docs.select(column(docs, id).cast("long").alias("id"), column(docs, text).alias("text"))
    chunks = stored(_chunks(docs, path, end_id), "chunks")
    size = F.explode("sizes").alias("size")
    hist = chunks.select(size).select((F.col("size") % window).alias("n"), F.expr(f"size div {window}").alias("f")).groupBy("n").agg(F.count("*").alias("c"), F.sum("f").alias("f")).collect()  # at most ``window`` rows
    plan = Plan({r["n"]: r["c"] for r in hist if r["n"]}, sum(r["f"] for r in hist), window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for k in range(x.num_rows):
                raw = np.frombuffer(x.column("ids")[k].as_buffer(), "<u2").astype("<u4").tobytes()
                first = dict(x.column("first")[k].as_py())
                out, at = [], 0
                for doc, n in zip(x.column("doc_ids")[k].as_py(), x.column("sizes")[k].as_py()):
                    whole, rest = divmod(n, window)
                    places = [(i * window, window, first[0] + i, 0) for i in range(whole)]
                    if whole:
                        first[0] += whole
                    if rest:
                        places += [(whole * window + s, m, q, o) for s, m, q, o in plan.place(rest, first[rest])]
                        first[rest] += 1
                    out += [(doc, s, m, raw[4 * (at + s) : 4 * (at + s + m)], n, q, o) for s, m, q, o in places]
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PIECE)], names=_NAMES)

    return _with_ranks(chunks, window, broadcast_bytes).mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


_PIECE = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ids (little-endian unsigned 32-bit)
    and the pieces' lengths, in order; at most a window of each."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids", "length")))
    rows = pieces.groupBy("sequence_id").agg(own.alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.col("p.length").alias("lengths"))
