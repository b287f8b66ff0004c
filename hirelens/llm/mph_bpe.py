"""Byte-level BPE with a two-tier lookup, and its decoding.

The pre-tokens of a text (matches of ``pattern``) are encoded one by one. Tier
one: a minimal perfect hash over the vocabulary (hash and displace: one slot
per token, no empty ones) gives the only token that a pre-token can equal; one
comparison decides. Tier two, for the others: the pre-token's bytes form a
linked list, and a heap of adjacent pairs merges the lowest rank first.

A text is cut before every run of ASCII white space first. No pre-token
reaches over such a cut, so a piece's ids don't depend on its neighbours, and
a worker remembers the ids of up to ``max_pieces`` pieces; the memory is emptied
when full. Texts with other white space, where a cut could fall inside a run
of mixed white space, are matched whole.

Decoding gathers the tokens' bytes by one indexed copy per batch.

Defined results: a null text gives no ids (an empty binary), like an empty
one; bytes that aren't UTF-8 count as U+FFFD; repeated rows get equal results.
Input columns named like a result column are replaced.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hirelens.llm.common import binary_array, buffers, runs, slices, without

MAX_PIECES = 600_000
#: what Unicode calls white space; within a character class
_WHITE = r"\t-\r \x85\xa0  -     　"
_PIECE = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
_OTHER_WHITE = re.compile("[\x85\xa0  -     　]")


def read_ranks(path: str) -> list[bytes]:
    """Tokens by id, from lines of base64 and rank."""
    with open(path, "rb") as f:
        found = {int(r): base64.b64decode(t) for t, r in map(bytes.split, f)}
    return [found[i] for i in range(len(found))]


class PerfectHash:
    """Minimal perfect hash of distinct byte strings: ``slot`` sends the n
    keys to 0 .. n-1 without collision, and any other string to some slot."""

    def __init__(self, keys: list[bytes], shift: list[int] | None = None, load: int = 3):
        """``shift``: what an earlier search for the same keys has found."""
        self.n, self.m = len(keys), max(1, len(keys) // load)
        self.shift = shift or self._search(keys)

    def _search(self, keys: list[bytes]) -> list[int]:
        buckets: list[list[int]] = [[] for _ in range(self.m)]
        for k in keys:
            h = xxhash.xxh3_128_intdigest(k)
            buckets[h % self.m].append(h >> 32)
        # per bucket: a displacement, or (negative) the slot of its only key
        shift = [0] * self.m
        taken = bytearray(self.n)
        order = sorted(range(self.m), key=lambda b: -len(buckets[b]))
        free = None
        for b in order:
            own = buckets[b]
            if len(own) > 1:
                d = 0
                while True:
                    at = {(h + d * (h >> 48 | 1)) % self.n for h in own}
                    if len(at) == len(own) and not any(taken[s] for s in at):
                        break
                    d += 1
                shift[b] = d
                for s in at:
                    taken[s] = 1
            elif own:  # they come last and take the free slots in turn
                if free is None:
                    free = iter([s for s in range(self.n) if not taken[s]])
                shift[b] = -1 - next(free)
        return shift

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh3_128_intdigest(key)
        d = self.shift[h % self.m]
        if d < 0:
            return -1 - d
        h >>= 32
        return (h + d * (h >> 48 | 1)) % self.n


class Encoder:
    def __init__(self, path: str, pattern: str, shift: list[int] | None = None, max_pieces: int = MAX_PIECES):
        import regex

        self.tokens = read_ranks(path)
        self.ranks = {t: i for i, t in enumerate(self.tokens)}
        self.hash = PerfectHash(self.tokens, shift)
        self.by_slot: list = [None] * len(self.tokens)
        for i, t in enumerate(self.tokens):
            self.by_slot[self.hash.slot(t)] = (t, i.to_bytes(4, "little"))
        white = pattern.replace(r"[^\s", f"[^{_WHITE}").replace(r"\s", f"[{_WHITE}]").replace(r"\S", f"[^{_WHITE}]")
        self.split = regex.compile(white).findall
        self.pieces: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        self.max_pieces = max_pieces

    def pre_token(self, raw: bytes) -> bytes:
        """Ids of one pre-token."""
        token, i = self.by_slot[self.hash.slot(raw)]
        if token == raw:
            return i
        known = self.words.get(raw)
        if known is None:
            if len(self.words) >= self.max_pieces:
                self.words.clear()
            known = self.words[raw] = self.merged(raw)
        return known

    def merged(self, raw: bytes) -> bytes:
        """Ids by merging the lowest-ranked adjacent pair, leftmost first."""
        n, ranks = len(raw), self.ranks
        after, before = list(range(1, n + 2)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\x01" * n)
        while heap:
            _, i, end = heapq.heappop(heap)
            mid = after[i] if alive[i] else n
            if mid >= n or after[mid] != end:
                continue  # one of the two has been merged with another
            alive[mid] = 0
            after[i] = end
            if end < n:
                before[end] = i
                r = ranks.get(raw[i : after[end]])
                if r is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if i > 0:
                p = before[i]
                r = ranks.get(raw[p:end])
                if r is not None:
                    heapq.heappush(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i : after[i]]])
            i = after[i]
        return np.array(out, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        if _OTHER_WHITE.search(text):
            return b"".join([self.pre_token(x.encode()) for x in self.split(text)])
        parts, known = _PIECE.findall(text), self.pieces
        try:
            return b"".join([known[p] for p in parts])
        except KeyError:
            if len(known) + len(parts) > self.max_pieces:
                known.clear()
            for p in parts:
                if p not in known:
                    known[p] = b"".join([self.pre_token(x.encode()) for x in self.split(p)])
            return b"".join([known[p] for p in parts])


_LOADED: dict[tuple, Encoder] = {}


def _encoder(path: str, pattern: str, shift: list[int] | None = None) -> Encoder:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Encoder(path, pattern, shift)
    return _LOADED[path, pattern]


def _plus(df: DataFrame, name: str) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType())])


def _append(batch: pa.RecordBatch, name: str, array: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, array], names=[*batch.schema.names, name])


def encode_bpe(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text``, little-endian unsigned 32-bit."""
    docs = without(docs, ids)
    shift = _encoder(path, pattern).hash.shift  # searched once, here: one number per three tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, pattern, shift).encode
        for whole in batches:
            for x in slices(whole, text):
                data, off = buffers(x.column(x.schema.get_field_index(text)))
                raw = data.tobytes()
                found = [encode(raw[a:b].decode("utf-8", "replace")) for a, b in zip(off[:-1], off[1:])]
                yield _append(x, ids, pa.array(found, pa.binary()))

    return docs.mapInArrow(run, _plus(docs, ids))


def decode_bpe(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that ``ids`` stand for."""
    docs = without(docs, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = read_ranks(path)
        table = np.frombuffer(b"".join(tokens), np.uint8)
        size = np.array([len(t) for t in tokens])
        first = np.cumsum(size) - size
        for whole in batches:
            for x in slices(whole, ids):
                data, off = buffers(x.column(x.schema.get_field_index(ids)))
                found = data.view("<u4")
                lens = size[found]
                decoded = table[np.repeat(first[found], lens) + runs(lens)]
                ends = np.concatenate([[0], np.cumsum(lens)])[off // 4]
                yield _append(x, out, binary_array(decoded, ends))

    return docs.mapInArrow(run, _plus(docs, out))
