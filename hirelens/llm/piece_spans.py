"""SentencePiece encoding that keeps offsets, and its decoding.

A text is normalised first: at every place the longest prefix that the model's
compiled character map knows (a double-array trie; its walk advances all
places of a batch at once) is replaced, anything else is copied. Every byte
that comes out records the byte of the original that it came from; the later
steps (marks for spaces, the leading mark, white space that a model drops)
carry the record along. The merges then run on the normalised text, and the
record projects each piece back to the bytes of the original that it stands
for: ``begins`` and ``ends``. A character without a piece becomes byte pieces;
the last of them has the character's bytes, the others are empty.

Merging takes the adjacent pair of the highest score, leftmost first (long
chunks: from a heap over a linked list). Two characters that no piece of the vocabulary has side by side are never
merged over, so a text is cut between them (before space marks and digits, at
most punctuation) and a worker remembers the pieces of up to ``MAX_CHUNKS``
such chunks; the memory is emptied when full, and chunks over ``LONG`` bytes
are not remembered.

Decoding gathers the pieces' bytes by one indexed copy per batch; a run of
byte pieces that is no UTF-8 gives U+FFFD per bad byte, the first mark of a
text is dropped where the model adds it.

Defined results: a null text gives no ids, like an empty one, null ids an
empty text; bytes that aren't UTF-8 count as U+FFFD, spans are then those of
the text so mended; repeated rows get equal results; an id beyond the
vocabulary raises. Models other than byte-fallback BPE, and those with
user-defined or unused pieces, marks as suffixes or a denormaliser, raise.
Input columns named like a result column are replaced.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hirelens.llm.common import binary_array, buffers, runs, slices, without

MAX_CHUNKS, LONG = 400_000, 64
#: characters up to which a chunk counts as short
FEW = 24
_NEVER = 1 << 60
#: ids decoded at a time
IDS_AT_ONCE = 1 << 20
#: one byte that no UTF-8 has stands for the space mark
MARK, _MARK = "▁".encode(), b"\xff"
_SPACE, _LITERAL, _CUT = 0xFF, 0xFE, 0xFD
_CHARACTER = re.compile(rb"[\x00-\x7f\xff]|[\xc0-\xfe][\x80-\xbf]*")
RESULTS = ("ids", "begins", "ends")


class CharacterMap:
    """A compiled character map: bytes to replace, and by what."""

    def __init__(self, blob: bytes):
        self.empty = not blob
        if blob:
            size = int.from_bytes(blob[:4], "little")
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
            self.texts = np.frombuffer(blob, np.uint8, offset=4 + size)
            if b"  " in blob[4 + size :]:
                raise ValueError("replacements with two spaces in a row")
            stops = np.flatnonzero(self.texts == 0)
            self.stop_of = lambda at: stops[np.searchsorted(stops, at)]

    @staticmethod
    def _offset(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places where a known prefix starts: place, its longest match's
        length, and where the replacement starts; left to right, apart."""
        length, value = np.zeros(len(data), np.int64), np.zeros(len(data), np.int64)
        at = np.arange(len(data))
        end = np.repeat(off[1:], np.diff(off))
        node = np.full(len(data), self._offset(self.units[:1])[0])
        depth = 0
        while len(at):
            byte = data[at + depth].astype(np.int64)
            node = node ^ byte
            unit = self.units[np.minimum(node, len(self.units) - 1)]
            known = (node < len(self.units)) & (unit & 0x800000FF == byte)
            at, node, unit, depth = at[known], node[known], unit[known], depth + 1
            node = node ^ self._offset(unit)
            leaf = (unit >> 8) & 1 == 1
            length[at[leaf]] = depth
            value[at[leaf]] = self.units[node[leaf]] & 0x7FFFFFFF
            on = at + depth < end[at]
            at, node = at[on], node[on]
        found = np.flatnonzero(length)
        if (found[1:] < (found + length[found])[:-1]).any():
            free, kept = 0, []
            for p, n in zip(found.tolist(), length[found].tolist()):
                if p >= free:
                    kept.append(p)
                    free = p + n
            found = np.array(kept)
        return found, length[found], value[found]


class Normalizer:
    def __init__(self, spec):
        if not spec.escape_whitespaces:
            raise ValueError("a model that keeps spaces as they are")
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.strip = spec.add_dummy_prefix, spec.remove_extra_whitespaces

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts that lie one after another, normalised, with one byte a mark;
        their offsets; and the source of every byte, with one more per text
        for its end (so a text's sources start at its offset + its number)."""
        n = len(off) - 1
        source = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
        some = np.diff(off) > 0
        size = np.diff(off)
        if not self.map.empty and len(data):
            at, length, value = self.map.longest(data, off)
            put = self.map.stop_of(value) - value
            copies = np.ones(len(data), np.int64)
            covered = np.zeros(len(data) + 1, np.int64)
            covered[at] += 1
            np.add.at(covered, at + length, -1)
            copies[np.cumsum(covered[:-1]) > 0] = 0
            copies[at] = put
            origin = np.arange(len(data))
            origin[at] = len(data) + value
            data = np.concatenate([data, self.map.texts])[np.repeat(origin, copies) + runs(copies)]
            source = np.repeat(source, copies)
            off = np.concatenate([[0], np.cumsum(copies)])[off]
        out = data.copy()
        out[data == 0x20] = _SPACE
        literal = np.flatnonzero((data[:-2] == MARK[0]) & (data[1:-1] == MARK[1]) & (data[2:] == MARK[2]))
        keep = np.ones(len(out), bool)
        out[literal] = _LITERAL
        keep[literal + 1] = keep[literal + 2] = False
        last = size.copy()
        lead = np.zeros(n, np.int64)
        if self.strip and len(out):
            text = np.repeat(np.arange(n), np.diff(off))
            space = out == _SPACE
            after = np.zeros(len(out), bool)
            after[1:] = space[:-1] & (text[1:] == text[:-1])
            after[off[:-1][off[:-1] < off[1:]]] = True
            keep &= ~(space & after)
            # marks at the end go, those that stood in the text as well
            ink = keep & ~space & (out != _LITERAL)
            place = np.where(ink, np.arange(len(out)), -1)
            final = np.maximum.reduceat(np.append(place, -1), np.minimum(off[:-1], len(out)))
            final = np.where(np.diff(off) > 0, final, -1)
            trail = keep & (np.arange(len(out)) > final[text]) & (space | (out == _LITERAL))
            np.minimum.at(last, text[trail], source[trail])
            keep &= ~trail
            # what comes first after leading spaces: the leading mark's source
            shown = np.where(~space, np.arange(len(out)), len(out))
            begin = np.minimum.reduceat(np.append(shown, len(out)), np.minimum(off[:-1], len(out)))
            has = (np.diff(off) > 0) & (begin < len(out)) & (begin < off[1:])
            lead[has] = source[begin[has]]
            some = some & (final >= 0)
        if literal.size or self.strip:
            out[out == _LITERAL] = _SPACE
            off = np.concatenate([[0], np.cumsum(keep)])[off]
            out, source = out[keep], source[keep]
        if self.prefix:
            marked = np.flatnonzero(some)
            out = np.insert(out, off[marked], _SPACE)
            source = np.insert(source, off[marked], lead[marked])
            off = off + np.concatenate([[0], np.cumsum(some)])
        source = np.insert(source, off[1:], last)
        return out, off, source


def _model(path: str):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    t = m.trainer_spec
    kinds = {p.type for p in m.pieces}
    piece = m.SentencePiece
    if t.model_type != t.BPE or not t.byte_fallback or t.treat_whitespace_as_suffix or kinds & {piece.USER_DEFINED, piece.UNUSED} or m.denormalizer_spec.precompiled_charsmap:
        raise ValueError("not a plain byte-fallback BPE model")
    return m


class Encoder:
    def __init__(self, path: str):
        m = _model(path)
        self.normalize = Normalizer(m.normalizer_spec)
        piece = m.SentencePiece
        # by the piece's bytes: its place in the order of merges (equal scores share one), its id and length
        normal = {p.piece.encode().replace(MARK, _MARK): (-p.score, i) for i, p in enumerate(m.pieces) if p.type == piece.NORMAL}
        place = {score: i for i, score in enumerate(sorted({score for score, _ in normal.values()}))}
        self.order = {p: place[score] for p, (score, _) in normal.items()}
        self.packed = {p: (i | len(p) << 32).to_bytes(8, "little") for p, (_, i) in normal.items()}
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(m.pieces) if p.type == piece.BYTE}
        # bytes that some piece has side by side, and those inside a character
        self.beside = np.zeros((256, 256), bool)
        self.beside[:, 0x80:0xC0] = True
        for p in self.order:
            one = np.frombuffer(p, np.uint8)
            self.beside[one[:-1], one[1:]] = True
        self.chunks: dict[bytes, bytes] = {}

    def merged(self, raw: bytes) -> bytes:
        """Pieces of a chunk: id and, in the upper half, its length."""
        parts = _CHARACTER.findall(raw)
        parts = self.few(parts) if len(parts) <= FEW else self.many(parts)
        try:
            return b"".join([self.packed[p] for p in parts])
        except KeyError:
            return b"".join([self.packed.get(p) or self.spelt(p) for p in parts])

    def spelt(self, character: bytes) -> bytes:
        out = [self.byte_ids[b] for b in character.replace(_MARK, MARK)]
        out[-1] |= len(character) << 32
        return np.array(out, "<u8").tobytes()

    def few(self, parts: list[bytes]) -> list[bytes]:
        """A short chunk: the best of all adjacent pairs, time and again."""
        get = self.order.get
        pairs = [get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) != _NEVER:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], _NEVER)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], _NEVER)
        return parts

    def many(self, parts: list[bytes]) -> list[bytes]:
        """A long chunk: a heap of pairs over a linked list of parts."""
        n, get = len(parts), self.order.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(k, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (k := get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != len(both):
                continue  # one of the two has been merged with another
            parts[i], parts[j], after[i] = both, b"", after[j]
            if (j := after[i]) < n:
                before[j] = i
                if (k := get(both + parts[j])) is not None:
                    heapq.heappush(heap, (k, i, both + parts[j]))
            if (h := before[i]) >= 0 and (k := get(parts[h] + both)) is not None:
                heapq.heappush(heap, (k, h, parts[h] + both))
        return [p for p in parts if p]

    def cut(self, data: np.ndarray, off: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """The chunks of all texts, and where each text's start."""
        begins = np.zeros(len(data), bool)
        begins[1:] = ~self.beside[data[:-1], data[1:]]
        begins[off[:-1][off[:-1] < off[1:]]] = True
        places = np.flatnonzero(begins)
        marked = np.full(len(data) + len(places), _CUT, np.uint8)
        marked[np.arange(len(data)) + np.cumsum(begins)] = data
        return marked.tobytes().split(bytes([_CUT]))[1:], np.searchsorted(places, off)

    def pieces(self, data: np.ndarray, off: np.ndarray) -> list[bytes]:
        """Pieces of every normalised text, as of ``merged``."""
        parts, at = self.cut(data, off)
        known = self.chunks
        new = set(parts).difference(known)
        if len(known) + len(new) > MAX_CHUNKS:
            known.clear()
            new = set(parts)
        known.update(zip(new, map(self.merged, new)))
        out = [b"".join(map(known.__getitem__, parts[a:b])) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        for p in new:
            if len(p) > LONG:
                del known[p]
        return out

    def batch(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
        """ids, begins, ends of all texts, and where each text's start."""
        out, at, source = self.normalize(data, off)
        found = self.pieces(out, at)
        counts = np.array([len(x) // 8 for x in found], np.int64)
        flat = np.frombuffer(b"".join(found), "<u8")
        ids, lens = (flat & np.uint64(0xFFFFFFFF)).astype(np.int32), (flat >> np.uint64(32)).astype(np.int64)
        ends = np.cumsum(lens) + np.repeat(np.arange(len(counts)), counts)
        return ids, source[ends - lens].astype(np.int32), source[ends].astype(np.int32), np.concatenate([[0], np.cumsum(counts)])


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def _valid(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = data.tobytes()
    try:
        raw.decode()
        return data, off
    except UnicodeDecodeError:
        texts = [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(off[:-1], off[1:])]
        return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def encode_pieces(docs: DataFrame, path: str, text: str = "text", spans: bool = True) -> DataFrame:
    """``docs`` with ``ids`` and, if wanted, ``begins`` and ``ends``: the bytes
    of the original text that each piece stands for."""
    names = RESULTS if spans else RESULTS[:1]
    docs = without(docs, *RESULTS)
    encoder(path)  # a model that won't do raises here
    ints = T.ArrayType(T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).batch
        for whole in batches:
            for x in slices(whole, text):
                *columns, at = encode(*_valid(*buffers(x.column(x.schema.get_field_index(text)))))
                at = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays([*x.columns, *[pa.ListArray.from_arrays(at, pa.array(c)) for c in columns[: len(names)]]], names=[*x.schema.names, *names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *[T.StructField(c, ints) for c in names]]))


def _each_bad_byte(e: UnicodeDecodeError):
    return "�" * (e.end - e.start), e.end


class Decoder:
    def __init__(self, path: str):
        codecs.register_error("each_bad_byte", _each_bad_byte)
        m = _model(path)
        piece = m.SentencePiece
        texts = []
        for p in m.pieces:
            if p.type == piece.BYTE:
                texts.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == piece.CONTROL:
                texts.append(b"")
            else:
                texts.append(m.trainer_spec.unk_surface.encode() if p.type == piece.UNKNOWN else p.piece.encode().replace(MARK, b" "))
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.size = np.array([len(t) for t in texts])
        self.first = np.cumsum(self.size) - self.size
        self.control = np.array([p.type == piece.CONTROL for p in m.pieces])
        self.marked = np.array([p.type == piece.NORMAL and p.piece.startswith(MARK.decode()) for p in m.pieces])
        self.strip = m.normalizer_spec.remove_extra_whitespaces
        self.drops = self.strip or m.normalizer_spec.add_dummy_prefix

    def batch(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, and their offsets."""
        if ids.size and (ids.min() < 0 or ids.max() >= len(self.size)):
            raise ValueError("an id beyond the vocabulary")
        size, first = self.size[ids], self.first[ids]
        control = self.control[ids]
        if self.drops:
            for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                while a < b and control[a]:
                    a += 1
                while a < b and self.marked[ids[a]]:
                    size[a] -= 1
                    first[a] += 1
                    if size[a] or not self.strip:
                        break
                    a += 1
                    while a < b and control[a]:
                        a += 1
        out = self.bytes[np.repeat(first, size) + runs(size)]
        ends = np.concatenate([[0], np.cumsum(size)])
        raw = out.tobytes()
        if not control.any():
            try:
                raw.decode()
                return out, ends[off]
            except UnicodeDecodeError:
                pass
        # byte pieces on both sides of a control piece are runs of their own
        cuts = np.unique(np.concatenate([ends[off], ends[:-1][control]]))
        parts = [raw[a:b].decode("utf-8", "each_bad_byte").encode() for a, b in zip(cuts[:-1], cuts[1:])]
        at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return np.frombuffer(b"".join(parts), np.uint8), at[np.searchsorted(cuts, ends[off])]


def decode_pieces(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text that ``ids`` stand for."""
    docs = without(docs, out)
    _model(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(path)
        for x in batches:
            array = x.column(x.schema.get_field_index(ids))
            counts = array.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            off = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            flat = array.flatten().to_numpy(zero_copy_only=False)
            at = 0
            while at < x.num_rows:
                to = max(at + 1, int(np.searchsorted(off, off[at] + IDS_AT_ONCE, "right")) - 1)
                data, ends = decoder.batch(flat[off[at] : off[to]], off[at : to + 1] - off[at])
                own = x.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([*own.columns, binary_array(data, ends).cast(pa.string())], names=[*own.schema.names, out])
                at = to

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.StringType())]))
