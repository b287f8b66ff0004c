"""Chat formatting by columnar byte assembly.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles
every ``<|`` is written ``<||``, so no control string can arise there, and a
role's backslashes and line feeds are escaped; both are undone on reading.

Turns are range-partitioned and sorted by (conversation, turn); a conversation
with a third of all rows is spread over tasks. Per batch, numpy computes the
segments' lengths, their offsets by a running sum and the scatter indices, and
copies headers and contents into one preallocated buffer, which becomes an
Arrow binary array with one value per conversation of the batch, without
another copy. A conversation is therefore a sequence of fragments (part,
piece), each of whole turns, with its loss mask: the byte spans of the
assistant's texts.

Reading streams each conversation's fragments in order and holds one at a
time; a digest over a conversation is sequential by its nature.

Defined results: a null text or role is empty; null conversation ids form one
conversation; null turns come first; turns of one number are ordered by role
and text, repeated rows are turns of their own; an empty table has no
conversations. Only the four named columns are read, so further columns can't
clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from hirelens.llm.common import binary_array, buffers, column, runs, slices, stored

START, END = b"<|im_start|>", b"<|im_end|>\n"
LEARNED = "assistant"
_SCHEMA = "conv_id long, part int, piece int, n_turns long, formatted binary, mask_starts array<int>, mask_sizes array<int>"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.fill_null(texts, ""), "<|", "<||")


def unescape(text: bytes) -> bytes:
    return text.replace(b"<||", b"<|")


def escape_role(roles: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(escape(roles), "\\", "\\\\"), "\n", "\\n")


def unescape_role(role: bytes) -> bytes:
    return b"\\".join(x.replace(b"\\n", b"\n") for x in unescape(role).split(b"\\\\"))


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one buffer: its bytes, each turn's offset (and the end),
    and where each text begins and how long it is."""
    columns = [buffers(escape_role(roles)), buffers(escape(texts))]
    n = len(texts)
    sizes = np.empty((n, 5), np.int64)
    sizes[:, 0], sizes[:, 2], sizes[:, 4] = len(START), 1, len(END)
    sizes[:, 1], sizes[:, 3] = np.diff(columns[0][1]), np.diff(columns[1][1])
    ends = np.cumsum(sizes.ravel()).reshape(n, 5)
    starts = ends - sizes
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for k, fixed in ((0, START), (2, b"\n"), (4, END)):
        out[starts[:, k][:, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)
    for k, (data, _) in ((1, columns[0]), (3, columns[1])):
        out[np.repeat(starts[:, k], sizes[:, k]) + runs(sizes[:, k])] = data
    return out, np.concatenate([[0], ends[:, -1]]), starts[:, 3], sizes[:, 3]


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Fragments: conv_id, part, piece (their order), n_turns, formatted,
    mask_starts and mask_sizes (bytes of the fragment under the loss mask)."""
    rows = turns.select(column(turns, conv).cast("long").alias("conv"), column(turns, turn).cast("long").alias("turn"), column(turns, role).alias("role"), column(turns, text).alias("text"))
    rows = rows.repartitionByRange("conv", "turn").sortWithinPartitions("conv", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece = TaskContext.get().partitionId(), 0
        for whole in batches:
            for x in slices(whole, "text"):
                out, at, first, size = assemble(x.column("role"), x.column("text"))
                conv = x.column("conv")
                same = pc.equal(conv.slice(1), conv.slice(0, len(conv) - 1)).fill_null(False).to_numpy(False)
                null = conv.is_null().to_numpy(False)
                begins = np.concatenate([[0], np.flatnonzero(~(same | (null[1:] & null[:-1]))) + 1])
                ends = np.append(begins[1:], len(conv))
                learned = np.flatnonzero(pc.equal(x.column("role"), LEARNED).fill_null(False).to_numpy(False))
                own = np.searchsorted(begins, learned, "right") - 1
                lists = pa.array(np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(begins)))]).astype(np.int32))
                numbers = [pa.array(np.full(len(begins), part), pa.int32()), pa.array(piece + np.arange(len(begins)), pa.int32()), pa.array(ends - begins)]
                piece += len(begins)
                mask = [pa.ListArray.from_arrays(lists, pa.array(v.astype(np.int32))) for v in (first[learned] - at[begins][own], size[learned])]
                yield pa.RecordBatch.from_arrays([conv.take(pa.array(begins)), *numbers, binary_array(out, np.append(at[begins], at[-1])), *mask], names=["conv_id", "part", "piece", "n_turns", "formatted", "mask_starts", "mask_sizes"])

    return rows.mapInArrow(run, _SCHEMA)


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """The (role, text) of a fragment's turns, unescaped."""
    out = []
    for x in formatted.split(START)[1:]:
        role, _, text = x[: -len(END)].partition(b"\n")
        out.append((unescape_role(role), unescape(text)))
    return out


def code_points(raw: bytes) -> int:
    return int(((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80).sum())


def read_digests(fragments: DataFrame) -> DataFrame:
    """Per conversation, from its fragments alone: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    rows = fragments.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done = None, []

        def row():
            return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=names)

        for x in batches:
            convs, starts, sizes = (x.column(c).to_pylist() for c in ("conv_id", "mask_starts", "mask_sizes"))
            for k, conv in enumerate(convs):
                raw = x.column("formatted")[k].as_py()
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(row())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(raw):
                    state[1] += 1
                    state[2].update(role + b"\n" + text + b"\n")
                for s, n in zip(starts[k], sizes[k]):
                    text = unescape(raw[s : s + n])
                    state[3] += code_points(text)
                    state[4].update(text)
                state[5] += code_points(raw)
            if done:
                yield out()
                done = []
        if state is not None:
            done.append(row())
            yield out()

    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def format_and_read(turns: DataFrame) -> DataFrame:
    """Format, write, read back, digest."""
    return read_digests(stored(format_chats(turns), "chats"))
