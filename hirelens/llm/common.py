"""Helpers shared by the corpus operators: storage, Arrow buffers, words."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.session import new_run_dir

#: bytes of text that one numpy step works on; a longer text is a step alone
SLICE_BYTES = 2 << 20


def vocabulary_path(name: str) -> str:
    """Place of an installed public vocabulary file; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their
    Python workers can import it wherever the driver has it from."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(spark.sparkContext.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, kind: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` below the shared directory and read it back: cuts the
    lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = new_run_dir(spark, f"llm_{kind}")
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less its columns named like an operator's results (in any case)."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def column(df: DataFrame, name: str):
    """Column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string or binary array; null: empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    if len(array) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, off, data = array.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.empty(0, np.uint8)
    return data, off - off[0]


def binary_array(data: np.ndarray, offsets: np.ndarray, large: bool = False) -> pa.Array:
    """Binary array over one buffer."""
    kind = pa.large_binary() if large else pa.binary()
    off = np.ascontiguousarray(offsets, np.int64 if large else np.int32)
    return pa.Array.from_buffers(kind, len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))])


def slices(batch: pa.RecordBatch, name: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts come to about ``max_bytes``."""
    _, off = buffers(batch.column(batch.schema.get_field_index(name)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + max_bytes, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.Generator(np.random.PCG64(20240607))
#: a random odd number for each byte; white space counts nothing
BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
WORD_VALUE = np.where(SPACE, np.uint64(0), BYTE_VALUE)
LOWER_VALUE = WORD_VALUE.copy()
LOWER_VALUE[65:91] = WORD_VALUE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """1, b, b^2 ... modulo 2^64."""
    global _POWERS
    if len(_POWERS) < n:
        size = 1 << int(n - 1).bit_length()
        p = np.full(size, _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segment_hash(data: np.ndarray, starts: np.ndarray, values: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """64-bit hash of data[starts[i]:starts[i+1]] for each i (the last runs to
    the end; no segment may be empty). A byte of value 0 counts nothing."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lens = np.diff(starts, append=len(data))
    pos = np.arange(starts[0], len(data)) - np.repeat(starts, lens)
    return mix(np.add.reduceat(values[data[starts[0] :]] * powers(int(lens.max()))[pos], starts - starts[0]))


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the words (runs of bytes other than ASCII white space) and
    the text that each lies in."""
    word = ~SPACE[data]
    before = np.empty(len(word), bool)
    before[1:] = word[:-1]
    before[off[:-1][off[:-1] < len(word)]] = False
    if len(word):
        before[0] = False
    starts = np.flatnonzero(word & ~before)
    return starts, np.searchsorted(off, starts, "right") - 1


def words(data: np.ndarray, off: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the text that it lies in, in order."""
    starts, doc = word_bounds(data, off)
    return segment_hash(data, starts, LOWER_VALUE if lower else WORD_VALUE), doc


def per_text(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of values[off[i]:off[i+1]] for each text."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def runs(lens: np.ndarray) -> np.ndarray:
    """0, 1 ... lens[0]-1, 0, 1 ... lens[1]-1, ..."""
    ends = np.cumsum(lens)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lens, lens)
