"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors of integers are put in the order of a Hilbert curve through their
directions (components in units of the vector's root mean square, a few bits
each, Skilling's transform) and written as Parquet, one row per block of
neighbours. Next to its vectors a block has a zone map: the smallest and
greatest value of every component, and its labels.

Interval arithmetic over a zone map bounds an anchor's inner products with all
of a block's rows. The bounds choose what is read, twice:

1. positives: an anchor's k-th best row of its own block is a floor; it needs
   the blocks that hold its label and may reach that floor;
2. negatives: each positive's score sets a window, from ``low`` to ``high``
   percent of it; an anchor needs the blocks that hold another label and may
   have a score in one of its windows.

Anchors go in groups of neighbours. A unit of work is a group of anchors and a
slice of a few blocks that some of them need; it multiplies only the chosen
anchors and blocks and keeps the best rows per anchor or window. Groups,
slices and blocks are of fixed size, so no task grows with the table; vectors
that are all alike are dealt out by their ids. How many blocks the bounds rule
out depends on the data: many for vectors in clusters or of few dimensions,
few where all components scatter alike.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; vectors are held against those of their
own length. Rows are told apart as rows: repeated rows each count, and a
repeated anchor row has the other one among its candidates. Scores tie to the
smaller id. With fewer positives or negatives than asked for, all are
returned; a positive of negative score has an empty window. Scores beyond a
long are held at its limits. Labels are integers. No rows give no rows. Only
id, vector and label are read, so others can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelens.llm.common import column, stored

#: components and rows of a block at most, blocks of a slice, anchors of a group
BLOCK_VALUES, BLOCK_ROWS, SLICE, GROUP = 1 << 20, 1024, 4, 1024
#: groups and blocks whose bounds are worked out together
BOUND_GROUPS, BOUND_BLOCKS = 4, 256
KEY_BITS = 128
_LEAST = np.iinfo(np.int64).min
_EXACT = 2.0**53


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers (rows x
    dimensions, below 2^bits), as rows of bytes that order like it."""
    x = [c.astype(np.int64) for c in cells.T]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(set_, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    planes = [((c ^ flip) >> b) & 1 for b in reversed(range(bits)) for c in x]
    return np.packbits(np.stack(planes, 1).astype(np.uint8), axis=1)


def _direction_keys(v: np.ndarray) -> list[bytes]:
    rows, dim = v.shape
    if not dim:
        return [b""] * rows
    bits = max(1, min(8, KEY_BITS // dim))
    top = np.abs(v).max(1, keepdims=True)
    unit = v / np.where(top > 0, top, 1)
    size = np.sqrt((unit**2).mean(1, keepdims=True))
    cells = (unit / np.where(size > 0, size, 1) + 2) / 4 * 2**bits
    return [k.tobytes() for k in hilbert_keys(np.clip(cells, 0, 2**bits - 1), bits)]


def _matrix(batch, name: str, dim: int) -> np.ndarray:
    """Vectors kept as bytes of doubles, one per row, all of one length."""
    raw = b"".join(batch.column(name).to_pylist())
    return np.frombuffer(raw, "<f8").reshape(batch.num_rows, dim)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        dims = b.column(3).to_numpy()
        for dim in np.unique(dims).tolist():
            own = b.take(pa.array(np.flatnonzero(dims == dim)))
            v = own.column(2).flatten().to_numpy(zero_copy_only=False).reshape(own.num_rows, dim) if dim else np.empty((own.num_rows, 0))
            raw = np.ascontiguousarray(v, "<f8")
            yield pa.RecordBatch.from_arrays(
                [own.column(0), own.column(1), own.column(3), pa.array([x.tobytes() for x in raw], pa.binary()), pa.array(_direction_keys(raw), pa.binary())],
                names=["id", "label", "dim", "v", "key"],
            )


def _runs_of(batches: Iterator[pa.RecordBatch], size) -> Iterator[tuple[int, pa.Table]]:
    """Rows in their order as runs of one ``dim``, of at most size(dim) rows."""
    held: list[pa.RecordBatch] = []
    now, rows = None, 0
    for b in batches:
        dims = b.column(b.schema.get_field_index("dim")).to_numpy()
        at = 0
        while at < len(dims):
            if dims[at] != now or rows == size(now):
                if rows:
                    yield now, pa.Table.from_batches(held).combine_chunks()
                held, now, rows = [], int(dims[at]), 0
            other = np.flatnonzero(dims[at:] != now)
            to = min(at + (int(other[0]) if len(other) else len(dims) - at), at + size(now) - rows)
            held.append(b.slice(at, to - at))
            rows, at = rows + to - at, to
    if rows:
        yield now, pa.Table.from_batches(held).combine_chunks()


def _narrow(v: np.ndarray) -> tuple[str, bytes]:
    most = np.abs(v).max(initial=0)
    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8"
    return kind, v.astype(kind).tobytes()


_BLOCK = "dim int, slice long, block long, rows int, kind string, v binary, ids binary, labels binary, low binary, high binary, kinds binary"


def _cut(block_rows: int):
    """Rows in Hilbert order as blocks; a slice holds blocks of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_ = (TaskContext.get().partitionId() << 32) - 1
        block, held, now = slice_, SLICE, None
        for dim, t in _runs_of(batches, lambda dim: max(1, min(block_rows, BLOCK_VALUES // max(1, dim)))):
            v, labels = _matrix(t, "v", dim), t.column("label").to_numpy()
            if held == SLICE or dim != now:
                slice_, held, now = slice_ + 1, 0, dim
            block, held = block + 1, held + 1
            kind, raw = _narrow(v)
            low, high = (v.min(0), v.max(0)) if dim else (np.empty(0), np.empty(0))
            longs = [x.astype("<i8").tobytes() for x in (t.column("id").to_numpy(), labels)]
            yield _batch([[dim, slice_, block, len(v), kind, raw, *longs, low.tobytes(), high.tobytes(), np.unique(labels).astype("<i8").tobytes()]], _BLOCK)

    return run


def _batch(rows: list, ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _table(columns: list[np.ndarray], names: list[str]) -> pa.Table:
    return pa.table([pa.array(np.asarray(c, np.int64)) for c in columns], names=names)


def _values(cell, kind: str) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind)


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of integers held as doubles: exact, within a long."""
    with np.errstate(all="ignore"):
        out = q @ v.T
        most = np.abs(q).max(1, initial=0)[:, None] * np.abs(v).max(1, initial=0)[None, :] * max(1, q.shape[1])
    big = ~(most < _EXACT)
    out[big] = 0
    out = out.astype(np.int64)
    for i, j in np.argwhere(big):
        exact = sum(int(a) * int(b) for a, b in zip(q[i], v[j]))
        out[i, j] = max(_LEAST, min(2**63 - 1, exact))
    return out


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What inner products with rows between ``low`` and ``high`` can be
    (anchors x blocks), less and more by what rounding can add."""
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    with np.errstate(all="ignore"):
        least, most = plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T
        slack = 1.0 + 1e-12 * q.shape[1] * (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T)
        least, most = least - slack, most + slack
    return np.where(np.isnan(least), -np.inf, least), np.where(np.isnan(most), np.inf, most)


_ANCHOR = "dim int, block long, place long, id long, label long, floor long, v binary"


def _anchors(every: int, k: int):
    """Anchor rows of the blocks, each with its k-th best score among the rows
    of its label in its own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                cell = lambda c: b.column(b.schema.get_field_index(c))[i]
                ids, labels = _values(cell("ids"), "<i8"), _values(cell("labels"), "<i8")
                v = _values(cell("v"), cell("kind").as_py()).reshape(len(ids), -1).astype(np.float64)
                places = np.flatnonzero(ids % every == 0)
                rows = []
                for at in range(0, len(places), 256):
                    own = places[at : at + 256]
                    s = products(v[own], v)
                    s[labels[own][:, None] != labels[None, :]] = _LEAST
                    s[np.arange(len(own)), own] = _LEAST
                    floor = np.sort(s, 1)[:, -k] if s.shape[1] >= k else np.full(len(own), _LEAST)
                    rows += [[cell("dim").as_py(), cell("block").as_py(), int(p), int(ids[p]), int(labels[p]), int(f), v[p].tobytes()] for p, f in zip(own, floor)]
                if rows:
                    yield _batch(rows, _ANCHOR)

    return run


_GROUP = "dim int, agroup long, v binary, blocks binary, places binary, ids binary, labels binary, floors binary"


def _grouped(group: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for n, (dim, t) in enumerate(_runs_of(batches, lambda dim: group)):
            longs = [t.column(c).to_numpy().astype("<i8").tobytes() for c in ("block", "place", "id", "label", "floor")]
            yield _batch([[dim, first + n, b"".join(t.column("v").to_pylist()), *longs]], _GROUP)

    return run


def _needs(choose):
    """(agroup, slice, block, chosen): which anchors of a group need a block."""

    def run(groups: pa.Table, zones: pa.Table) -> pa.Table:
        out = []
        if groups.num_rows and zones.num_rows:
            dim = groups.column("dim")[0].as_py()
            low, high = (np.stack([_values(x, "<f8") for x in zones.column(c)]) for c in ("low", "high"))
            kinds = [_values(x, "<i8") for x in zones.column("kinds")]
            for i in range(groups.num_rows):
                g = {c: groups.column(c)[i] for c in groups.column_names}
                labels = _values(g["labels"], "<i8")
                q = _values(g["v"], "<f8").reshape(len(labels), dim)
                wanted = choose(g, labels, kinds, *bounds(q, low, high))
                for z in np.flatnonzero(wanted.any(0)).tolist():
                    out.append([g["agroup"].as_py(), zones.column("slice")[z].as_py(), zones.column("block")[z].as_py(), np.flatnonzero(wanted[:, z]).astype("<i4").tobytes()])
        columns = zip(*out) if out else ([], [], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["agroup", "slice", "block", "chosen"])

    return run


def _positive_need(g, labels, kinds, least, most) -> np.ndarray:
    same = np.stack([np.isin(labels, k) for k in kinds], 1)
    return same & (most >= _values(g["floors"], "<i8").astype(np.float64)[:, None])


def _negative_need(g, labels, kinds, least, most) -> np.ndarray:
    other = np.stack([(labels != k[0]) | (len(k) > 1) for k in kinds], 1)
    near = np.zeros_like(other)
    anchor, low, high = _windows(g)
    for a, lo, hi in zip(anchor, low, high):
        near[a] |= (most[a] >= lo) & (least[a] <= hi)
    return other & near


def _windows(g) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, least and greatest score of each window of a group."""
    return tuple(_values(g[c], "<i8") for c in ("w_anchor", "w_low", "w_high"))


def _best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """Of rows (key, score, id, block, place) the k best per key."""
    key, score, id_, block, place = found
    order = np.lexsort((place, block, id_, ~score, key))
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1)) if len(key) else np.empty(0, np.int64)
    within = np.arange(len(key)) - np.repeat(first, np.diff(first, append=len(key)))
    order = order[within < k]
    return [c[order] for c in found]


def _unit(k: int, pick):
    """The k best rows per key of a group's anchors and a slice's blocks, as
    ``pick`` finds them block by block."""

    def run(groups: pa.Table, blocks: pa.Table) -> pa.Table:
        found = [np.empty(0, np.int64)] * 5
        if groups.num_rows:
            g = {c: groups.column(c)[0] for c in groups.column_names}
            dim = g["dim"].as_py()
            labels = _values(g["labels"], "<i8")
            q = _values(g["v"], "<f8").reshape(len(labels), dim)
            own_block, own_place = _values(g["blocks"], "<i8"), _values(g["places"], "<i8")
            for i in range(blocks.num_rows):
                b = {c: blocks.column(c)[i] for c in blocks.column_names}
                ids, block, chosen = _values(b["ids"], "<i8"), b["block"].as_py(), _values(b["chosen"], "<i4")
                v = _values(b["v"], b["kind"].as_py()).reshape(len(ids), dim).astype(np.float64)
                s = products(q[chosen], v)
                same = labels[chosen][:, None] == _values(b["labels"], "<i8")[None, :]
                itself = np.flatnonzero(own_block[chosen] == block)
                other = np.ones(s.shape, bool)
                other[itself, own_place[chosen][itself]] = False
                for key, row, col in pick(g, chosen, s, same, other, found, k):
                    more = [key, s[row, col], ids[col], np.full(len(col), block), col]
                    found = [np.concatenate(c) for c in zip(found, more)]
                found = _best(found, k)
        agroup = g["agroup"].as_py() if groups.num_rows else 0
        return _table([np.full(len(found[0]), agroup), *found], ["agroup", "key", "score", "id", "block", "place"])

    return run


_FOUND = "agroup long, key long, score long, id long, block long, place long"


def _kth(found: list[np.ndarray], k: int, keys: int) -> np.ndarray:
    """Per key the k-th best score so far; the least long if there are fewer."""
    out = np.full(keys, _LEAST)
    n = np.bincount(found[0], minlength=keys)
    lowest = np.full(keys, 2**63 - 1)
    np.minimum.at(lowest, found[0], found[1])
    return np.where(n >= k, lowest, out)


def _pick_positives(g, chosen, s, same, other, found, k):
    floor = np.maximum(_values(g["floors"], "<i8"), _kth(found, k, len(_values(g["labels"], "<i8"))))[chosen]
    row, col = np.nonzero(same & other & (s >= floor[:, None]))
    yield chosen[row].astype(np.int64), row, col


def _pick_negatives(g, chosen, s, same, other, found, k):
    """Keys are the group's windows; at most the k best rows of a block, and
    those that tie with them, are handed on."""
    anchor, low, high = _windows(g)
    floor = _kth(found, k, len(anchor))
    at = np.full(len(_values(g["labels"], "<i8")), -1)
    at[chosen] = np.arange(len(chosen))
    usable = ~same & other
    windows = np.flatnonzero(at[anchor] >= 0)
    for w in np.array_split(windows, max(1, -(-len(windows) // 512))):
        if not len(w):
            continue
        rows = at[anchor[w]]
        scores = s[rows]
        fits = usable[rows] & (scores >= np.maximum(low[w], floor[w])[:, None]) & (scores <= high[w][:, None])
        held = np.where(fits, scores, _LEAST)
        if held.shape[1] > k:
            kth = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]
            fits &= held >= kth[:, None]
        i, col = np.nonzero(fits)
        yield w[i], rows[i], col


def _read(groups: DataFrame, blocks: DataFrame, n_groups: int, n_blocks: int, choose, k: int, pick) -> DataFrame:
    """The k best rows per key, over the blocks that ``choose`` asks for."""
    parts = lambda n, size: max(1, -(-n // size))
    a, z = parts(n_groups, BOUND_GROUPS), parts(n_blocks, BOUND_BLOCKS)
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    zones = blocks.select("dim", "slice", "block", "low", "high", "kinds", dealt("block", z).alias("z"), numbers(a).alias("a"))
    asking = groups.select("*", dealt("agroup", a).alias("a")).select("*", numbers(z).alias("z"))
    keys = ["dim", "a", "z"]
    needs = asking.groupBy(*keys).cogroup(zones.groupBy(*keys)).applyInArrow(_needs(choose), "agroup long, slice long, block long, chosen binary")
    needs = stored(needs, "block_needs")
    wanted = needs.join(blocks.select("block", "kind", "v", "ids", "labels"), "block")
    wanted = wanted.withColumnsRenamed({"agroup": "for_group", "slice": "of_slice"})
    units = needs.select("agroup", "slice").distinct().join(groups, "agroup")
    return units.groupBy("agroup", "slice").cogroup(wanted.groupBy("for_group", "of_slice")).applyInArrow(_unit(k, pick), _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("agroup", "key").orderBy(F.desc("score"), "id", "block", "place"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _share(score, percent: int, up: bool):
    """percent of a score as a whole number, rounded up or down, in longs."""
    whole, rest = F.call_function("div", score, F.lit(100)), score % 100 * percent
    return whole * percent + (F.ceil(rest / 100) if up else F.floor(rest / 100))


def hilbert_blocks(rows: DataFrame, count: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` (id, label, v array<double>, dim) as stored blocks in Hilbert
    order with their zone maps."""
    parts = max(1, -(-count // (SLICE * block_rows)))
    keyed = rows.select("id", "label", "v", "dim").mapInArrow(_keyed, "id long, label long, dim int, v binary, key binary")
    keyed = keyed.withColumn("n", F.monotonically_increasing_id())
    # equal vectors are told apart by their rows, so that no range is one key
    order = ["dim", "key", F.xxhash64("id", "n"), "n"]
    return stored(keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_cut(block_rows), _BLOCK), "hilbert_blocks")


def hard_negatives(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, every: int = 50, block_rows: int = BLOCK_ROWS, group: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for every row whose id is divisible by ``every`` and each
    of its best ``positives`` rows of the same label, the best ``negatives``
    rows of another label whose score is ``low`` to ``high`` percent (at most
    100) of the positive's. Scores: inner products of floor(scale *
    component)."""
    if not 0 <= low <= high <= 100:
        raise ValueError("low and high are percentages")
    rows = vectors.select(column(vectors, id).cast("long").alias("id"), column(vectors, label).cast("long").alias("label"), F.transform(column(vectors, vector), lambda x: F.lit(float(scale)) * x.cast("double")).alias("v"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    rows = rows.where(~F.exists("v", lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True))))
    whole = F.transform("v", lambda x: F.when(F.abs(x) < _EXACT / 2, F.floor(x).cast("double")).otherwise(x))
    rows = rows.select("id", "label", whole.alias("v"), F.size("v").alias("dim"))
    blocks = hilbert_blocks(rows, rows.count(), block_rows)
    anchors = stored(blocks.mapInArrow(_anchors(every, positives), _ANCHOR), "anchors")
    n_anchors, n_blocks = anchors.count(), blocks.count()
    order = ["dim", "block", "place"]
    parts = max(1, -(-n_anchors // group))
    groups = stored(anchors.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_grouped(group), _GROUP), "anchor_groups")
    n_groups = groups.count()

    best = _ranked(_read(groups, blocks, n_groups, n_blocks, _positive_need, positives, _pick_positives), positives)
    edges = best.select("agroup", F.col("key").alias("anchor"), F.col("rank").alias("n"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), _share(F.col("score"), low, True).alias("low"), _share(F.col("score"), high, False).alias("high"))
    edges = edges.where("positive_score >= 0 AND low <= high")
    # the windows of a group, at most positives times its anchors, numbered
    number = F.row_number().over(Window.partitionBy("agroup").orderBy("anchor", "n")) - 1
    edges = stored(edges.withColumn("key", number.cast("long")), "windows")
    listed = edges.groupBy("agroup").agg(F.sort_array(F.collect_list(F.struct("key", "anchor", "low", "high"))).alias("w"))
    held = groups.join(listed, "agroup").select(*groups.columns, "w").mapInArrow(_with_windows(groups.columns), _GROUP + ", w_anchor binary, w_low binary, w_high binary")
    held = stored(held, "window_groups")

    found = _ranked(_read(held, blocks, n_groups, n_blocks, _negative_need, negatives, _pick_negatives), negatives)
    names = groups.select("agroup", "ids").mapInArrow(_names, "agroup long, anchor long, anchor_id long")
    return (
        found.select("agroup", "key", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(edges, ["agroup", "key"])
        .join(names, ["agroup", "anchor"])
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


def _with_windows(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = b.column(b.schema.get_field_index("w"))
            packed = []
            for name in ("anchor", "low", "high"):
                packed.append(pa.array([np.array([x[name] for x in row], "<i8").tobytes() for row in w.to_pylist()], pa.binary()))
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in columns], *packed], names=[*columns, "w_anchor", "w_low", "w_high"])

    return run


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            ids = _values(b.column(1)[i], "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), b.column(0)[i].as_py())), pa.array(np.arange(len(ids))), pa.array(ids)], names=["agroup", "anchor", "anchor_id"])
