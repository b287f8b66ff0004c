"""Near-duplicates by MinHash with sequential Bayesian verification.

A document's set are its distinct shingles of five words (lower-cased A-Z);
documents are linked if their sets' Jaccard similarity is 0.75 or more.

1. One pass gives every text its set's size and hash, ``BANDS`` band keys of
   ``ROWS`` minima each, and a signature of one byte per minimum. A link at
   the threshold shares no band with probability (1 - 0.75^4)^32 < 6e-6.
2. Texts with equal sets count as one (the smallest id stands for them).
3. Every bucket links its smallest member with each other member: one
   candidate per member and band, whatever the bucket's size. Signatures are
   compared in batches of 32 minima; after each batch a candidate goes if the
   posterior probability of a similarity of 0.75 or more (uniform prior) is
   under ``miss``. Survivors are verified on full sets, each document's
   likeliest partner first; the rest only where it could still join two
   components.
4. That leaves pairs of members of one bucket in different components, neither
   its smallest. They are all compared, without becoming rows: a bucket's
   members outside its largest component against all its members, in cells of
   bounded size. Cells compare signatures first, and get the full sets of those
   members alone that this leaves in some pair. Nothing is capped; a bucket
   that is one component costs nothing here.
5. Components by alternating star contraction over the verified links.

Sets are held as sorted 64-bit hashes of shingles; equal hashes count as equal
shingles.

Defined results: null or empty texts have an empty set and link with nothing
(their component is their id); a row with a null id is its own component (null) and is kept; rows with
sets that share an id are one vertex; repeated rows get equal results. Only id and text are
read, so further columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import binary_array, buffers, column, mix, powers, slices, stored, words

SHINGLE = 5
ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
THRESHOLD = 75  # in hundredths
BATCH = 32
#: members on each side of a cell in step 4
BLOCK = 512

_RNG = np.random.Generator(np.random.PCG64(75))
_A = _RNG.integers(1, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and
    where each text's begin."""
    hashes, doc = words(data, off, lower=True)
    n = len(off) - 1
    count = np.bincount(doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64)
    p = powers(SHINGLE + 1)
    m = max(len(hashes) - SHINGLE + 1, 0)
    key = np.full(m, SHINGLE, np.uint64)
    for j in range(SHINGLE if m else 0):
        key += hashes[j : j + m] * p[j + 1]
    inside = doc[:m] == doc[SHINGLE - 1 :] if m else np.empty(0, bool)
    keys, docs = [mix(key[inside])], [doc[:m][inside]]
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    for k in range(1, SHINGLE):
        d = short[count[short] == k]
        key = np.full(len(d), k, np.uint64)
        for j in range(k):
            key += hashes[first[d] + j] * p[j + 1]
        keys.append(mix(key))
        docs.append(d)
    key, doc = np.concatenate(keys), np.concatenate(docs)
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    key, doc = key[new], doc[new]
    return key, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int64)


def set_hash(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set; of an empty one 0."""
    size = np.diff(at)
    some = size > 0
    a, b = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
    if some.any():
        a[some] = mix(np.add.reduceat(key, at[:-1][some]) + size[some].astype(np.uint64))
        b[some] = mix(np.bitwise_xor.reduceat(mix(key + np.uint64(1)), at[:-1][some]))
    return a, b


def minima(key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """HASHES minima of each non-empty set."""
    x = (key >> np.uint64(32)).astype(np.uint32)
    starts = at[:-1][at[1:] > at[:-1]]
    out = np.empty((len(starts), HASHES), np.uint32)
    for k in range(HASHES if len(starts) else 0):
        out[:, k] = np.minimum.reduceat(x * _A[k] + _B[k], starts)
    return out


def _sketches(id: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                key, at = shingle_sets(*buffers(batch.column(text)))
                size = np.diff(at)
                some = size > 0
                s1, s2 = set_hash(key, at)
                low = minima(key, at)
                bands = np.zeros((len(size), BANDS), np.uint64)
                k = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(low), 1))
                for r in range(ROWS):
                    k = mix(k * np.uint64(ROWS * 2 + 1) + low[:, r::ROWS])
                bands[some] = k
                sig = np.zeros((len(size), HASHES), np.uint8)
                sig[some] = low & np.uint32(255)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(id),
                        pa.array(size),
                        pa.array(s1.view(np.int64)),
                        pa.array(s2.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.view(np.int64).ravel())),
                        binary_array(sig.ravel(), np.arange(len(sig) + 1) * HASHES),
                    ],
                    names=["id", "n", "s1", "s2", "bands", "sig"],
                )

    return run


def least_matches(miss: float) -> list[int]:
    """For each count of compared minima (BATCH, 2 * BATCH ...) the fewest
    equal ones at which a similarity of the threshold or more still has a
    posterior probability of at least ``miss``."""
    s = (np.arange(20000) + 0.5) / 20000
    equal = s + (1 - s) / 256  # one byte of a minimum is compared
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(equal) + (n - m) * np.log1p(-np.minimum(equal, 1 - 1e-12))
            p = np.exp(log - log.max())
            if p[s >= THRESHOLD / 100].sum() >= miss * p.sum():
                out.append(m)
                break
    return out


def survivors(a: np.ndarray, b: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows i whose signatures a[i], b[i] aren't pruned, and their matches."""
    alive, total = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, fewest in enumerate(least):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        total = total + (a[alive, cut] == b[alive, cut]).sum(1)
        keep = total >= fewest
        alive, total = alive[keep], total[keep]
    return alive, total


def _signatures(array: pa.Array) -> np.ndarray:
    return buffers(array)[0].reshape(-1, HASHES)


def _both(pairs: DataFrame, values: DataFrame, block: int) -> DataFrame:
    """(lo, hi, a, b): the pairs with the values (rep, value) of both. A
    document with many partners has its value once per ``block`` of them, so
    these are dealt over as many groups; no task makes all of its rows."""
    parts = pairs.groupBy("lo").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    dealt = pairs.join(parts, "lo").select("lo", "hi", F.pmod(F.xxhash64("hi"), F.col("parts")).cast("int").alias("part"))
    a = values.toDF("lo", "a").join(parts, "lo").select("lo", "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return dealt.join(a, ["lo", "part"]).join(values.toDF("hi", "b"), "hi").select("lo", "hi", "a", "b")


def _prune(pairs: DataFrame, reps: DataFrame, least: list[int], block: int) -> DataFrame:
    """(lo, hi) -> (lo, hi, matches) of those that signatures leave."""
    both = _both(pairs, reps.select("rep", "sig"), block)

    def run(batches):
        for x in batches:
            at, matches = survivors(_signatures(x.column("a")), _signatures(x.column("b")), least)
            at = pa.array(at)
            yield pa.RecordBatch.from_arrays([x.column("lo").take(at), x.column("hi").take(at), pa.array(matches)], names=["lo", "hi", "matches"])

    return both.mapInArrow(run, "lo long, hi long, matches long")


def _verify(pairs: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """The pairs (lo, hi) whose full sets are similar enough."""
    both = _both(pairs.select("lo", "hi"), sets.select("rep", "keys"), block)

    def run(batches):
        for x in batches:
            (da, oa), (db, ob) = buffers(x.column("a")), buffers(x.column("b"))
            da, db = da.view(np.uint64), db.view(np.uint64)
            oa, ob = oa // 8, ob // 8
            good = [i for i in range(x.num_rows) if _similar(da[oa[i] : oa[i + 1]], db[ob[i] : ob[i + 1]])]
            at = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([x.column("lo").take(at), x.column("hi").take(at)], names=["lo", "hi"])

    return both.mapInArrow(run, "lo long, hi long")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of the edges (lo, hi), lo < hi; comp: the
    smallest node reachable. Alternating large and small stars, written and
    read back, until every edge leads to a node that has none itself."""
    e = stored(edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).distinct(), "star")
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        e = stored(large.join(low, "u").select(pairs).select("e.*").where("u <> v").distinct(), "star")
        if e.select("v").distinct().join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _labelled(df: DataFrame, comps: DataFrame, node: str, name: str) -> DataFrame:
    """``df`` with the component of ``node``; a node without links is its own."""
    c = comps.select(F.col("node").alias(node), F.col("comp").alias("_c"))
    return df.join(c, node, "left").withColumn(name, F.coalesce("_c", node)).drop("_c")


def _sets(docs: DataFrame, reps: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, keys) for the representatives ``wanted``, from their whole texts."""
    own = reps.join(wanted, "rep", "left_semi").select("rep", "s1", "s2")
    texts = docs.join(own.select(F.col("rep").alias("id")).distinct(), "id", "left_semi").select("id", "text")

    def run(batches):
        for whole in batches:
            for x in slices(whole, "text"):
                key, at = shingle_sets(*buffers(x.column("text")))
                s1, s2 = set_hash(key, at)
                yield pa.RecordBatch.from_arrays([x.column("id"), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), binary_array(key.view(np.uint8), at * 8)], names=["rep", "s1", "s2", "keys"])

    found = texts.mapInArrow(run, "rep long, s1 long, s2 long, keys binary").groupBy("rep", "s1", "s2").agg(F.first("keys").alias("keys"))
    return found.join(own, ["rep", "s1", "s2"], "left_semi").select("rep", "keys")


def _grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The runs of rows equal in ``names``, across batches."""
    rest = None
    for x in batches:
        t = pa.Table.from_batches([x])
        t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
        keys = [t.column(n).to_numpy() for n in names]
        cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1 if t.num_rows else []
        edges = [0, *cut]
        for a, b in zip(edges[:-1], edges[1:]):
            yield t.slice(a, b - a)
        rest = t.slice(edges[-1])
    if rest is not None and rest.num_rows:
        yield rest


_CELL = ["key", "i", "j"]
_MEMBER = "key long, i int, j int, left boolean, rep long, comp long, outside boolean, sig binary, bands array<bigint>"


def _grid(members: DataFrame, comps: DataFrame, reps: DataFrame, block: int) -> DataFrame:
    """The members of buckets that hold several components, their smallest
    members aside (these have been compared with all), in cells of bounded
    size: those outside a bucket's largest component (left) against all."""
    m = _labelled(members.where("size > 2 AND rep <> leader"), comps, "rep", "comp")
    parts = m.groupBy("key", "comp").agg(F.count("*").alias("c"), F.max("size").alias("size"))
    large = (
        parts.groupBy("key")
        .agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("all"), F.max("size").alias("size"))
        .select("key", F.col("top.comp").alias("top"), "all", (F.col("all") - F.col("top.c")).alias("out"), "size")
        .where("out > 0")
    )
    # a bucket's members know its size, so they are dealt over as many parts as it has blocks
    dealt = F.ceil(F.col("size") / block).cast("int")
    large = large.withColumn("part", F.explode(F.sequence(F.lit(0), dealt - 1))).drop("size")
    m = m.withColumn("part", F.pmod(F.xxhash64("rep"), dealt).cast("int")).drop("size")
    m = m.join(large, ["key", "part"]).join(reps.select("rep", "sig", "bands"), "rep")
    blocks = lambda c: F.ceil(F.col(c) / block).cast("int")
    at = lambda c: F.pmod(F.xxhash64("rep"), blocks(c)).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    row = ["rep", "comp", (F.col("comp") != F.col("top")).alias("outside"), "sig", "bands"]
    left = m.where("comp <> top").select("key", at("out").alias("i"), each("all").alias("j"), F.lit(True).alias("left"), *row)
    return left.union(m.select("key", each("out").alias("i"), at("all").alias("j"), F.lit(False).alias("left"), *row))


def _cell_pairs(t: pa.Table, least: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of a cell in different components that signatures leave, each
    only in the first bucket that it shares: rows a, rows b, matches."""
    left = t.column("left").to_numpy()
    rep, comp, outside = (t.column(c).to_numpy() for c in ("rep", "comp", "outside"))
    sig, key = _signatures(t.column("sig").combine_chunks()), t.column("key")[0].as_py()
    bands = t.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    li, ri = np.flatnonzero(left), np.flatnonzero(~left)
    step, out = max(1, (1 << 16) // max(len(ri), 1)), []
    for k in range(0, len(li), step):
        a, b = (x.ravel() for x in np.meshgrid(li[k : k + step], ri, indexing="ij"))
        ok = (comp[a] != comp[b]) & (~outside[b] | (rep[a] < rep[b]))
        a, b = a[ok], b[ok]
        at, matches = survivors(sig[a], sig[b], least)
        a, b = a[at], b[at]
        same = bands[a] == bands[b]
        first = bands[a, same.argmax(1)] == key
        out.append((a[first], b[first], matches[first]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, int),) * 3


def _similar(p: np.ndarray, q: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    if len(p) > len(q):
        p, q = q, p
    if 100 * len(p) < THRESHOLD * len(q):
        return False
    common = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
    return 100 * common >= THRESHOLD * (len(p) + len(q) - common)


def _cross_links(docs: DataFrame, members: DataFrame, comps: DataFrame, reps: DataFrame, sets: DataFrame, least: list[int], block: int) -> DataFrame:
    """(lo, hi): links that join further components, from all pairs of a
    bucket's members in different components. A cell first names the members
    that signatures leave in some pair; then only their sets go to the cells,
    which verify these pairs, likeliest first, unless a link found before in
    the cell already joins the two components. No pair is ever a row."""
    near = lambda df: df.repartition(*_CELL).sortWithinPartitions(*_CELL)

    def name(batches):
        for t in _grouped(batches, _CELL):
            a, b, _ = _cell_pairs(t, least)
            if len(a):
                yield from t.take(pa.array(np.union1d(a, b))).combine_chunks().to_batches()

    named = stored(near(_grid(members, comps, reps, block)).mapInArrow(name, _MEMBER), "named")
    missing = named.select("rep").distinct().join(sets, "rep", "left_anti")
    more = stored(_sets(docs, reps, missing), "sets")

    def verify(batches):
        for t in _grouped(batches, _CELL):
            rep, comp = (t.column(c).to_numpy() for c in ("rep", "comp"))
            data, off = buffers(t.column("keys").combine_chunks())
            keys, off = data.view(np.uint64), off // 8
            up: dict[int, int] = {}

            def root(x, up=up):
                while up.get(x, x) != x:
                    x = up[x]
                return x

            out = []
            a, b, matches = _cell_pairs(t, least)
            for k in np.argsort(-matches, kind="stable"):
                x, y = int(a[k]), int(b[k])
                c, d = root(int(comp[x])), root(int(comp[y]))
                if c != d and _similar(keys[off[x] : off[x + 1]], keys[off[y] : off[y + 1]]):
                    up[max(c, d)] = min(c, d)
                    out.append(sorted((int(rep[x]), int(rep[y]))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["lo", "hi"])

    return near(named.join(sets.union(more), "rep")).mapInArrow(verify, "lo long, hi long")


def _as_edges(comps: DataFrame) -> DataFrame:
    return comps.where("node <> comp").select(F.col("comp").alias("lo"), F.col("node").alias("hi"))


def _settle(found: DataFrame, sets: DataFrame, edges: DataFrame, block: int) -> DataFrame:
    """``edges`` and what joins further components: each document's likeliest
    pair is verified first, then the others that still could."""
    best = found.groupBy("hi").agg(F.max(F.struct("matches", (-F.col("lo")).alias("lo"))).alias("b")).select((-F.col("b.lo")).alias("lo"), "hi")
    edges = edges.union(stored(_verify(best, sets, block), "links"))
    comps = components(edges)
    rest = found.join(best, ["lo", "hi"], "left_anti")
    rest = stored(_labelled(_labelled(rest, comps, "lo", "cl"), comps, "hi", "ch").where("cl <> ch"), "rest")
    return _as_edges(comps).union(stored(_verify(rest, sets, block), "links"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", miss: float = 1e-5, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest
    id reachable over links, its own included) and kept (id = component_id)."""
    docs = docs.select(column(docs, id).cast("long").alias("id"), column(docs, text).alias("text"))
    least = least_matches(miss)
    sketches = stored(docs.mapInArrow(_sketches("id", "text"), "id long, n long, s1 long, s2 long, bands array<bigint>, sig binary"), "sketches")
    reps = stored(
        sketches.where("n > 0 AND id IS NOT NULL").groupBy("s1", "s2").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig")),
        "reps",
    )
    keys = reps.select("rep", F.explode("bands").alias("key"))
    full = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("rep").alias("leader")).where("size > 1")
    members = stored(keys.join(full, "key"), "members")

    stars = members.where("rep <> leader").select(F.col("leader").alias("lo"), F.col("rep").alias("hi")).distinct()
    stars = stored(_prune(stars, reps, least, block), "stars")
    # rows that share an id are one vertex: their representatives are linked
    links = sketches.where("n > 0 AND id IS NOT NULL").select("id", "s1", "s2").distinct().join(reps.select("s1", "s2", "rep"), ["s1", "s2"])
    several = links.groupBy("id").agg(F.min("rep").alias("lo"), F.count("*").alias("c")).where("c > 1")
    edges = stored(links.join(several, "id").where("rep <> lo").select("lo", F.col("rep").alias("hi")), "edges")
    wanted = lambda pairs: pairs.select(F.col("lo").alias("rep")).union(pairs.select("hi")).distinct()
    sets = stored(_sets(docs, reps, wanted(stars)), "sets")
    edges = _settle(stars, sets, edges, block)
    comps = components(edges)
    links = stored(_cross_links(docs, members, comps, reps, sets, least, block), "links")
    if not links.isEmpty():
        comps = components(_as_edges(comps).union(links))

    labels = _labelled(reps.select("s1", "s2", "rep"), comps, "rep", "comp").select("s1", "s2", "comp")
    out = sketches.select("id", "n", "s1", "s2").join(labels, ["s1", "s2"], "left")
    comp = F.when(F.col("n") > 0, F.col("comp")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), comp).alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == comp)).alias("kept"),
    )
