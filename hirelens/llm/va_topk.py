"""Exact top-k search with vector-approximation files.

Vectors of integers lie in blocks of bounded size. A block of the approximation
holds one byte per component, the number of its cell among 256 of equal width
over the component's range in the block; the exact vectors lie in a table of
their own. For a query, the inner product with the cells' centres is within a
known distance of the true one, so scanning the cells alone bounds every score.

Scan: the stated queries go, in blocks, to every block of cells; a query keeps
the rows whose upper bound reaches the block's k-th best lower bound, and of
these the ones that reach the k-th best over all blocks. Reading, in the order
of the upper bounds: first the k best candidates of each query, whose worst
exact score is then a certain limit; then those whose bound reaches it. What no
bound reaches can't be among the k, ties included, and is never read.

Among rows of one vector only the k + 1 smallest ids can be in an answer; the
others aren't scanned, so large groups of copies leave no ties to be read.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do rows without an id; rows that share a query's id are its
own and no candidates; rows equal in id and vector count once; a query is held
against vectors of its own length; scores tie to the smaller id; with fewer
candidates than k, all are returned. Scores beyond a long are held at its
limits; a component that leaves the doubles when scaled counts as non-finite.
Only id and vector are read, so further columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelens.llm.common import column, stored

CELLS = 256
BLOCK_ROWS, QUERY_ROWS = 8192, 1024
#: a block of cells meets so many blocks of queries in one task
QUERY_GROUP = 64
#: into so many parts the readers of one exact vector are dealt
SALTS = 16


def _matrix(t: pa.Table) -> np.ndarray:
    v = t.column("v").combine_chunks()
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), t.column("dim")[0].as_py())


def _bytes(x: np.ndarray, kind: str) -> pa.Array:
    return pa.array([np.ascontiguousarray(x, kind).tobytes()], pa.binary())


def _pack_cells(t: pa.Table) -> pa.Table:
    """One block: ids ascending, cells and their grid."""
    order = np.argsort(t.column("id").to_numpy(), kind="stable")
    ids, v = t.column("id").to_numpy()[order], _matrix(t)[order]
    low = v.min(0) if v.size else np.zeros(v.shape[1])
    step = np.maximum(v.max(0) / CELLS - low / CELLS, 1e-300) if v.size else np.ones(v.shape[1])
    with np.errstate(over="ignore"):
        cells = np.minimum(v / step - low / step, CELLS - 1).astype(np.uint8)
    return pa.table({"dim": t.column("dim").slice(0, 1), "block": t.column("block").slice(0, 1), "ids": _bytes(ids, "<i8"), "cells": _bytes(cells, "u1"), "low": _bytes(low, "<f8"), "step": _bytes(step, "<f8")})


def _pack_queries(t: pa.Table) -> pa.Table:
    return pa.table({"dim": t.column("dim").slice(0, 1), "q_block": t.column("block").slice(0, 1), "q_ids": _bytes(t.column("id").to_numpy(), "<i8"), "q": _bytes(_matrix(t), "<f8")})


def _in_blocks(rows: DataFrame, blocks: int):
    return rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks))).groupBy("dim", "block")


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of integers held as floats;
    exact, within a long."""
    if q.shape[1] * np.abs(q).max(initial=0) * np.abs(v).max(initial=0) < 2**53:
        return np.einsum("ij,ij->i", q, v).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(x, y)) for x, y in zip(q, v)]
    return np.array([max(-(2**63), min(2**63 - 1, x)) for x in exact], np.int64)


def bounds(qs: np.ndarray, cells: np.ndarray, low: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores, one row per query."""
    with np.errstate(all="ignore"):
        near = qs @ (low + cells.astype(np.float64) * step + step / 2).T
        # half a cell per component, and what rounding can add
        slack = (np.abs(qs) @ step * 0.5 + 1e-9 * (np.abs(qs) @ (np.abs(low) + CELLS * step)) + 1e-6)[:, None]
        # beyond a double, or a long's limits, cells tell nothing
        wide = ~np.isfinite(near) | (np.abs(near) >= 2.0**62) | ~np.isfinite(slack)
        return np.where(wide, -np.inf, near - slack), np.where(wide, np.inf, near + slack)


def _scan(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for i in range(x.num_rows):
                dim = x.column("dim")[i].as_py()
                get = lambda c, kind: np.frombuffer(x.column(c)[i].as_buffer(), kind)
                ids, q_ids = get("ids", "<i8"), get("q_ids", "<i8")
                lower, upper = bounds(get("q", "<f8").reshape(len(q_ids), dim), get("cells", "u1").reshape(len(ids), dim), get("low", "<f8"), get("step", "<f8"))
                for j, qid in enumerate(q_ids):
                    own = np.flatnonzero(ids != qid)
                    if len(own) > k:
                        limit = np.partition(lower[j][own], len(own) - k)[len(own) - k]
                        own = own[upper[j][own] >= limit]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), qid)), pa.array(ids[own]), pa.array(lower[j][own]), pa.array(upper[j][own])], names=["query_id", "vec_id", "lower", "upper"])

    return run


def _score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for x in batches:
        sizes = x.column("dim").to_numpy()
        for dim in np.unique(sizes):
            t = x.filter(pa.array(sizes == dim))
            flat = lambda c: t.column(c).flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, int(dim))
            yield pa.RecordBatch.from_arrays([t.column("query_id"), t.column("vec_id"), pa.array(_scores(flat("q"), flat("v")))], names=["query_id", "vec_id", "score"])


def _read_exact(asked: DataFrame, rows: DataFrame, queries: DataFrame) -> DataFrame:
    """``asked`` (query_id, vec_id) with the exact score. Each asked vector is
    taken from the table once and dealt to its readers."""
    salt = F.pmod(F.xxhash64("query_id"), F.lit(SALTS)).cast("int")
    wanted = rows.join(asked.select(F.col("vec_id").alias("id")).distinct(), "id")
    wanted = wanted.select(F.col("id").alias("vec_id"), "v", "dim", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt"))
    q = queries.select(F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("dim").alias("q_dim"))
    met = asked.select("query_id", "vec_id", salt.alias("salt")).join(wanted, ["vec_id", "salt"]).join(q, "query_id").where(F.col("dim") == F.col("q_dim"))
    return met.select("query_id", "vec_id", "dim", "q", "v").mapInArrow(_score_rows, "query_id long, vec_id long, score long")


def _first(rows: DataFrame, k: int, *order) -> DataFrame:
    """The first k rows of each query, with ``rank``."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)


def _limit(rows: DataFrame, k: int, value: str, name: str) -> DataFrame:
    """(query_id, name): the k-th best value; null with fewer than k rows."""
    best = _first(rows.select("query_id", value), k, F.desc(value))
    return best.groupBy("query_id").agg(F.when(F.count("*") == k, F.min(value)).alias(name))


def top_k(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256, every: int = 50, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every row whose id is
    divisible by ``every``, the k best of all other rows by the inner product
    of floor(scale * component)."""
    scaled = F.transform(column(vectors, vector), lambda x: F.lit(float(scale)) * x.cast("double"))
    rows = vectors.select(column(vectors, id).cast("long").alias("id"), scaled.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    rows = rows.where(~F.exists("v", lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True))))
    rows = rows.select("id", F.transform("v", _floor).alias("v")).distinct().withColumn("dim", F.size("v"))
    rows = stored(rows, "vectors")
    queries = rows.where(F.col("id") % every == 0)
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    scanned = rows.withColumn("copy", first).where(F.col("copy") <= k + 1).drop("copy")
    blocks, q_blocks = (max(1, -(-r.count() // size)) for r, size in ((rows, block_rows), (queries, query_rows)))
    groups = -(-q_blocks // QUERY_GROUP)
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    cells = stored(_in_blocks(scanned, blocks).applyInArrow(_pack_cells, "dim int, block long, ids binary, cells binary, low binary, step binary"), "va_file")
    asked = _in_blocks(queries, q_blocks).applyInArrow(_pack_queries, "dim int, q_block long, q_ids binary, q binary")
    # every block of queries goes to every block of cells of its dimension. Spark takes a side for
    # as small as it was before its copies, so without the hint they are all sent through the driver
    asked = asked.withColumn("group", F.expr(f"q_block div {QUERY_GROUP}")).withColumn("block", numbers(blocks))
    pairs = cells.withColumn("group", numbers(groups)).hint("shuffle_hash").join(asked, ["dim", "block", "group"])
    pairs = pairs.select("dim", "ids", "cells", "low", "step", "q_ids", "q")
    found = stored(pairs.mapInArrow(_scan(k), "query_id long, vec_id long, lower double, upper double"), "candidates")
    reach = found.join(_limit(found, k, "lower", "least"), "query_id").where(F.col("least").isNull() | (F.col("upper") >= F.col("least")))
    reach = stored(reach.select("query_id", "vec_id", "upper"), "candidates")
    head = stored(_first(reach, k, F.desc("upper"), "vec_id").select("query_id", "vec_id"), "candidates")
    read = stored(_read_exact(head, rows, queries), "scores")
    certain = _limit(read, k, "score", "certain")
    # a bound is a double: it may lie below a score that it equals by what a double rounds off
    tail = reach.join(certain, "query_id").where(F.col("certain").isNotNull() & (F.col("upper") + F.abs("upper") * 1e-15 >= F.col("certain").cast("double")))
    tail = stored(tail.join(head, ["query_id", "vec_id"], "left_anti").select("query_id", "vec_id"), "candidates")
    scores = read.union(_read_exact(tail, rows, queries))
    return _first(scores, k, F.desc("score"), "vec_id").select("query_id", "rank", "vec_id", "score")


def _floor(x):
    """Floor of a double, as a double: exact at any size."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)
