"""Source divergence audit: which sources of a language use other words.

Terms are runs of letters (ASCII letters, lowered, and every character beyond
ASCII). A language keeps the terms that stand in at least ``min_docs`` of its
documents (V of them). A (language, source) group and the language as a whole
give a kept term with c of their N kept occurrences the weight
``1 + floor(10^9 (c + 2) / (N + 2V))``; two weights p, q differ by
``f = floor((p - q)^2 / (p + q))``. All of it is integer arithmetic.

Terms of a group are ranked by count cells: a term's f depends only on its
count in the group and its count in the language, so terms are counted per
(group count, language count), f is evaluated once per cell, cells of equal f
become one value, and values are taken in falling order until the number of
terms above reaches ``top``. Only the terms of these cells are looked up and
put in order (f falling, then UTF-8).

Sources are compared by f summed over all kept terms. Work is dealt out by
(language, block of terms, two blocks of sources): a unit holds the weights of
its terms as a matrix, a fixed number of terms at a time, and adds up what
every two of its sources differ by; terms that neither has are all alike and
are added as one product. No unit grows with the table, whatever the size of a
language or a source.

Words are counted within a task before anything is shuffled, so a word that is
everywhere is one row per task and group. Words are compared as bytes.

Defined results: null text, language or source count as ''. A group without
terms takes part with count 0 everywhere; a language that keeps no term has
pairs of value 0 and no terms. Repeated rows are documents of their own. A
source alone in its language has no pairs. No rows give no rows. Only the three
columns are read, so others can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelens.llm.common import binary_array, buffers, column, slices, stored

SCALE, ADDED = 10**9, 2
#: bytes of text counted at a time
COUNT_BYTES = 8 << 20
#: rows per block of terms, sources per block, terms of a matrix
TERM_ROWS, SOURCE_BLOCK, TERMS_AT_ONCE = 100_000, 256, 512
SALTS = 16

_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_COUNTS = "lang string, source string, term string, n long, docs long"


def _terms(data: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of texts that lie one after another, and each one's text."""
    mask = _TERM[data]
    before, after = np.zeros(len(mask), bool), np.zeros(len(mask), bool)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    edge = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(mask))]
    before[edge] = False
    after[edge - 1] = False
    starts, ends = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    at = np.concatenate([[0], np.cumsum(ends - starts)])
    return binary_array(_LOWER[data[mask]], at), np.searchsorted(off, starts, "right") - 1


def _codes(array: pa.Array) -> tuple[np.ndarray, pa.Array]:
    e = array.dictionary_encode()
    return e.indices.to_numpy(zero_copy_only=False).astype(np.int64), e.dictionary


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in slices(whole, "text", COUNT_BYTES):
            words, doc = _terms(*buffers(b.column(0)))
            term, found = _codes(words)
            lang, langs = _codes(b.column(1))
            source, sources = _codes(b.column(2))
            _, any_row, group = np.unique(lang * len(sources) + source, return_index=True, return_inverse=True)
            # once per document and term, then per group and term
            per_doc, n = np.unique(doc * max(1, len(found)) + term, return_counts=True)
            d, t = np.divmod(per_doc, max(1, len(found)))
            key = group[d] * max(1, len(found)) + t
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            g, t = np.divmod(key[order][first], max(1, len(found)))
            docs = np.diff(first, append=len(key))
            total = np.add.reduceat(n[order], first) if len(first) else np.empty(0, np.int64)
            # and a row without a term for each group
            g, row = np.concatenate([g, np.arange(len(any_row))]), any_row
            name = pa.concat_arrays([found.take(pa.array(t)).cast(pa.string()), pa.array([""] * len(row), pa.string())])
            zero = np.zeros(len(row), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(pa.array(lang[row][g])),
                    sources.take(pa.array(source[row][g])),
                    name,
                    pa.array(np.concatenate([total, zero]), pa.int64()),
                    pa.array(np.concatenate([docs, zero]), pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term
    per group, and for every group a row with the term ''."""
    said = lambda c: F.coalesce(column(docs, c).cast("string"), F.lit(""))
    rows = docs.select(said(text).alias("text"), said(lang).alias("lang"), said(source).alias("source"))
    return rows.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _weight(count: Column, total: Column, vocabulary: Column) -> Column:
    wide = lambda c: c.cast("decimal(20,0)")
    all_ = wide(total) + F.lit(ADDED).cast("decimal(1,0)") * wide(vocabulary)
    part = (wide(count) + F.lit(ADDED).cast("decimal(1,0)")) * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", part, F.nullif(all_, F.lit(0).cast("decimal(1,0)")))


def _differ(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _dealt(df: DataFrame, *by: str) -> DataFrame:
    return df.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))


def _repeated(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))


_UNIT = "lang string, a string, b string, more long"


def _unit(t: pa.Table) -> pa.Table:
    """What every two sources of a unit differ by over the unit's terms, less
    what as many terms that neither has would give. Each two sources meet in
    one unit per block of terms: within their block, or between the two."""
    source, names = _codes(t.column("source").combine_chunks())
    n, block = len(names), t.column("block").to_numpy()
    none, own = np.zeros(n, np.int64), np.zeros(n, np.int64)
    none[source], own[source] = t.column("p0").to_numpy(), block
    p = t.column("p").to_numpy()
    by_name = np.argsort(pc.rank(names, tiebreaker="first").to_numpy()) if n else np.empty(0, np.int64)
    place = np.empty(n, np.int64)
    place[by_name] = np.arange(n)
    names, none, own, source = names.take(pa.array(by_name)), none[by_name], own[by_name], place[source]
    # a row without a term only names its source
    used = t.column("term").combine_chunks().is_valid().to_numpy(zero_copy_only=False)
    term, found = _codes(t.column("term").combine_chunks().filter(pa.array(used)))
    source, p = source[used], p[used]
    low, high = t.column("low")[0].as_py(), t.column("high")[0].as_py()
    first, second = np.triu_indices(n, 1)
    meet = (own[first] != own[second]) if low != high else np.ones(len(first), bool)
    first, second = first[meet], second[meet]
    sums = np.zeros(len(first), np.int64)
    cut = np.flatnonzero(np.diff(first, prepend=-1)).tolist() + [len(first)]
    order = np.argsort(term, kind="stable")
    term, source, p = term[order], source[order], p[order]
    for at in range(0, len(found), TERMS_AT_ONCE):
        to = min(at + TERMS_AT_ONCE, len(found))
        rows = slice(*np.searchsorted(term, [at, to]))
        weights = np.repeat(none[:, None], to - at, axis=1)
        weights[source[rows], term[rows] - at] = p[rows]
        for i, j in zip(cut[:-1], cut[1:]):
            a, others = first[i], second[i:j]
            x, y = weights[a], weights[others]
            apart = (x - y) ** 2 // (x + y)
            sums[i:j] += apart.sum(1) - (to - at) * ((none[a] - none[others]) ** 2 // (none[a] + none[others]))
    return pa.table({"lang": pa.array([t.column("lang")[0].as_py()] * len(first), pa.string()), "a": names.take(pa.array(first)), "b": names.take(pa.array(second)), "more": pa.array(sums)})


def _pairs(rated: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for every two sources of a language; both
    counts are single numbers that set the size of the units."""
    rows = rated.count()
    most = groups.groupBy("lang").count().agg(F.max("count")).head()[0] or 0
    blocks, parts = max(1, -(-most // SOURCE_BLOCK)), max(1, -(-rows // TERM_ROWS))
    own = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    named = groups.where("v > 0").select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "p0", every.alias("part"))
    units = (
        rated.select("lang", "source", "term", "p", "p0", F.pmod(F.xxhash64("term"), F.lit(parts).cast("long")).alias("part"))
        .union(named)
        .select("*", own.alias("block"), other.alias("other"))
        .select("*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        .groupBy("lang", "part", "low", "high")
        .applyInArrow(_unit, _UNIT)
        .groupBy("lang", "a", "b")
        .agg(F.sum("more").alias("more"))
    )
    g = groups.select("lang", "source", "v", "p0", own.alias("block"), other.alias("other"))
    left = g.select("lang", F.col("block").alias("one"), F.col("other").alias("two"), "source", "v", "p0")
    right = g.select("lang", F.col("other").alias("one"), F.col("block").alias("two"), F.col("source").alias("item"), F.col("p0").alias("item_p0"))
    both = left.join(right, ["lang", "one", "two"]).where("source <> item").withColumns({"a": F.least("source", "item"), "b": F.greatest("source", "item")})
    alike = F.when(F.col("v") > 0, F.col("v") * _differ(F.col("p0"), F.col("item_p0"))).otherwise(F.lit(0))
    return both.join(units, ["lang", "a", "b"], "left").select("lang", "source", "item", (alike + F.coalesce("more", F.lit(0))).cast("long").alias("value"))


def _top_terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value, rank of the terms that a group uses more than
    its language, by count cells."""
    cells = kept.groupBy("lang", "source", "n", "all_n").agg(F.count("*").alias("terms"))
    p, q = _weight(F.col("n"), F.col("total"), F.col("v")), _weight(F.col("all_n"), F.col("all_total"), F.col("v"))
    cells = (
        _dealt(cells, "n", "all_n")
        .join(_repeated(groups.select("lang", "source", "v", "total", "all_total")), ["lang", "source", "salt"])
        .withColumns({"p": p, "q": q})
        .where("p > q")
        .select("lang", "source", "n", "all_n", "terms", _differ(F.col("p"), F.col("q")).alias("value"))
    )
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = (
        cells.groupBy("lang", "source", "value")
        .agg(F.sum("terms").alias("terms"))
        .withColumn("place", F.row_number().over(w))
        .where(F.col("place") <= top)
        .withColumn("above", F.sum("terms").over(w.rowsBetween(Window.unboundedPreceding, -1)))
        .where(F.coalesce("above", F.lit(0)) < top)
    )
    best = cells.join(values.select("lang", "source", "value"), ["lang", "source", "value"]).select("lang", "source", "n", "all_n", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return (
        _dealt(kept, "term")
        .join(_repeated(best), ["lang", "source", "n", "all_n", "salt"])
        .select("lang", "source", F.col("term").alias("item"), "value")
        .withColumn("rank", rank)
        .where(F.col("rank") <= top)
    )


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: part 'pair' ranks all other
    sources of the language, part 'term' the ``top`` terms of the group."""
    counts = stored(term_counts(docs, text, lang, source), "term_counts")
    used = counts.where("term <> ''")
    words = used.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n")).where(F.col("docs") >= min_docs)
    words = stored(words.select("lang", "term", "all_n"), "kept_terms")
    kept = stored(used.select("lang", "source", "term", "n").join(words, ["lang", "term"]), "kept_counts")
    langs = words.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_n").alias("all_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    groups = (
        counts.where("term = ''")
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", zero("total"), zero("v"), zero("all_total"))
    )
    groups = stored(groups.withColumn("p0", _weight(F.lit(0), F.col("total"), F.col("v"))), "groups")
    rated = (
        _dealt(kept, "term")
        .join(_repeated(groups.select("lang", "source", "v", "total", "p0")), ["lang", "source", "salt"])
        .select("lang", "source", "term", _weight(F.col("n"), F.col("total"), F.col("v")).alias("p"), "p0")
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = _pairs(rated, groups).withColumn("rank", rank)
    out = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return out(pairs, "pair").union(out(_top_terms(kept, groups, top), "term"))
