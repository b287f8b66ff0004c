"""Quality rules by tokeniser fertility.

A public vocabulary with byte fallback encodes every whole text word by word.
Three measures follow: characters per token, the share of byte-fallback
tokens, and the entropy of the tokens (in bits, as a share of the most that so
many tokens can have). Per language, the whole corpus gives a rejection band
for each measure: quartiles counted exactly on a fixed grid, widened by
``spread`` interquartile ranges below and above. Characters per token scatter
less in longer texts and have a band per doubling of the token count; the
entropy falls with length and has one per half doubling, or that fall would
widen it. Both are held tighter below than above, for junk splits into more and
fewer different tokens than prose. In the counts a group of copies weighs as
one text (texts of a language with the same smallest hash of eight words in a
row are one; near copies fall into fewer groups, not into one), and a class's
interquartile range is taken as no less than what chance makes of texts of its
length. A document outside a band is rejected, as is one that fails the base
rules (``base_failed``).

A class with few documents is held against the nearest size's band, a
language with few against the corpus's, so a text is judged by like measure in
a small table and in a large one.

Defined results: a null or empty text has no words, hence fails the base
rules; a null language is a language of its own; texts with fewer than
``min_tokens`` tokens are held against no band. Repeated rows get equal results.
Input columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hirelens.llm import memo
from hirelens.llm.common import BYTE_VALUE, SPACE, buffers, column, mix, per_text, powers, runs, segment_hash, slices, stored, vocabulary_path, without, word_bounds, WORD_VALUE

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: the steps of the grid on which each measure's quartiles are counted
GRID = {"chars_per_token": 1000, "byte_share": 2000, "token_entropy": 2000}
#: interquartile ranges by which each band reaches below and above the quartiles
SPREAD = {"chars_per_token": (2.25, 3.0), "byte_share": (6.0, 6.0), "token_entropy": (1.25, 4.0)}
#: the least interquartile range: characters per token by the root of the
#: token count, as a token's length has a deviation of about one character
LEAST = {"chars_per_token": 1.0, "byte_share": 0.001, "token_entropy": 0.01}
RESULTS = (*BASE, "base_failed", "n_tokens", *GRID, "kept")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_WINDOW = 8
_GROUP = "fertility_group_"


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys)
    k = keys[order]
    same = k[1:] == k[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The base columns of texts that lie one after another in ``data``."""
    n = len(off) - 1
    space = SPACE[data]
    starts, doc = word_bounds(data, off)
    hashes = segment_hash(data, starts, WORD_VALUE)
    n_words = np.bincount(doc, minlength=n)
    out = {
        "n_words": n_words,
        "word_chars": per_text(~space & ((data & 0xC0) != 0x80), off),
        "n_symbols": per_text(_SYMBOL[data], off),
    }
    # lines: segments that begin at a text's start or after a line feed
    begins = np.union1d(off[:-1][off[1:] > off[:-1]], np.flatnonzero(data == 10) + 1)
    begins = begins[begins < len(data)]
    values = BYTE_VALUE.copy()
    values[10] = 0  # the line feed that ends a segment is not part of the line
    line_doc = np.searchsorted(off, begins, "right") - 1
    has_word = np.add.reduceat(~space, begins) > 0 if len(begins) else np.empty(0, bool)
    keys = mix(segment_hash(data, begins, values) ^ (line_doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))[has_word]
    first = np.zeros(len(keys), bool)
    first[np.unique(keys, return_index=True)[1]] = True
    out["n_dup_lines"] = np.bincount(line_doc[has_word], weights=~first, minlength=n).astype(np.int64)
    # windows of eight words, within one text each
    covered = np.zeros(len(hashes), np.int64)
    # a text's smallest hash of a window; of its words if it has no window
    whole = np.zeros(n, np.uint64)
    np.add.at(whole, doc, hashes * powers(int(n_words.max(initial=0)) + 1)[runs(n_words)])
    whole = mix(whole)
    if len(hashes) >= _WINDOW:
        m = len(hashes) - _WINDOW + 1
        key = np.zeros(m, np.uint64)
        p = powers(_WINDOW + 1)
        for j in range(_WINDOW):
            key += hashes[j : j + m] * p[j + 1]
        inside = np.flatnonzero(doc[:m] == doc[_WINDOW - 1 :])
        if len(inside):
            begin = np.flatnonzero(np.diff(doc[inside], prepend=-1))
            whole[doc[inside][begin]] = np.minimum.reduceat(mix(key[inside]), begin)
        key = mix(key[inside] ^ mix(doc[inside].astype(np.uint64) + np.uint64(1)))
        at = inside[_repeats(key)]
        edge = np.zeros(len(hashes) + 1, np.int64)
        edge[at] += 1
        edge[at + _WINDOW] -= 1
        covered = np.cumsum(edge)[:-1] > 0
    out["n_repeat_words"] = np.bincount(doc, weights=covered, minlength=n).astype(np.int64)
    out[_GROUP] = whole.view(np.int64)
    return out


def _entropy(ids: list[bytes], is_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, byte tokens and entropy as a share of the most possible."""
    lens = np.array([len(x) // 2 for x in ids])
    flat = np.frombuffer(b"".join(ids), "<u2")
    off = np.concatenate([[0], np.cumsum(lens)])
    n_byte = per_text(is_byte[flat], off)
    key = np.repeat(np.arange(len(lens), dtype=np.int64) << 16, lens) | flat
    found, count = np.unique(key, return_counts=True)
    at = found >> 16
    share = count / lens[at]
    bits = np.bincount(at, weights=-share * np.log2(share), minlength=len(lens))
    most = np.log2(np.clip(np.minimum(lens, len(is_byte)), 2, None))
    return lens, n_byte, bits / most


_FEATURES = T.StructType(
    [T.StructField(c, T.LongType()) for c in BASE]
    + [T.StructField("n_tokens", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in GRID]
    + [T.StructField(_GROUP, T.LongType())]
)


def fertility_features(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """``docs`` with the base counts, the three measures and the group of
    copies; one pass."""
    model = model or vocabulary_path("piece_bpe_32k.model")
    docs = without(docs, *RESULTS, _GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, is_byte = memo.pieces(model)
        for whole in batches:
            for batch in slices(whole, text):
                array = batch.column(batch.schema.get_field_index(text))
                data, off = buffers(array)
                out = base_counts(data, off)
                raw = data.tobytes()
                n, n_byte, entropy = _entropy(encoder.ids([raw[a:b] for a, b in zip(off[:-1], off[1:])]), is_byte)
                some = np.maximum(n, 1)
                out |= {"n_tokens": n, "chars_per_token": out["word_chars"] / some, "byte_share": n_byte / some, "token_entropy": entropy}
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(out[f.name]) for f in _FEATURES)], names=[*batch.schema.names, *_FEATURES.names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *_FEATURES.fields]))


#: measures whose class has a size: the greatest one (bits of a token count, or of its square)
SIZES = {"chars_per_token": 32, "byte_share": 0, "token_entropy": 64}


def _classes() -> dict:
    """The class in which each measure is compared: all of a language, its
    texts of one doubling of the token count, or of one half doubling."""
    n = F.least(F.col("n_tokens"), F.lit(2**31 - 1))
    sizes = {"chars_per_token": F.length(F.bin(n)), "byte_share": F.lit(0), "token_entropy": F.length(F.bin(n * n))}
    return {m: F.concat(F.lit(f"{m} "), F.least(sizes[m], F.lit(SIZES[m])).cast("string")) for m in GRID}


def fertility_bands(features: DataFrame, lang: str = "lang", spread: dict[str, tuple[float, float]] = SPREAD, min_tokens: int = 40, min_documents: int = 30) -> DataFrame:
    """(language, bands by class) over all documents: quartiles of each
    measure on its grid, over one text of each group of copies (any, by hash),
    widened by ``spread`` (below, above) interquartile ranges of at least
    ``LEAST``, and by more where a class's documents make fewer than
    ``min_documents`` groups. Every language has a band for every class: a
    class with fewer than ``min_documents`` documents takes the nearest size's,
    widened by the distance, then the whole corpus's, then its own. What is
    counted are at most some thousand grid points per class."""
    points = F.array(*[F.struct(c.alias("class"), F.floor(F.col(m) * GRID[m]).alias("point")) for m, c in _classes().items()])
    measures = ["n_tokens", *GRID]
    one = (
        features.where(F.col("n_tokens") >= min_tokens)
        .groupBy(column(features, lang).cast("string").alias("band_lang"), _GROUP)
        .agg(F.min(F.struct(F.xxhash64(*measures), *measures)).alias("one"), F.count("*").alias("documents"))
    )
    # a language's own points, and the same points for the corpus; its name in a struct, so that none is like a null one
    of = lambda name, all_: F.named_struct(F.lit("name"), name, F.lit("all"), F.lit(all_))
    each = F.explode(F.array(of(F.col("band_lang"), False), of(F.lit(None).cast("string"), True)))
    counts = (
        one.select("band_lang", "documents", "one.*")
        .select("band_lang", "documents", F.explode(points).alias("p"))
        .select(each.alias("of"), "documents", "p")
        .groupBy("of", "p.class", "p.point")
        .agg(F.count("*").alias("count"), F.sum("documents").alias("documents"))
    )
    w = Window.partitionBy("of", "class")
    run = counts.withColumn("upto", F.sum("count").over(w.orderBy("point"))).withColumn("all", F.sum("count").over(w))
    quarter = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("point")))
    measure, size = F.split_part("class", F.lit(" "), F.lit(1)), F.split_part("class", F.lit(" "), F.lit(2)).cast("int")
    least = {m: F.lit(LEAST[m] * GRID[m]) for m in GRID}
    least["chars_per_token"] /= F.pow(F.lit(2.0), size / 2)
    floor = F.lit(None).cast("double")
    for m, c in least.items():
        floor = F.when(measure == m, c).otherwise(floor)
    steps = F.greatest(F.col("q3") - F.col("q1"), floor) * F.greatest(F.lit(1.0), min_documents / F.col("all"))
    known = (
        run.groupBy("of", "class")
        .agg(quarter(0.25).alias("q1"), quarter(0.75).alias("q3"), F.first("all").alias("all"), F.sum("documents").alias("documents"))
        .select("of", measure.alias("measure"), size.alias("size"), F.struct("q1", "q3", steps.alias("steps"), size.alias("size")).alias("band"), (F.col("documents") >= min_documents).alias("enough"))
    )
    grid = F.explode(F.array(*[F.named_struct(F.lit("measure"), F.lit(m), F.lit("size"), F.lit(i)) for m, top in SIZES.items() for i in range(top + 1)]))
    every = known.select("of").distinct().select("of", grid.alias("g")).select("of", "g.*").join(known, ["of", "measure", "size"], "left")
    sized = Window.partitionBy("of", "measure").orderBy("size")
    firm = F.when(F.col("enough"), F.col("band"))
    every = every.withColumns(
        {
            "below": F.last(firm, ignorenulls=True).over(sized.rowsBetween(Window.unboundedPreceding, 0)),
            "above": F.first(firm, ignorenulls=True).over(sized.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    far = lambda c: F.abs(F.col("size") - F.col(f"{c}.size"))
    near = F.when(F.col("above").isNull() | (far("below") <= far("above")), F.col("below")).otherwise(F.col("above"))
    every = every.select("of", "measure", "size", "band", near.alias("near"))
    corpus = every.where("of.all").select("measure", "size", F.col("near").alias("corpus"), F.col("band").alias("corpus_own"))
    each = every.where("NOT of.all").join(corpus, ["measure", "size"])
    each = each.select("of.name", "measure", "size", F.coalesce("near", "corpus", "band", "corpus_own").alias("band")).where("band IS NOT NULL")
    wide = F.col("band.steps") * (1 + F.abs(F.col("size") - F.col("band.size")))
    band = F.lit(None)
    for m, (below, above) in spread.items():
        band = F.when(F.col("measure") == m, F.struct((F.col("band.q1") - wide * below).alias("low"), (F.col("band.q3") + 1 + wide * above).alias("high"))).otherwise(band)
    name = F.concat_ws(" ", "measure", F.col("size").cast("string"))
    return each.groupBy(F.col("name").alias("band_lang")).agg(F.map_from_entries(F.collect_list(F.struct(name.alias("class"), band.alias("band")))).alias("bands"))


#: languages whose bands are broadcast (about 4 KB each); with more, the rows are dealt out over salts
BROADCAST_LANGUAGES, SALTS = 2000, 64


def _with_bands(rows: DataFrame, bands: DataFrame) -> DataFrame:
    """``rows`` (m_lang) with the bands of their language. The rows carry the
    texts, so they stay where they are as long as the bands are small."""
    if bands.count() <= BROADCAST_LANGUAGES:
        return rows.join(F.broadcast(bands), F.col("m_lang").eqNullSafe(F.col("band_lang")), "left")
    salted = bands.withColumn("band_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    dealt = rows.withColumn("m_salt", F.pmod(F.xxhash64("n_tokens", "n_words", "word_chars", _GROUP), F.lit(SALTS)).cast("int"))
    on = F.col("m_lang").eqNullSafe(F.col("band_lang")) & (F.col("m_salt") == F.col("band_salt"))
    return dealt.join(salted, on, "left")


def fertility_filter(docs: DataFrame, text: str = "text", lang: str = "lang", model: str | None = None, spread: dict[str, tuple[float, float]] = SPREAD, min_tokens: int = 40, min_documents: int = 30, only: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``only``) with all of ``RESULTS``."""
    measured = fertility_features(docs, text, model)
    if only is not None:
        measured = measured.select(*dict.fromkeys([*only, lang]), *_FEATURES.names)
    measured = stored(measured, "fertility")
    bands = stored(fertility_bands(measured, lang, spread, min_tokens, min_documents), "fertility_bands")
    keep = [c for c in measured.columns if c not in _FEATURES.names and (only is None or c in only)]
    row = measured.select(F.struct(*[column(measured, c) for c in keep]).alias("row"), column(measured, lang).cast("string").alias("m_lang"), *_FEATURES.names)
    joined = _with_bands(row, bands)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    inside = F.lit(True)
    for m, name in _classes().items():
        band = F.try_element_at(F.col("bands"), name)
        inside = inside & F.coalesce((F.col(m) * GRID[m]).between(band["low"], band["high"]), F.lit(True))
    return joined.select(
        *[F.col("row").getField(c).alias(c) for c in keep],
        *BASE,
        failed.alias("base_failed"),
        "n_tokens",
        *GRID,
        (~failed & ((F.col("n_tokens") < min_tokens) | inside)).alias("kept"),
    )
