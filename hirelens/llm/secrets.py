"""Secret scan by character Markov models, in DataFrame expressions alone.

Two first-order Markov models over characters, one of random strings and one
of ordinary identifiers, give each run of token characters a log-likelihood
ratio; runs with a mean ratio above ``threshold`` per character are reported
as kind ``markov``, next to three patterns (``assign``, ``access``, ``hex``)
whose spans stay as they are. Where a pattern's span covers part of a run, what
is left on either side of it is judged as a run of its own.

The models are trained here: random strings are what the patterns find (the
values of assignments, keys, hex digests), identifiers are all the other runs
of letters, digits and marks, both from a bounded sample of labelled rows (the
``sample`` distinct texts with the smallest hashes; a documented limit of the
training alone). A pair's share after its first character backs off to the
second one's overall share, which is smoothed by one.

Positions are code points, ends exclusive. Each pattern is found leftmost and
without overlaps over the whole text, by an anchored search that yields gap
and match in turn, so a text is read once per kind, whatever its length.

Defined results: a null or empty text has no spans; repeated rows get equal
results; with no labelled rows the models are equal and nothing is added.
Input columns named like a result column are replaced.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import column, without

RESULTS = ("secret_spans",)
#: kinds in the order in which equal starts are listed
KINDS = ("assign", "access", "hex", "markov")

# The patterns of the three base kinds.
_NAMES = ("password", "passwd", "secret", "token", "api_?key")
_VALUE = "[A-Za-z0-9+/_.=-]+"


def _any_case(name: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)


ASSIGN = f"({'|'.join(map(_any_case, _NAMES))})[\"']?\\x20*[:=]\\x20*[\"']?({_VALUE})"
#: the runs are maximal, so a least length finds the matches that pass it
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
#: what the models judge
RUN = "[A-Za-z0-9+/_=-]{20,}"
#: character classes of the models: each letter and digit, and the marks as one
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_"
_MARKS = "+/=-"
_N = len(ALPHABET)
#: weight of a character's overall share in the shares after one character
_BACK_OFF = 20


def _found(text, pattern: str):
    """The matches of a pattern, leftmost first without overlaps:
    array of (start, end, match)."""
    parts = F.regexp_extract_all(text, F.lit(f"\\G[\\s\\S]*?(?:{pattern})"), F.lit(0))  # each: what lies before a match, and the match
    cut = F.transform(parts, lambda s: F.struct(F.length(s).alias("n"), F.regexp_extract(s, f"(?:{pattern})$", 0).alias("match")))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    step = F.aggregate(
        cut,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, s: F.struct(
            (acc["at"] + s["n"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + s["n"] - F.length(s["match"])).alias("start"), (acc["at"] + s["n"]).alias("end"), s["match"].alias("match")))).alias("out"),
        ),
    )
    return step["out"]


def _base(text) -> list:
    """The matches of the three base kinds."""
    assign = F.filter(_found(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 2)) >= 6)
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return [assign, F.when(text.contains("AKIA"), _found(text, ACCESS)).otherwise(none), _found(text, HEX)]


def _spans(found, kind: int):
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def train_markov(docs: DataFrame, text: str = "text", sample: int = 4000) -> list[float]:
    """Log-likelihood ratios (random against identifier) of all pairs of
    character classes, row by row: a fixed number of values."""
    hashed = docs.select(F.xxhash64(column(docs, text)).alias("h"), column(docs, text).alias("text")).where("text IS NOT NULL")
    # the hashes alone decide, each once, so copies neither crowd the sample nor thin it out
    last = hashed.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).head()[0]
    labelled = hashed.where(F.col("h") <= F.lit(last if last is not None else 0)).dropDuplicates(["h"])
    assign, access, hexes = _base(F.col("text"))
    secret = F.concat(F.transform(assign, lambda m: F.regexp_extract(m["match"], ASSIGN, 2)), F.transform(access, lambda m: m["match"]), F.transform(hexes, lambda m: m["match"]))
    plain = F.regexp_replace(F.regexp_replace(F.col("text"), ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    ordinary = F.regexp_extract_all(plain, F.lit("[A-Za-z0-9+/_=-]{6,}"), F.lit(0))
    rows = labelled.select(F.explode(F.concat(F.transform(secret, lambda s: F.struct(F.lit(1).alias("random"), s.alias("w"))), F.transform(ordinary, lambda s: F.struct(F.lit(0).alias("random"), s.alias("w"))))).alias("x")).select("x.random", "x.w")
    marked = rows.select("random", F.regexp_replace(F.translate("w", _MARKS, "_" * len(_MARKS)), "[^A-Za-z0-9_]", "").alias("w"))
    pairs = marked.where(F.length("w") > 1).select("random", F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring(F.col("w"), i, F.lit(2)))).alias("pair"))
    counts = {(r["random"], r["pair"]): r["count"] for r in pairs.groupBy("random", "pair").count().collect()}  # at most 2 * 63 * 63 rows
    if not counts:
        return [0.0] * (_N * _N)
    # a character's share in a kind, add-one; a pair's share backs off to it
    share = []
    for kind in (0, 1):
        seen = {b: 1 + sum(counts.get((kind, a + b), 0) for a in ALPHABET) for b in ALPHABET}
        share.append({b: n / sum(seen.values()) for b, n in seen.items()})
    out = []
    for a in ALPHABET:
        totals = [sum(counts.get((kind, a + b), 0) for b in ALPHABET) for kind in (0, 1)]
        for b in ALPHABET:
            p = [(counts.get((kind, a + b), 0) + _BACK_OFF * share[kind][b]) / (totals[kind] + _BACK_OFF) for kind in (0, 1)]
            out.append(round(math.log(p[1] / p[0]), 4))
    return out


def _mean_ratio(run, table):
    plain = F.translate(run, _MARKS, "_" * len(_MARKS))
    at = lambda i: F.instr(F.lit(ALPHABET), F.substring(plain, i, F.lit(1))) - 1
    total = F.aggregate(F.sequence(F.lit(1), F.length(plain) - 1), F.lit(0.0), lambda acc, i: acc + F.get(table, at(i) * _N + at(i + 1)))
    return total / (F.length(plain) - 1)


def secret_spans(docs: DataFrame, model: list[float], text: str = "text", threshold: float = 0.5, min_distinct: int = 8) -> DataFrame:
    """``docs`` with ``secret_spans``: array of (start, kind, end) by start,
    then kind as numbered in ``KINDS``. A run needs ``min_distinct`` different
    characters to be random."""
    docs = without(docs, *RESULTS)
    t = F.coalesce(column(docs, text), F.lit(""))
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    assign, access, hexes = _base(t)
    base = F.concat(_spans(assign, 0), _spans(access, 1), _spans(hexes, 2))
    found = docs.select("*", base.alias(RESULTS[0]))
    # base spans are blanked out, so what is left of a run beside one is a run of its own
    rest = F.when(F.size(RESULTS[0]) > 0, _replaced(t, F.array_sort(RESULTS[0]), lambda n: F.repeat(F.lit(" "), n))).otherwise(t)
    runs = F.filter(_found(rest, RUN), lambda m: (F.size(F.array_distinct(F.split(m["match"], ""))) >= min_distinct) & (_mean_ratio(m["match"], table) > threshold))
    return found.withColumn(RESULTS[0], F.array_sort(F.concat(RESULTS[0], _spans(runs, 3))))


def _replaced(text, spans, by):
    """``text`` with its spans (by start) replaced by ``by(length)``, what they
    overlap once."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), by(s["end"] - s["start"])).alias("out")),
        )
        .when(s["end"] > acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], by(s["end"] - acc["at"])).alias("out")))
        .otherwise(acc),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )


def listed(spans):
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` of ``secret_spans`` with every span in ``text`` replaced by
    ``mark`` (overlapping spans by one), without the spans column."""
    t = column(docs, text)
    done = F.aggregate(
        F.col(RESULTS[0]),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))),
    )
    return docs.withColumn(text, F.when(F.size(RESULTS[0]) > 0, done).otherwise(t)).drop(*RESULTS)
