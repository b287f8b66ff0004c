"""Line dedup by site-relative frequency.

Pages are grouped by host. A line's frequency at its host is the number of the
host's pages that contain it divided by the host's page total; lines that
exceed ``max_ratio`` on at least ``min_pages`` pages are boilerplate of that
host and are dropped from all its pages.

Lines are compared trimmed (space, tab, carriage return); blank lines are kept
and never counted. A page counts once for a line that it repeats.

Only 64-bit line hashes travel, counted before the shuffle, so a host or a
line with a third of all rows is one partial count per task. The boilerplate
lines, fewer per host than (mean distinct lines of a page) / ``max_ratio``, are
stored and counted: up to ``broadcast_bytes`` of them in all are broadcast by
host and the pages stay where they are. With more, they meet the pages' lines
in an equi-join on (host, line), and what each page loses meets the pages on a
hash of host and text; both joins deal their frequent side over ``salts`` parts,
so exact copies don't meet in one task. Both ways give the same rows.

Defined results: a null host is a host of its own; a null text stays null
with no lines; an empty text has one blank line, a text whose lines all go
becomes empty. Repeated rows are pages of their own and get equal results.
Input columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import column, stored, without

RESULTS = ("n_lines", "n_dropped")
_BLANK = " \t\r"
#: bytes of boilerplate lines (16 each) and their hosts that may be broadcast
BROADCAST_BYTES = 16 << 20


def _lines(text):
    return F.split(text, "\n", -1)


def _key(line):
    """Hash of a trimmed line; null for a blank one."""
    t = F.trim(line, F.lit(_BLANK))
    return F.when(t != "", F.xxhash64(t))


def boilerplate_lines(pages: DataFrame, host: str, text: str, max_ratio: float = 0.05, min_pages: int = 5) -> DataFrame:
    """(host, line) of the lines that exceed the ratio; line: its hash."""
    p = pages.select(column(pages, host).alias("host"), F.array_distinct(F.transform(_lines(column(pages, text)), _key)).alias("keys"))
    counts = p.select("host", F.explode("keys").alias("line")).where("line IS NOT NULL").groupBy("host", "line").agg(F.count("*").alias("n"))
    totals = p.groupBy(F.col("host").alias("total_host")).agg(F.count("*").alias("total"))
    return (
        counts.where(F.col("n") >= min_pages)
        .join(totals, F.col("host").eqNullSafe(F.col("total_host")))
        .where(F.col("n") > max_ratio * F.col("total"))
        .select("host", "line")
    )


def _dealt(pages: DataFrame, common: DataFrame, host: str, text: str, salts: int) -> DataFrame:
    """(row, t, drops) of ``pages`` by joins on line and page."""
    each = F.explode(F.array(*map(F.lit, range(salts))))
    common = common.select(F.col("host").alias("b_host"), F.col("line").alias("b_line"), each.alias("b_salt"))
    h, t = column(pages, host), column(pages, text)
    # rows that agree in host and text drop the same lines, so these two name a row
    k1, k2 = F.xxhash64(F.lit(1), h, t).alias("k1"), F.xxhash64(F.lit(2), t, h).alias("k2")
    lines = (
        pages.where(t.isNotNull())
        .select(h.alias("host"), k1, k2, F.explode(F.array_distinct(F.transform(_lines(t), _key))).alias("line"))
        .where("line IS NOT NULL")
        .withColumn("salt", F.pmod(F.col("k1"), F.lit(salts)).cast("int"))
    )
    hit = F.col("host").eqNullSafe(F.col("b_host")) & (F.col("line") == F.col("b_line")) & (F.col("salt") == F.col("b_salt"))
    drops = lines.join(common, hit).groupBy("k1", "k2").agg(F.collect_set("line").alias("drops")).withColumn("part", each)
    part = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int").alias("part")
    rows = pages.select(F.struct(*[column(pages, c) for c in pages.columns]).alias("row"), k1, k2, t.alias("t"), part)
    return rows.join(drops, ["k1", "k2", "part"], "left")


def _by_host(pages: DataFrame, common: DataFrame, host: str, text: str) -> DataFrame:
    """As ``_dealt``, by a broadcast of each host's lines."""
    of_host = F.broadcast(common.groupBy(F.col("host").alias("b_host")).agg(F.collect_set("line").alias("drops")))
    rows = pages.select(F.struct(*[column(pages, c) for c in pages.columns]).alias("row"), column(pages, host).alias("host"), column(pages, text).alias("t"))
    return rows.join(of_host, F.col("host").eqNullSafe(F.col("b_host")), "left")


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", max_ratio: float = 0.05, min_pages: int = 5, salts: int = 16, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` with boilerplate lines taken out of ``text``, and n_lines and
    n_dropped (both count blank lines as lines)."""
    pages = without(pages, *RESULTS)
    common = stored(boilerplate_lines(pages, host, text, max_ratio, min_pages), "boilerplate")
    few = (common.agg(F.sum(16 + F.coalesce(F.octet_length("host"), F.lit(0)))).first()[0] or 0) <= broadcast_bytes
    joined = _by_host(pages, common, host, text) if few else _dealt(pages, common, host, text, salts)
    kept = F.filter(_lines(F.col("t")), lambda x: ~F.coalesce(F.array_contains(F.col("drops"), F.coalesce(_key(x), F.lit(0).cast("long"))) & _key(x).isNotNull(), F.lit(False)))
    done = joined.withColumn("kept", F.when(F.col("drops").isNull(), _lines(F.col("t"))).otherwise(kept))
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    count = F.when(F.col("t").isNull(), F.lit(0).cast("long")).otherwise(size(_lines(F.col("t"))))
    return done.select(
        *[(F.when(F.col("drops").isNull(), F.col("t")).otherwise(F.array_join("kept", "\n")) if c == text else F.col("row").getField(c)).alias(c) for c in pages.columns],
        count.alias("n_lines"),
        F.when(F.col("t").isNull(), F.lit(0).cast("long")).otherwise(count - size(F.col("kept"))).alias("n_dropped"),
    )
