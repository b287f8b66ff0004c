"""URL filter by a tree of path templates.

Per host, the paths form a tree. Going down it, a segment below a node stays
literal if its count exceeds the node's by more than chance moves the node's
own count, n >= 1 + sqrt(total); the others become wildcards that keep a file
extension, and the tree goes on below both. So a node with 100 paths needs 11
of them for a literal, one with a million 1,001. Segments beyond ``depth``
form one wildcard: the tree's height is the operator's only limit.

A node's share of bad labels is smoothed (``weight`` pseudo-labels) towards a
prior, first in one tree of prefixes over all hosts: its prior is the parent's
share, at the top ``base``, which is not estimated, since the labels' mix says
nothing of what no label reaches. Siblings of a host are then compared with all
of their parent's branches pooled. A branch takes the common name
``~`` if its distribution of remaining paths (total variation) and its share
of bad labels, shrunk towards its prefix's share over all hosts, both lie near
the pool's; a branch that no label reaches is as bad as its prefix elsewhere.

In the host's tree of merged names a node's prior is the mean of its parent's
share and of its paths' shares over all hosts, so what labels say of a
template reaches hosts without any. Templates whose share exceeds ``max_bad``
are rejected.

Labels are the verdicts of the rules on the URLs that a rule fits. Pages are
counted by distinct path first and only those counts go through the tree, in
equi-joins dealt over ``SALTS`` parts of a node. Back at the pages, a path
with over a thousandth of them (there are fewer than 1,000, so their hashes
are broadcast) is dealt over ``HOT_SALTS`` parts.

Defined results: a URL that is null or has no ``://`` has an empty host and
path; an empty path is a template of its own; repeated rows count each and get
equal results; without labels nothing is rejected. Input columns named like a
result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import column, stored, without

RESULTS = ("host", "path", "rule", "template", "badness", "verdict")
#: Verdict, host and path of each rule.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: into so many parts the paths of a node are dealt for joins
SALTS = 16
#: a path with over 1 / HOT_PATHS of all pages is dealt into HOT_SALTS parts
HOT_PATHS, HOT_SALTS = 1000, 64
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = r"^[\s\S]*?://([^/?#]*)([^?#]*)"


def host_and_path(url):
    host = F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _UPPER.lower())
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matching_rule(host, path, rules=RULES):
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _segments(path, depth: int):
    """Up to ``depth`` segments; what lies deeper is one segment."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", -1)
    deep = F.concat(F.slice(parts, 1, depth), F.array(F.lit("**")))
    return F.when(path == "", F.array().cast("array<string>")).when(F.size(parts) > depth, deep).otherwise(parts)


def _each_salt(salts: int = SALTS):
    return F.explode(F.array(*[F.lit(k) for k in range(salts)]))


def _salt(*of):
    return F.pmod(F.xxhash64(*of), F.lit(SALTS)).cast("int")


def _wild(segment):
    """The wildcard of a segment: an empty one stays, an extension is kept."""
    ext = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    return F.when((segment == "") | (segment == "**"), segment).otherwise(F.concat(F.lit("*"), ext))


def path_templates(paths: DataFrame, depth: int) -> DataFrame:
    """``paths`` (host, path, n, ...), one row per host and path, with
    ``template``: array of segments. Each level of the tree is stored."""
    rest = [c for c in paths.columns if c != "host"]
    segments = _segments(F.col("path"), depth)
    rows = stored(paths.withColumns({"segments": segments, "template": F.array().cast("array<string>"), "salt": _salt("path")}), "paths")
    height = rows.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(height):
        here = F.get("segments", F.lit(level))
        child = rows.where(F.size("segments") > level).groupBy("host", "template", here.alias("segment")).agg(F.sum("n").alias("n"))
        # a node has as many rows as different segments: they are dealt out too
        node = child.groupBy("host", "template").agg(F.sum("n").alias("total")).withColumn("part", _each_salt())
        twice = child.where("n >= 2").withColumn("part", _salt("segment"))
        often = twice.join(node, ["host", "template", "part"]).where(F.col("n") >= 1 + F.sqrt("total"))
        literal = often.select(F.col("host").alias("l_host"), F.col("template").alias("l_template"), F.col("segment").alias("literal"), _each_salt().alias("l_salt"))
        meets = (F.col("host") == F.col("l_host")) & (F.col("template") == F.col("l_template")) & (here == F.col("literal")) & (F.col("salt") == F.col("l_salt"))
        name = F.coalesce("literal", _wild(here))
        longer = F.when(here.isNull(), F.col("template")).otherwise(F.concat("template", F.array(name)))
        rows = stored(rows.join(literal, meets, "left").select("host", *rest, "segments", longer.alias("template"), "salt"), "paths")
    return rows.select("host", *rest, "template")


def _join(a):
    return F.array_join(a, "/")


def corpus_shares(templates: DataFrame, weight: float, base: float) -> DataFrame:
    """(template, shares): the smoothed share of bad labels of the template's
    prefixes over all hosts; the first, of the empty prefix, is ``base``."""
    t = templates.groupBy("template").agg(*[F.sum(c).alias(c) for c in ("good", "bad")])
    prefixes = F.transform("template", lambda _, i: F.slice("template", F.lit(1), i + 1))
    nodes = t.withColumn("salt", _salt("template")).select("template", "salt", "good", "bad", F.posexplode(prefixes).alias("level", "prefix"))
    counts = nodes.groupBy(F.col("prefix").alias("c_prefix")).agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad")).withColumn("c_salt", _each_salt())
    met = nodes.join(counts, (F.col("prefix") == F.col("c_prefix")) & (F.col("salt") == F.col("c_salt")))
    path = met.groupBy("template").agg(F.array_sort(F.collect_list(F.struct("level", "n_good", "n_bad"))).alias("path"))
    grow = lambda a, x: F.concat(a, F.array((x["n_bad"] + weight * F.element_at(a, -1)) / (x["n_good"] + x["n_bad"] + weight)))
    grown = path.select(F.col("template").alias("g_template"), F.aggregate("path", F.array(F.lit(base)), grow).alias("shares"))
    # the empty template has no node
    return t.select("template").join(grown, F.col("template") == F.col("g_template"), "left").select("template", F.coalesce("shares", F.array(F.lit(base))).alias("shares"))


def with_shares(templates: DataFrame, weight: float, base: float) -> DataFrame:
    """``templates`` (host, template, ...) with ``shares``."""
    shares = corpus_shares(templates, weight, base).select(F.col("template").alias("s_template"), "shares", _each_salt().alias("s_salt"))
    t = templates.withColumn("salt", _salt("host"))
    return t.join(shares, (F.col("template") == F.col("s_template")) & (F.col("salt") == F.col("s_salt"))).drop("s_template", "s_salt", "salt")


def merged_branches(templates: DataFrame, weight: float, max_distance: float = 0.25, max_gap: float = 0.2) -> DataFrame:
    """``templates`` (host, template, n, good, bad, shares) with ``merged``: the
    template in which branches like their siblings' pool share one name."""
    at = lambda i: F.slice("template", 1, i)
    prefixes = F.transform(
        "template",
        lambda s, i: F.struct(
            (i + 1).alias("level"),
            at(i).alias("parent"),
            s.alias("segment"),
            F.slice("template", i + 2, F.size("template")).alias("rest"),
            F.get("shares", i + 1).alias("share"),
        ),
    )
    nodes = templates.select("host", "template", "n", "good", "bad", F.explode(prefixes).alias("p")).select("host", "template", "n", "good", "bad", "p.*")
    of = ["host", "level", "parent"]
    branch = stored(nodes.groupBy(*of, "segment", "rest").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")], F.max("share").alias("share")), "branches")
    rest = branch.groupBy(*of, "rest").agg(F.sum("n").alias("rest_n"))
    each = branch.groupBy(*of, "segment").agg(*[F.sum(c).alias("b_" + c) for c in ("n", "good", "bad")], F.max("share").alias("share"))
    each = each.withColumn("bad_share", (F.col("b_bad") + weight * F.col("share")) / (F.col("b_good") + F.col("b_bad") + weight))
    pool = each.groupBy(*of).agg(
        F.sum("b_n").alias("pool_n"), F.count("*").alias("branches"), (F.sum(F.col("b_n") * F.col("bad_share")) / F.sum("b_n")).alias("pool_share")
    )
    each = each.join(pool, of).where((F.col("branches") > 1) & (F.col("segment") != ""))
    # total variation: what the branch has beyond the pool's share
    over = F.sum(F.greatest(F.col("n") / F.col("b_n") - F.col("rest_n") / F.col("pool_n"), F.lit(0.0)))
    far = branch.select(*of, "segment", "rest", "n").join(rest, [*of, "rest"]).join(each, [*of, "segment"]).groupBy(*of, "segment").agg(
        over.alias("distance"), F.max(F.abs(F.col("bad_share") - F.col("pool_share"))).alias("gap")
    )
    alike = far.where((F.col("distance") <= max_distance) & (F.col("gap") <= max_gap)).select(*of, "segment", F.lit("~").alias("name"))
    named = nodes.join(alike, [*of, "segment"], "left").select("host", "template", "level", F.coalesce("name", "segment").alias("name"))
    new = named.groupBy("host", "template").agg(F.transform(F.array_sort(F.collect_list(F.struct("level", "name"))), lambda x: x["name"]).alias("merged"))
    return templates.join(new, ["host", "template"], "left").withColumn("merged", F.coalesce("merged", "template"))


def template_badness(templates: DataFrame, weight: float) -> DataFrame:
    """``templates`` (host, template, merged, n, good, bad, shares) with
    ``badness``: the share of bad labels down the host's merged tree."""
    nodes = templates.select("host", "template", "n", "good", "bad", "merged", F.posexplode("shares").alias("level", "share"))
    nodes = nodes.withColumn("node", F.slice("merged", F.lit(1), F.col("level")))
    sums = nodes.groupBy("host", "node").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"), (F.sum(F.col("n") * F.col("share")) / F.sum("n")).alias("elsewhere"))
    # a host's templates meet its nodes dealt over salts
    salted = nodes.select("host", "template", "level", "node", _salt("template").alias("salt"))
    sums = sums.withColumn("salt", _each_salt())
    path = salted.join(sums, ["host", "node", "salt"]).groupBy("host", "template").agg(F.array_sort(F.collect_list(F.struct("level", "n_good", "n_bad", "elsewhere"))).alias("path"))
    # -1: above the root, whose prior is the corpus alone
    prior = lambda up, x: F.when(up < 0, x["elsewhere"]).otherwise((up + x["elsewhere"]) / 2)
    smooth = F.aggregate("path", F.lit(-1.0), lambda up, x: (x["n_bad"] + weight * prior(up, x)) / (x["n_good"] + x["n_bad"] + weight))
    return templates.join(path, ["host", "template"]).withColumn("badness", smooth).drop("path")


def judge_urls(pages: DataFrame, url: str = "url", rules=RULES, depth: int = 8, weight: float = 8.0, base: float = 0.2, max_bad: float = 0.5) -> DataFrame:
    """``pages`` with host, path, rule, template, badness and verdict."""
    pages = without(pages, *RESULTS)
    host, path = host_and_path(column(pages, url))
    row = F.struct(*[column(pages, c) for c in pages.columns]).alias("row")
    rows = pages.select(row, host.alias("host"), path.alias("path"))
    rows = rows.withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("key", F.xxhash64("host", "path"))
    label = lambda v: F.coalesce(F.sum((F.col("hit.verdict") == v).cast("long")), F.lit(0)).alias("good" if v == "allow" else "bad")
    paths = path_templates(rows.groupBy("host", "path").agg(F.count("*").alias("n"), label("allow"), label("block")), depth)
    templates = paths.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")])
    templates = stored(with_shares(stored(templates, "templates"), weight, base), "templates")
    merged = stored(merged_branches(templates, weight), "templates")
    judged = template_badness(merged, weight).select(F.col("host").alias("t_host"), F.col("template").alias("t_template"), "merged", "badness", _each_salt().alias("t_salt"))
    of_path = (F.col("host") == F.col("t_host")) & (F.col("template") == F.col("t_template")) & (_salt("path") == F.col("t_salt"))
    known = paths.join(judged, of_path).select("host", "path", "merged", "badness", F.xxhash64("host", "path").alias("key"))
    # fewer than HOT_PATHS keys by the definition of hot
    total = paths.agg(F.sum("n")).first()[0] or 0
    hot = paths.groupBy(F.xxhash64("host", "path").alias("key")).agg(F.sum("n").alias("n")).where(F.col("n") * HOT_PATHS > total).select("key", F.lit(True).alias("hot"))
    hot = F.broadcast(stored(hot, "hot_paths"))
    parts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    known = known.join(hot, "key", "left").select("host", "path", "merged", "badness", F.explode(parts).alias("part"))
    part = F.when(F.col("hot"), F.pmod(F.monotonically_increasing_id(), F.lit(HOT_SALTS)).cast("int")).otherwise(0)
    joined = rows.join(hot, "key", "left").withColumn("part", part).join(known, ["host", "path", "part"], "left")
    method = F.when(F.col("badness") > max_bad, "block").otherwise("allow")
    return joined.select(
        *[F.col("row").getField(c).alias(c) for c in pages.columns],
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.concat(F.lit("/"), _join("merged")).alias("template"),
        "badness",
        F.coalesce(F.col("hit.verdict"), method).alias("verdict"),
    )
