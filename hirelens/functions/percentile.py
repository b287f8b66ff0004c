"""Exact, interpolated percentile per group, one lazy plan of fixed depth.

``PERCENTILE_CONT``: position ``p * (n - 1)`` among a group's ordered values,
interpolated between its two neighbours. Spark's own ``percentile`` merges all
values of a group in one task; this finds the neighbours through three nested
parts of a value's 64 bits instead (``BITS``):

1. rows are counted per (group, value): one shuffle, spread by the value;
2. bottom up, these counts are added up per inner part and per outer part, each
   with the running sum over its neighbours in the next larger part;
3. top down, both wanted ranks are looked up: the outer part that holds them,
   the inner part within it, the value within that.

The depth is the same for any input, no job runs while the plan is built, and
no window holds more than 2^22 rows whatever the size of a group: that many
values lie in an inner part, that many inner parts in an outer one, and there
are 2^20 outer parts. The look-ups are joins with two rows per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: bits of the value within an inner part, and of the inner part within an outer one
BITS = 22


def counted(df: DataFrame, keys: Sequence[str], value: str, sums: Sequence[Column] = ()) -> DataFrame:
    """Rows per (keys, value): ``_n``, and ``sums`` of the same rows."""
    return df.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"), *sums)


def _running(df: DataFrame, within: Sequence[str], by: str) -> DataFrame:
    """``_to``: the rows up to and with this one, in the order of ``by``."""
    w = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_to", F.sum("_w").over(w))


def _holds() -> Column:
    """The row holds the rank ``_k``; a group of nulls alone has one row per
    level (part -1)."""
    return ((F.col("_k") < F.col("_to")) & (F.col("_k") >= F.col("_to") - F.col("_w"))) | (F.col("_a") < 0)


def _rest() -> Column:
    return (F.col("_k") - (F.col("_to") - F.col("_w"))).alias("_k")


def percentile_of_counts(counts: DataFrame, keys: Sequence[str], p: float, alias: str, scale: float = 1.0, sums: Mapping[str, Column] | None = None) -> DataFrame:
    """``keys``, the ``sums`` over the group's counted rows, and the percentile
    of its values divided by ``scale``; ``counts`` as of ``counted``. A group
    without values has a null percentile; a null key is a group."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be in [0, 1]")
    sums = dict(sums or {})
    # the sign bit flipped, so that parts order as the values do
    bits = F.col("_v").bitwiseXOR(F.lit(-(2**63)))
    part = lambda shift: F.shiftrightunsigned(bits, shift)
    outer = F.coalesce(part(2 * BITS), F.lit(-1).cast("long"))
    inner = F.coalesce(part(BITS).bitwiseAND(F.lit(2**BITS - 1)), F.lit(-1).cast("long"))
    # one column for the keys: equal structs have equal fields, nulls included
    group = F.struct(*[F.col(k) for k in keys])
    weight = F.when(F.col("_v").isNull(), 0).otherwise(F.col("_n")).cast("long")
    values = counts.select(group.alias("_g"), outer.alias("_a"), inner.alias("_b"), "_v", weight.alias("_w"), *[c.alias(n) for n, c in sums.items()])
    totals = lambda: [F.sum("_w").alias("_w"), *[F.sum(n).alias(n) for n in sums]]

    inners = _running(values.groupBy("_g", "_a", "_b").agg(*totals()), ["_g", "_a"], "_b")
    outers = _running(inners.groupBy("_g", "_a").agg(*totals()), ["_g"], "_a")
    all_of = Window.partitionBy("_g")
    outers = outers.withColumns({"_rows": F.sum("_w").over(all_of), **{n: F.sum(n).over(all_of) for n in sums}})

    pos = F.lit(float(p)) * (F.greatest(F.col("_rows"), F.lit(1)) - 1).cast("double")
    ranks = F.array(*[F.struct(f(pos).cast("long").alias("k"), F.lit(i).alias("i")) for i, f in enumerate((F.floor, F.ceil))])
    found = outers.where("_a >= 0 OR _rows = 0").select("*", F.explode(ranks).alias("_r")).select("*", F.col("_r.k").alias("_k"), F.col("_r.i").alias("_i")).where(_holds())
    found = found.select("_g", "_a", "_i", _rest(), (pos - F.floor(pos)).alias("_part"), *sums)
    inners = inners.where("_w > 0 OR _a < 0").select("_g", "_a", "_b", "_w", "_to")
    found = inners.join(found, ["_g", "_a"]).where(_holds()).select("_g", "_a", "_b", "_i", _rest(), "_part", *sums)
    held = _running(values.select("_g", "_a", "_b", "_v", "_w").join(found, ["_g", "_a", "_b"]), ["_g", "_a", "_b", "_i"], "_v").where(_holds())

    one = lambda i: F.max(F.when(F.col("_i") == i, F.col("_v"))) / F.lit(float(scale))
    out = held.groupBy("_g").agg(one(0).alias("_x"), one(1).alias("_y"), F.max("_part").alias("_part"), *[F.max(n).alias(n) for n in sums])
    return out.select(*[F.col("_g").getField(k).alias(k) for k in keys], *sums, (F.col("_x") + F.col("_part") * (F.col("_y") - F.col("_x"))).alias(alias))


def percentile_cont(df: DataFrame, keys: Sequence[str], value: str, p: float, alias: str | None = None) -> DataFrame:
    """``keys`` and the exact p-th percentile of the long column ``value``;
    nulls are ignored."""
    return percentile_of_counts(counted(df, keys, value), keys, p, alias or f"p{int(round(p * 100))}_{value}")
