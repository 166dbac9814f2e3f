"""Deterministic sampling: every draw depends on a seed and the row's key alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def token(seed: int | str, *key: Column | str) -> Column:
    """md5 of seed:key[:key...] as hex, the sort key of a shuffle."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in key]))


def uniform(seed: int | str, *key: Column | str) -> Column:
    """A number in [0, 1) from 48 bits of the token."""
    return F.conv(F.substring(token(seed, *key), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def shuffled(seed: int | str, *key: Column | str) -> list[Column]:
    """Sort columns that shuffle rows: the token's first 12 characters, then the key."""
    return [F.substring(token(seed, *key), 1, 12), *[F.col(k) if isinstance(k, str) else k for k in key]]


def pick_n(df: DataFrame, seed: int, key: Sequence[str], n: int, by: Sequence[str] = ()) -> DataFrame:
    """n rows (of each group) without replacement."""
    order = shuffled(seed, *key)
    if not by:
        return df.orderBy(*order).limit(n)
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__rn") <= n).drop("__rn")


def thin(df: DataFrame, seed: int, key: Sequence[str], p: Column) -> DataFrame:
    """Rows with a uniform below min(1, p), p of each row's own."""
    return df.where(uniform(seed, *key) < F.least(F.lit(1.0), p))


def weighted_draws(table: DataFrame, item: str, weight: str, draws: DataFrame, key: str, seed: int, by: Sequence[str] = (), buckets: Column | None = None) -> DataFrame:
    """For each row of draws an item of table (of its class `by`), with replacement, by weight.

    Items own adjacent parts of [0, 1) in order of item; a draw's uniform falls into
    one of them. The parts meet the draws on equal cells, as many as table has items (1024
    at least), an equi-join. buckets, a column of table that never falls as item rises, lets
    running sums go in levels, so that a class's items needn't meet in one task, and has
    draws and items merged: neither side is small. Draws of a
    class without any weight, and null weights, have no row; items of a class differ."""
    table = table.where(F.col(weight) > 0).withColumn("__bucket", F.lit(0) if buckets is None else buckets)
    per = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    inside = Window.partitionBy(*by, "__bucket")
    upto = F.sum(weight).over(inside.orderBy(item).rowsBetween(Window.unboundedPreceding, 0))
    if buckets is None:
        table = table.withColumn("__base", F.lit(0)).withColumn("__total", F.sum(weight).over(per))
    else:
        sums = table.groupBy(*by, "__bucket").agg(F.sum(weight).alias("__s"))
        before = F.coalesce(F.sum("__s").over(per.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        sums = sums.select(*[F.col(c).alias(f"__b_{c}") for c in by], F.col("__bucket").alias("__b"), before.alias("__base"), F.sum("__s").over(per).alias("__total"))
        cond = F.col("__bucket").eqNullSafe(F.col("__b"))
        for c in by:
            cond = cond & F.col(c).eqNullSafe(F.col(f"__b_{c}"))
        table = table.join(sums, cond)
    cells = F.greatest(F.lit(1024), table.agg(F.count(F.lit(1))).scalar())
    upto, total = F.col("__base") + upto, F.col("__total")
    parts = table.select(*[F.col(c).alias(f"__by_{c}") for c in by], item, ((upto - F.col(weight)) / total).alias("__lo"), F.when(upto >= total, 1.0).otherwise(upto / total).alias("__hi"))
    parts = parts.withColumn("__cells", cells).withColumn("__cell", F.explode(F.sequence(F.floor(F.col("__lo") * F.col("__cells")), F.floor(F.col("__hi") * F.col("__cells")))))
    d = draws.withColumn("u", uniform(seed, key)).withColumn("__at", F.floor(F.col("u") * cells))
    cond = (F.col("__at") == F.col("__cell")) & (F.col("u") >= F.col("__lo")) & (F.col("u") < F.col("__hi"))
    for c in by:
        cond = cond & (F.col(c) == F.col(f"__by_{c}"))
    return d.join(parts if buckets is None else parts.hint("merge"), cond).drop("__at", "__cell", "__cells", "__lo", "__hi", *[f"__by_{c}" for c in by])


def normal(seed: int | str, *key: Column | str) -> Column:
    """A standard normal number from two uniforms of the key."""
    return F.sqrt(-2 * F.log(1 - uniform(f"{seed}:a", *key))) * F.cos(2 * F.pi() * uniform(f"{seed}:b", *key))


def stride(i: Column, span: Column | int, seed: int, low: int = 0) -> Column:
    """A permutation of low .. low + span - 1 by a stride of 7919, if span isn't a multiple of it."""
    span = F.lit(span) if isinstance(span, int) else span
    return F.lit(low) + F.pmod(i * 7919 + F.lit(seed * 104729), span)


def ranked_sizes(groups: DataFrame, n: str, total: str, share: float, top: int) -> DataFrame:
    """For each row of groups its columns and rank, size: n sizes that fall as a power of
    their rank, whose largest `top` hold `share` of the total, and which sum to it.

    The exponent lies between 0.1 and 4 and is halved in on sixty times, as an
    expression. Sizes are rounded, at least 1; what rounding leaves over goes one by one
    to the ranks in turn, what it lacks is taken in turn from those above 1. If the total
    is less than n, all sizes are 1. No groups, or n below 1, give no rows."""
    ranks = F.sequence(F.lit(1), F.col(n).cast("int"))

    def weights(exponent):
        return F.transform(ranks, lambda k: F.pow(k.cast("double"), -exponent))

    def summed(xs):
        return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)

    def halved(s, _):
        mid = (s["low"] + s["high"]) / 2
        w = weights(mid)
        small = summed(F.slice(w, 1, top)) / summed(w) < share
        return F.struct(F.when(small, mid).otherwise(s["low"]).alias("low"), F.when(small, s["high"]).otherwise(mid).alias("high"))

    def worked_out(df, name, value):
        """value as a column that later ones read, instead of repeating its expression."""
        return df.select("*", F.explode(F.array(value)).alias(name))

    d = worked_out(groups.where(F.col(n) >= 1), "__x", F.aggregate(F.sequence(F.lit(1), F.lit(60)), F.struct(F.lit(0.1).alias("low"), F.lit(4.0).alias("high")), halved))
    d = worked_out(d, "__w", weights((F.col("__x.low") + F.col("__x.high")) / 2))
    d = worked_out(d, "__all", summed(F.col("__w")))
    d = worked_out(d, "__s", F.transform("__w", lambda w: F.greatest(F.lit(1), F.round(F.col(total) * w / F.col("__all"))).cast("long")))
    long_sum = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    d = worked_out(d, "__off", F.col(total) - long_sum(F.col("__s")))
    # Whole rounds in which every size above 1 gives one, and what the last round lacks.
    given = lambda r: long_sum(F.transform("__s", lambda s: F.least(r, s - 1)))
    rounds = F.when(F.col("__off") < 0, F.array_max(F.filter(F.sequence(F.lit(0).cast("long"), F.least(-F.col("__off"), F.array_max("__s") - 1)), lambda r: given(r) <= -F.col("__off")))).otherwise(F.lit(0).cast("long"))
    d = worked_out(worked_out(d, "__r", rounds), "__more", -F.col("__off") - given(F.col("__r")))
    d = d.withColumn("__n", F.col(n).cast("long"))
    d = d.select(*groups.columns, "__off", "__r", "__more", "__n", "__s", F.posexplode("__s").alias("__i", "__size"))
    more = F.floor(F.col("__off") / F.col("__n")) + F.when(F.col("__i") < F.pmod("__off", "__n"), 1).otherwise(0)
    ahead = F.size(F.filter(F.slice("__s", F.lit(1), F.col("__i")), lambda s: s - 1 > F.col("__r")))
    less = F.least("__r", F.col("__size") - 1) + F.when((F.col("__size") - 1 > F.col("__r")) & (ahead < F.col("__more")), 1).otherwise(0)
    return d.select(*groups.columns, (F.col("__i") + 1).alias("rank"), F.when(F.col("__off") >= 0, F.col("__size") + more).otherwise(F.col("__size") - less).cast("long").alias("size"))
