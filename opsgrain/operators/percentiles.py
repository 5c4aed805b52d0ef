"""Exact medians and percentiles for large groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import ordered

#: Slices of a large group (a power of two), and distinct values from which a group is cut.
SLICES, LARGE = 256, 10_000


def sliced(counts: DataFrame, group: Sequence[str], value: str, weight: str, slices: int = SLICES, large: int = LARGE) -> DataFrame:
    """Add ``__n`` (sum of the weights of the group) and ``__piece`` (slice of the value, rising with it).

    The borders are approximate quantiles of the distinct values of a group, so a slice holds about an equal share of its rows
    whatever their distribution; a group of few values is one slice.  What follows is exact, as only the borders are approximate.
    """
    points = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    borders = F.when(F.count(F.lit(1)) > large, F.percentile_approx(value, points, F.lit(4 * slices)))
    sides = counts.groupBy(*group).agg(F.sum(weight).alias("__n"), borders.alias("__borders"))
    sides = sides.select(*[F.col(k).alias(f"__g_{k}") for k in group], "__n", "__borders")
    same = F.lit(True)
    for k in group:
        same = same & F.col(k).eqNullSafe(F.col(f"__g_{k}"))
    steps = F.array(*[F.lit(slices >> i) for i in range(1, slices.bit_length())])
    # binary search: the number of borders below the value
    below = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get("__borders", at + step - 1) < F.col(value), at + step).otherwise(at)
    )
    piece = F.when(F.col("__borders").isNotNull(), below).otherwise(F.lit(0))
    return counts.join(sides, same).withColumn("__piece", piece).drop("__borders", *[f"__g_{k}" for k in group])


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float], slices: int = SLICES, large: int = LARGE) -> DataFrame:
    """Interpolated percentiles per group (as PERCENTILE_CONT), exact at any group size.

    The built-in aggregate keeps all distinct values of a group in one buffer.  Here the
    values first collapse to (group, value, count), a large group is cut into slices of about equal
    size, counts are cumulated per slice, and only the values around the wanted ranks are
    kept.  NULL values are skipped, NULL is a group like any other.  ``points`` maps output
    names to fractions.
    """
    group = list(keys) or ["__all"]
    base = df if keys else df.withColumn("__all", F.lit(0))
    counts = (
        base.filter(F.col(value).isNotNull())
        .groupBy(*group, F.col(value).cast("double").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__c"))
    )
    cut = sliced(counts, group, "__v", "__c", slices, large)
    ranked = ordered(cut, group, ["__v"], F.col("__piece"), running={"__upto": F.col("__c")})
    # rank r (0-based) belongs to the value with upto - c <= r < upto
    first = F.col("__upto") - F.col("__c")
    aggs = []
    for name, p in points.items():
        at = (F.col("__n") - 1) * F.lit(float(p))
        lo, hi = F.floor(at), F.ceil(at)
        aggs.append(F.max(F.when((first <= lo) & (lo < F.col("__upto")), F.col("__v"))).alias(f"__lo_{name}"))
        aggs.append(F.max(F.when((first <= hi) & (hi < F.col("__upto")), F.col("__v"))).alias(f"__hi_{name}"))
        aggs.append(F.max(at - lo).alias(f"__w_{name}"))
    out = ranked.groupBy(*group).agg(*aggs)
    return out.select(
        *keys,
        *[
            (F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__w_{n}")).alias(n)
            for n in points
        ],
    )
