"""Intervals as aligned nodes: "interval contains point" as an equality, whatever the length of the interval.

Ticks are whole numbers (days, half hours ...).  Node ``i`` of rung ``k`` is the ticks from ``i * 4**k`` to before ``(i + 1) * 4**k``.  An interval of
n ticks is the disjoint union of at most about ``6 * log4(n)`` nodes, its cover: ten years of half hours are fewer than 50 rows, an end in
the year 9999 adds some ten.  A point lies in one node of each rung, so it meets each interval that contains it in exactly
one node, and none of the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import ntz

#: Bits per rung, and the highest rung: 4**30 ticks exceed any span of time in microseconds.  No interval of half days between the years 1
#: and 9999 has a node above the rung HALF_DAYS_TOP.
BITS, TOP, HALF_DAYS_TOP = 2, 30, 11


def _down(x: Column, bits: Column) -> Column:
    """Floor of ``x / 2**bits``, for negative numbers too."""
    return F.call_function("shiftright", x, bits.cast("int"))


def _up(x: Column, bits: Column) -> Column:
    return -_down(-x, bits)


def cover(first: Column, last: Column) -> Column:
    """Array of (rung, node) whose ticks are those from ``first`` to ``last``, both included; empty where ``first > last`` or one is NULL.

    The nodes of rung k that fit into the interval run from ``ceil(first / 4**k)`` to before ``floor((last + 1) / 4**k)``.  Those that do not lie in
    a fitting node of the next rung are the cover's; there are at most three at either end.
    """
    first, stop = first.cast("bigint"), last.cast("bigint") + 1
    rungs = F.least(F.ceil(F.log(4.0, F.greatest(stop - first, F.lit(1)))), F.lit(TOP)).cast("int")

    def nodes(k: Column) -> Column:
        low, high = _up(first, k * BITS), _down(stop, k * BITS)
        low_above, high_above = _up(first, (k + 1) * BITS), _down(stop, (k + 1) * BITS)
        ends = F.array(low, low + 1, low + 2, high - 3, high - 2, high - 1)
        above = lambda i: (_down(i, F.lit(BITS)) >= low_above) & (_down(i, F.lit(BITS)) < high_above)
        mine = F.filter(F.array_distinct(ends), lambda i: (i >= low) & (i < high) & ~above(i))
        return F.transform(mine, lambda i: F.struct(k.alias("rung"), i.alias("node")))

    every = F.flatten(F.transform(F.sequence(F.lit(0), rungs), nodes))
    return F.when(first < stop, every).otherwise(F.array().cast("array<struct<rung:int,node:bigint>>"))


def with_cover(intervals: DataFrame, first: Column, last: Column, rung: str = "__rung", node: str = "__node") -> DataFrame:
    """One row per interval and node of its cover; intervals without a tick are gone."""
    held = intervals.withColumn("__cover", F.explode(cover(first, last)))
    return held.withColumns({rung: F.col("__cover.rung"), node: F.col("__cover.node")}).drop("__cover")


def with_probes(points: DataFrame, tick: Column, covered: DataFrame, top: int | None = None, rung: str = "__rung", node: str = "__node") -> DataFrame:
    """One row per point and rung up to ``top``, or, without it, per rung that ``covered`` (of ``with_cover``) uses; points without a tick are gone.

    The rungs in use are one row of at most ``TOP + 1`` numbers.  ``top`` saves the scan for them where the length of an interval has a bound.
    """
    rungs = F.sequence(F.lit(0), F.lit(top)) if top is not None else covered.agg(F.collect_set(rung).alias("rungs")).scalar()
    out = points.filter(tick.isNotNull()).withColumn("__rungs", rungs).withColumn(rung, F.explode("__rungs")).drop("__rungs")
    return out.withColumn(node, _down(tick.cast("bigint"), F.col(rung) * BITS))


def slice_tick(ts: str | Column, minutes: int) -> Column:
    """Number of the slice of ``minutes`` that a time falls into."""
    at = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_seconds(at.cast("timestamp")) / (60 * minutes))


def covering(probes: DataFrame, tick: Column, covered: DataFrame, keys: Sequence[str], covered_keys: Sequence[str], top: int | None = None) -> DataFrame:
    """Rows of ``probes`` and of ``covered`` (of ``with_cover``) with equal keys, where the tick lies in the cover: one row per such pair.

    The columns of the two must differ, but for ``__rung`` and ``__node``.  NULL keys and ticks match nothing.
    """
    held = covered.withColumnsRenamed({"__rung": "__held_rung", "__node": "__held_node"})
    asked = with_probes(probes, tick, covered, top)
    cond = (F.col("__rung") == F.col("__held_rung")) & (F.col("__node") == F.col("__held_node"))
    for mine, theirs in zip(keys, covered_keys):
        cond = cond & (F.col(mine) == F.col(theirs))
    return asked.join(held, cond).drop("__rung", "__node", "__held_rung", "__held_node")


def date_tick(at: str | Column) -> Column:
    """Day number of a date."""
    at = F.col(at) if isinstance(at, str) else at
    return F.unix_date(at.cast("date")).cast("bigint")


def half_tick(at: str | Column) -> Column:
    """Twice the day number, one more behind midnight: a timestamp lies between two dates if its tick lies between their doubled days."""
    at = F.col(at) if isinstance(at, str) else at
    day = at.cast("date")
    return date_tick(at) * 2 + F.when(ntz(at) > ntz(day), 1).otherwise(0)
