"""Join shapes: point-in-time lookups, interval joins, exclusions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import ntz
from .cover import HALF_DAYS_TOP, covering, date_tick, half_tick, slice_tick, with_cover
from .ordered import asof_lookup

#: Days (or half days) that ``asof_dim`` compares with the versions of a key at once, as a power of four; no version has a cover of stretches above
#: the rung STRETCHES_TOP.
STRETCH_RUNG = 4
STRETCH, STRETCHES_TOP = 4**STRETCH_RUNG, HALF_DAYS_TOP - STRETCH_RUNG


def _stretch(tick: Column) -> Column:
    return F.floor(tick / STRETCH)


#: Bytes in memory of a byte in a compressed file, about.
UNPACKED = 10


def broadcast_size(df: DataFrame) -> bool:
    """Does the estimated size allow a broadcast?  Spark's estimate is that of the files, so it is multiplied by ``UNPACKED``."""
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) * UNPACKED <= most


def dim_side(dim: DataFrame) -> DataFrame:
    """The dimension side of an equal join: by sort and merge where its rows, unpacked, are too many for a broadcast.

    The driver builds the table of a broadcast and every executor holds it, while well compressed keys and names look small in their files.
    """
    return dim if broadcast_size(dim) else dim.hint("merge")


def asof_dim(
    fact: DataFrame,
    dim: DataFrame,
    key: str | tuple[str, str],
    ts: str | Column,
    cols: dict[str, str],
    *,
    start: str = "start_date",
    end: str = "end_date",
    by_date: bool = True,
    how: str = "left",
) -> DataFrame:
    """Attributes of the dimension version valid at ``ts`` (both ends included).

    ``by_date=True`` compares calendar days.  ``by_date=False`` compares the timestamp with
    the DATE bounds, which loses the last day after midnight.  Overlapping versions give one
    row each, as the relational join does.

    A dimension whose estimated size Spark would broadcast is joined on the key, with the range as residual: the facts stay where
    they are, and a key cannot have more versions than fit into the broadcast.  Beyond that size versions are not compared
    with the facts of their key.  Time is cut into days (or midnights and what lies between them), and these into stretches of ``STRETCH``.  The distinct
    pairs of key and day of the facts meet the versions that reach into their stretch, which the covers of the versions in stretches
    (``operators.cover``) tell, and the facts join what was found for their own pair.  In a stretch a version is compared with ``STRETCH`` pairs
    at most, however many facts these stand for.  So the cost grows with the facts, the pairs and the versions, not with their product, and a key
    with very many facts or versions is split at run time like any other equal key.
    """
    fact_key, dim_key = (key, key) if isinstance(key, str) else key
    at = F.col(ts) if isinstance(ts, str) else ts
    slim = dim.select(
        F.col(dim_key).alias("__dk"),
        F.col(start).cast("date").alias("__from"),
        F.col(end).cast("date").alias("__to"),
        *[F.col(src).alias(f"__d_{out}") for out, src in cols.items()],
    ).filter(F.col("__dk").isNotNull())
    keep, attributes = [c for c in fact.columns if c not in cols], [F.col(f"__d_{out}").alias(out) for out in cols]
    if broadcast_size(slim):
        bound = "date" if by_date else "timestamp_ntz"
        facts = fact.withColumn("__at", at.cast("date") if by_date else ntz(at))
        valid = facts["__at"].between(slim["__from"].cast(bound), slim["__to"].cast(bound))
        return facts.join(slim, (facts[fact_key] == slim["__dk"]) & valid, how).select(*keep, *attributes)
    tick, first, last = (date_tick(at), date_tick("__from"), date_tick("__to")) if by_date else (half_tick(at), half_tick("__from"), half_tick("__to"))
    held = slim.select("__dk", first.alias("__first"), last.alias("__last"), *[f"__d_{out}" for out in cols]).filter("__first <= __last")
    pairs = fact.select(F.col(fact_key).alias("__fk"), tick.alias("__tick")).filter("__fk is not null and __tick is not null").distinct()
    pairs = pairs.withColumn("__stretch", _stretch(F.col("__tick")))
    used = pairs.select(F.col("__fk").alias("__uk"), F.col("__stretch").alias("__in")).distinct()
    spread = with_cover(held, _stretch(F.col("__first")), _stretch(F.col("__last")))
    near = covering(used, F.col("__in"), spread, ["__uk"], ["__dk"], top=STRETCHES_TOP).drop("__dk")
    met = pairs.join(near, (F.col("__fk") == F.col("__uk")) & (F.col("__stretch") == F.col("__in")))
    hit = F.when(F.col("__tick").between(F.col("__first"), F.col("__last")), F.array(F.struct(*[f"__d_{out}" for out in cols])))
    valid = met.select("__fk", "__tick", F.explode_outer(hit).alias("__hit")).filter("__hit is not null").select("__fk", "__tick", "__hit.*")
    facts = fact.withColumn("__at", tick)
    joined = facts.join(valid, (facts[fact_key] == valid["__fk"]) & (facts["__at"] == valid["__tick"]), how)
    return joined.select(*keep, *attributes)


def fold_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left") -> DataFrame:
    """Join on a case-folded key; the right key is dropped."""
    folded = right.withColumn("__fold", F.lower(F.col(right_key))).drop(right_key)
    return left.withColumn("__l", F.lower(F.col(left_key))).join(folded, F.col("__l") == F.col("__fold"), how).drop(
        "__l", "__fold"
    )


def exclude(left: DataFrame, right: DataFrame, on: Sequence[str] | Column) -> DataFrame:
    """Rows of ``left`` without partner (left anti join)."""
    return left.join(right, on, "left_anti")


def contains_join(
    points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, *, minutes: int, how: str = "inner", keys: Sequence[str] = (),
) -> DataFrame:
    """Theta join "interval contains point" (both ends included) as an equality of nodes; see ``operators.cover``.

    Slices of ``minutes`` are the ticks, and the ends, which need not be ends of slices, are compared afterwards.  An interval is a
    few rows whatever its length, so an open end written as a far date costs no more than another.  NULL keys, points
    and ends match nothing.  ``how="left"`` keeps points without interval; it finds the intervals of distinct points first.
    """
    slim = intervals.filter(F.col(end) >= F.col(start)).withColumnsRenamed({k: f"__i_{k}" for k in keys})
    held = with_cover(slim, slice_tick(start, minutes), slice_tick(end, minutes))
    inside = F.col(point).between(F.col(start), F.col(end))
    theirs = [f"__i_{k}" for k in keys]
    if how == "inner":
        return covering(points, slice_tick(point, minutes), held, keys, theirs).filter(inside).drop(*theirs)
    once = points.select(point, *keys).distinct()
    hits = covering(once, slice_tick(point, minutes), held, keys, theirs).filter(inside).drop(*theirs)
    hits = hits.withColumnsRenamed({c: f"__p_{c}" for c in (point, *keys)})
    same = [points[c] == hits[f"__p_{c}"] for c in (point, *keys)]
    return points.join(hits, same, how).drop(*[f"__p_{c}" for c in (point, *keys)])


def state_at(facts: DataFrame, history: DataFrame, key: str, ts: str, changed_at: str, cols: dict[str, str], tie=(), how="inner", chunk: str = "day") -> DataFrame:
    """Latest history row at or before each fact, without making the pairs."""
    out = asof_lookup(facts, history, [key], ts, changed_at, {**cols, "__found": changed_at}, tie=tie, chunk=chunk)
    if how == "inner":
        out = out.filter(F.col("__found").isNotNull())
    return out.drop("__found")


def seen_before(events: DataFrame, earlier: DataFrame, key: str, day: str, earlier_day: str, flag: str) -> DataFrame:
    """Flag: does ``earlier`` hold the key on the same day or before?

    Only existence counts, so the earlier side shrinks to its first day per key first.
    """
    first = earlier.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(earlier_day).alias("__first"))
    return (
        events.join(first, key, "left")
        .withColumn(flag, F.coalesce(F.col(day) >= F.col("__first"), F.lit(False)))
        .drop("__first")
    )


def role_join(df: DataFrame, dim: DataFrame, df_key: str, dim_key: str, prefix: str, cols: Sequence[str]) -> DataFrame:
    """One more left join of the same dimension, its columns prefixed by the role."""
    side = dim.select(F.col(dim_key).alias(f"__{prefix}"), *[F.col(c).alias(f"{prefix}_{c}") for c in cols])
    return df.join(side, df[df_key] == side[f"__{prefix}"], "left").drop(f"__{prefix}")
