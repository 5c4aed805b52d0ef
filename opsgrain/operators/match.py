"""Nearest contacts, first-contact resolution, time-tolerant matching."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import datediff_boundary
from .ordered import STEP_SECONDS as SECONDS
from .ordered import epoch_micros, ordered, time_chunk


def _borders(df: DataFrame, key: str, row_id: str, ts: str, tag: str, chunk: str) -> DataFrame:
    """Rows with the tagged row before (``__ps``) and behind (``__ns``) where its tag is another one, among the tagged rows of the key.

    The nearest row with another tag of any row of a run of one tag is that of the run's border row.  Untagged rows are kept out
    of the sequence by a partition of their own, and have none.
    """
    here = F.struct(F.col(ts).alias("ts"), F.col(tag).alias("tag"))
    apart = df.withColumn("__untagged", F.col(tag).isNull())
    runs = ordered(apart, [key, "__untagged"], [ts, row_id], time_chunk(ts, chunk), lag={"__pl": here}, lead={"__nl": here})
    start = F.when(F.col("__pl")["tag"] != F.col(tag), F.col("__pl"))
    stop = F.when(F.col("__nl")["tag"] != F.col(tag), F.col("__nl"))
    return runs.select(*df.columns, start.alias("__ps"), stop.alias("__ns"))


def _nearer(df: DataFrame, ts: str, relation: str, before: str, behind: str, known: Column) -> DataFrame:
    """The nearer one of two neighbours (struct of ts and tag) as columns of the relation; equal distances go to the earlier row."""
    before, behind = F.when(known, F.col(before)), F.when(known, F.col(behind))
    back, ahead = datediff_boundary("day", F.col(ts), before["ts"]), datediff_boundary("day", F.col(ts), behind["ts"])
    pick = F.when(before.isNotNull() & (behind.isNull() | (F.abs(back) <= F.abs(ahead))), before).otherwise(behind)
    out = df.withColumn("__pick", pick)
    return out.withColumns(
        {
            f"{relation}_days": datediff_boundary("day", F.col(ts), F.col("__pick")["ts"]),
            f"{relation}_ts": F.col("__pick")["ts"],
            f"{relation}_tag": F.col("__pick")["tag"],
        }
    ).drop("__pick")


def nearest_related(
    df: DataFrame, key: str, row_id: str, ts: str, tag: str, relation: str = "any", chunk: str = "day"
) -> DataFrame:
    """Nearest other row of the same key: ``any``, with the ``same`` or a ``different`` tag.

    Adds ``<relation>_days`` (signed boundary days, NULL without partner), ``<relation>_ts``
    and ``<relation>_tag``.  Equal distances go to the earlier row.  ``df`` has one row per
    ``row_id``.  Neighbours come from the ordered scan, so cost is linear in the rows of a
    key; the self join would compare all pairs.  A NULL tag is never same nor different.
    """
    here = F.struct(F.col(ts).alias("ts"), F.col(tag).alias("tag"))
    span, order = time_chunk(ts, chunk), [ts, row_id]
    known = F.lit(True) if relation == "any" else F.col(tag).isNotNull()
    if relation in ("any", "same"):
        keys = [key] if relation == "any" else [key, tag]
        near = ordered(df, keys, order, span, lag={"__p": here}, lead={"__n": here})
    elif relation == "different":
        near = ordered(
            _borders(df, key, row_id, ts, tag, chunk), [key], order, span, last_seen={"__p": F.col("__ps")}, next_seen={"__n": F.col("__ns")},
        ).drop("__ps", "__ns")
    else:
        raise ValueError(relation)
    return _nearer(near, ts, relation, "__p", "__n", known).drop("__p", "__n")


def nearest_of_each(df: DataFrame, key: str, row_id: str, ts: str, tag: str, chunk: str = "day") -> DataFrame:
    """``nearest_related`` for ``any``, ``same`` and ``different`` in three scans that carry key, time, id and tag only.

    The scan over the whole key serves both ``any`` and ``different``.  Other columns of ``df`` join once at the end.
    """
    here = F.struct(F.col(ts).alias("ts"), F.col(tag).alias("tag"))
    span, order, tagged = time_chunk(ts, chunk), [ts, row_id], F.col(tag).isNotNull()
    slim = df.select(key, row_id, ts, tag)
    near = ordered(slim, [key, tag], order, span, lag={"__p": here}, lead={"__n": here})
    near = _nearer(near, ts, "same", "__p", "__n", tagged).drop("__p", "__n")
    near = ordered(
        _borders(near, key, row_id, ts, tag, chunk), [key], order, span, lag={"__p": here}, lead={"__n": here},
        last_seen={"__pd": F.col("__ps")}, next_seen={"__nd": F.col("__ns")},
    )
    near = _nearer(_nearer(near, ts, "any", "__p", "__n", F.lit(True)), ts, "different", "__pd", "__nd", tagged)
    found = [f"{r}_{c}" for r in ("any", "same", "different") for c in ("days", "ts", "tag")]
    rest = [c for c in df.columns if c not in slim.columns]
    if not rest:
        return near.select(*df.columns, *found)
    return near.select(row_id, key, ts, tag, *found).join(df.select(row_id, *rest), row_id).select(*df.columns, *found)


def first_contact_resolution(days: str | Column, limits: Sequence[int] = (7, 14, 28), missing: int = 100) -> dict[str, Column]:
    """``fcr_<n>_day`` flags: no repeat within n days either way (no repeat counts as far away)."""
    gap = F.abs(F.coalesce(F.col(days) if isinstance(days, str) else days, F.lit(missing)))
    return {f"fcr_{n}_day": gap > n for n in limits}


def tolerance_scan(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    cols: Mapping[str, str],
    *,
    row_id: str,
    before_seconds: int,
    after_seconds: int,
    prefer: Column | None = None,
    tie: Sequence[str] = (),
    count: str | None = None,
    chunk: str = "day",
) -> DataFrame:
    """Best right row with ts in [left - before, left + after] per left row, without making pairs.

    Preferred rows come first, then the earliest.  Per preference class the answer is the
    first right row at or after ``left - before``; ``count`` adds the number of right rows in
    the span, read off a running total at both of its ends.  Both sides are stacked and
    scanned once.  Returns ``row_id``, ``cols`` and ``count``; left rows with NULL key or time
    are absent.
    """
    known = F.col(key).isNotNull()
    at = epoch_micros(F.col(left_ts))
    low = F.struct((at - before_seconds * 1_000_000).alias("at"), F.lit(0).alias("rank"), F.lit(-1).alias("sign"))
    high = F.struct((at + after_seconds * 1_000_000).alias("at"), F.lit(2).alias("rank"), F.lit(1).alias("sign"))
    ends = F.explode(F.array(low, high) if count else F.array(low))
    probes = left.filter(known & F.col(left_ts).isNotNull()).select(key, F.col(row_id).alias("__id"), ends.alias("p"))
    probes = probes.select(key, "__id", F.col("p.at").alias("__at"), F.col("p.rank").alias("__rank"), F.col("p.sign").alias("__sign"))

    good = F.lit(True) if prefer is None else F.coalesce(prefer, F.lit(False))
    hit = F.struct(epoch_micros(F.col(right_ts)).alias("__us"), *[F.col(src).alias(out) for out, src in cols.items()])
    ties = [f"__tie{i}" for i in range(len(tie))]
    rights = right.filter(known & F.col(right_ts).isNotNull()).select(
        key, epoch_micros(F.col(right_ts)).alias("__at"), F.lit(1).alias("__rank"), F.lit(0).alias("__sign"),
        *[F.col(t).alias(c) for t, c in zip(tie, ties)],
        F.when(good, hit).alias("__good"), F.when(~good, hit).alias("__other"), F.lit(1).cast("bigint").alias("__w"),
    )
    stacked = rights.unionByName(probes, allowMissingColumns=True)
    seen = {"__g": F.col("__good")}
    if prefer is not None:
        seen["__o"] = F.col("__other")
    scanned = ordered(
        stacked, [key], ["__at", "__rank", *ties], F.floor(F.col("__at") / (SECONDS[chunk] * 1_000_000)),
        next_seen=seen, running={"__t": F.col("__w")} if count else None,
    ).filter(F.col("__sign") != 0)

    last = F.col("__at") + (before_seconds + after_seconds) * 1_000_000
    pick = F.when(F.col("__g")["__us"] <= last, F.col("__g"))
    if prefer is not None:
        pick = pick.when(F.col("__o")["__us"] <= last, F.col("__o"))
    if count:
        found = scanned.groupBy("__id").agg(
            F.max(F.when(F.col("__sign") == -1, pick)).alias("__pick"),
            F.sum(F.coalesce(F.col("__t"), F.lit(0)) * F.col("__sign")).alias(count),
        )
    else:
        found = scanned.select("__id", pick.alias("__pick"))
    return found.select(F.col("__id").alias(row_id), *[F.col("__pick")[c].alias(c) for c in cols], *([count] if count else []))


def match_with_tolerance(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, cols: Mapping[str, str], *, row_id: str, **options
) -> DataFrame:
    """Left rows with the columns of their best match (see ``tolerance_scan``); all left rows stay."""
    return left.join(tolerance_scan(left, right, key, left_ts, right_ts, cols, row_id=row_id, **options), row_id, "left")


def evidence_flags(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Boolean "has X" columns from nullable evidence columns."""
    return df.withColumns({out: F.col(c).isNotNull() for out, c in flags.items()})
