"""Spreading time spans over fixed intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import add, datediff_boundary, ntz, time_slice


def spread(df: DataFrame, start: str, end: str, minutes: int = 30, closed: bool = False) -> DataFrame:
    """One row per interval a span touches, with ``interval_start`` and ``interval_end``.

    Each row makes its own intervals, so no calendar is joined and nothing is shuffled.
    Spans with a NULL bound or that end before they start give none.  ``closed`` also keeps
    intervals a span only touches with an end point.
    """
    width = F.expr(f"interval {minutes} minutes")
    first, last = time_slice(start, minutes), time_slice(end, minutes)
    if closed:
        first = F.when(F.col(start) == first, add("minute", -minutes, first)).otherwise(first)
    else:
        last = F.when((F.col(end) == last) & (F.col(end) > F.col(start)), add("minute", -minutes, last)).otherwise(last)
    steps = F.sequence(first.cast("timestamp"), last.cast("timestamp"), width)
    out = df.filter(F.col(end) >= F.col(start)).withColumn("interval_start", F.explode(steps))
    out = out.withColumn("interval_start", ntz("interval_start"))
    return out.withColumn("interval_end", add("minute", minutes, "interval_start"))


def slots_inside(df: DataFrame, start: str, end: str, day_from, day_to, minutes: int = 30) -> DataFrame:
    """One row per slot of the days from ``day_from`` to before ``day_to`` that begins inside a span, both ends included.

    Equals the join with a calendar of slots on "the span contains the slot's start".  Spans are clipped to the days first, so an
    open end costs as many rows as the result has.  Columns ``interval_start``, ``interval_end``, ``report_date``.
    """
    low, high = (F.lit(str(d)).cast("date").cast("timestamp_ntz") for d in (day_from, day_to))
    first = time_slice(start, minutes)
    first = F.greatest(F.when(F.col(start) == first, first).otherwise(add("minute", minutes, first)), low)
    last = F.least(time_slice(end, minutes), add("minute", -minutes, high))
    inside = df.filter((F.col(end) >= F.col(start)) & (F.col(end) >= low) & (F.col(start) < high)).withColumns({"__first": first, "__last": last}).filter("__first <= __last")
    steps = F.sequence(F.col("__first").cast("timestamp"), F.col("__last").cast("timestamp"), F.expr(f"interval {minutes} minutes"))
    out = inside.withColumn("interval_start", F.explode(steps)).withColumn("interval_start", ntz("interval_start")).drop("__first", "__last")
    return out.withColumns({"interval_end": add("minute", minutes, "interval_start"), "report_date": F.col("interval_start").cast("date")})


def prorate_to_intervals(
    df: DataFrame, start: str, end: str, minutes: int = 30, out: str = "interval_seconds", compat: bool = False
) -> DataFrame:
    """Seconds of a span that fall into each interval; they sum to the span.

    ``compat=True`` keeps an old three-branch rule: touching intervals count, and the middle
    of a span over three or more intervals runs from the interval start to the span end.
    """
    rows = spread(df, start, end, minutes, closed=compat)
    s, e, a, b = F.col(start), F.col(end), F.col("interval_start"), F.col("interval_end")
    if compat:
        seconds = (
            F.when((s >= a) & (e <= b), datediff_boundary("second", s, e))
            .when(s >= a, datediff_boundary("second", s, b))
            .otherwise(datediff_boundary("second", a, e))
        )
    else:
        seconds = datediff_boundary("second", F.greatest(s, a), F.least(e, b))
    return rows.withColumn(out, seconds)


def available_in_interval(interval_start: Column, interval_end: Column, span_end: Column, minutes: int = 30) -> Column:
    """Minutes of an interval covered by a span that began before it."""
    return F.when(interval_end < span_end, F.lit(minutes).cast("bigint")).otherwise(
        datediff_boundary("minute", interval_start, span_end)
    )
