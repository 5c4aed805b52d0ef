"""Business-day arithmetic in native expressions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dialect import col

_MONDAY = date(1970, 1, 5)


def _weekday_index(day: Column) -> Column:
    """Number of weekdays from Monday 1970-01-05 up to and including ``day``."""
    days = F.datediff(day, F.lit(_MONDAY))
    week = F.floor(days / 7)
    inside = days - week * 7  # 0 = Monday
    return week * 5 + F.least(inside + 1, F.lit(5))


def business_days_between(start: str | Column, end: str | Column, holidays: Iterable[date] = ()) -> Column:
    """Weekdays in the half-open range (start, end]; negative when reversed, NULL safe.

    Closed form: the difference of two running weekday counts, so the cost does not grow
    with the length of the range.  ``holidays`` is a short list of dates; those falling on
    a weekday inside the range are taken off.
    """
    a, b = col(start).cast("date"), col(end).cast("date")
    total = _weekday_index(b) - _weekday_index(a)
    off = sorted({h for h in holidays if h.weekday() < 5})
    if off:
        days = F.array(*[F.lit(h) for h in off])
        forward = F.size(F.filter(days, lambda d: (d > a) & (d <= b)))
        backward = F.size(F.filter(days, lambda d: (d > b) & (d <= a)))
        total = total - forward + backward
    return F.when(a.isNotNull() & b.isNotNull(), total).cast("bigint")
