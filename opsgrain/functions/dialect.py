"""Column functions whose meaning differs between warehouse SQL and Spark.

Every silent difference is settled here once: boundary date differences, whole-string
regular expressions, LIKE without a default escape, zero-based array slices, guarded
division, wall-clock truncation, half-hour slices and whole-number storage.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PACIFIC = "America/Los_Angeles"
UTC = "UTC"

_SECONDS = {"second": 1, "minute": 60, "hour": 3600}


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _unit(unit: str) -> str:
    return unit.lower().rstrip("s")


def epoch(ts: str | Column) -> Column:
    """Whole seconds since 1970 of a date or wall-clock timestamp (floored)."""
    return F.unix_seconds(col(ts).cast("timestamp"))


def ntz(ts: str | Column) -> Column:
    return col(ts).cast("timestamp_ntz")


def convert_tz(ts: str | Column, from_tz: str, to_tz: str) -> Column:
    """Shift a wall-clock timestamp between zones; daylight saving aware."""
    if from_tz == to_tz:
        return ntz(ts)
    return F.convert_timezone(F.lit(from_tz), F.lit(to_tz), ntz(ts))


def trunc(unit: str, ts: str | Column) -> Column:
    """DATE_TRUNC that stays a wall-clock timestamp (weeks start on Monday)."""
    return ntz(F.date_trunc(_unit(unit), col(ts).cast("timestamp")))


def trunc_date(unit: str, ts: str | Column) -> Column:
    return trunc(unit, ts).cast("date")


def time_slice(ts: str | Column, minutes: int, end: bool = False) -> Column:
    """Start (or end) of the fixed-width slice holding ``ts``, aligned on the epoch."""
    width = minutes * 60
    start = F.floor(epoch(ts) / width) * width
    if end:
        start = start + width
    return ntz(F.timestamp_seconds(start))


def add(unit: str, amount: int | Column, ts: str | Column) -> Column:
    """DATEADD; the unit may be any of second .. year."""
    amount = F.lit(amount) if isinstance(amount, int) else amount
    unit = _unit(unit)
    if unit == "day":
        unit = "DAY"
    return F.timestamp_add(unit.upper(), amount.cast("int"), ntz(ts))


def datediff_boundary(unit: str, start: str | Column, end: str | Column) -> Column:
    """Number of unit boundaries crossed from ``start`` to ``end``.

    23:59:59 -> 00:00:00 is one day, one hour, one minute and one second; Spark's own
    ``timestampdiff`` counts whole elapsed units instead.
    """
    unit = _unit(unit)
    a, b = col(start), col(end)
    if unit in _SECONDS:
        width = _SECONDS[unit]
        return (F.floor(epoch(b) / width) - F.floor(epoch(a) / width)).cast("bigint")
    if unit == "day":
        return F.datediff(b.cast("date"), a.cast("date")).cast("bigint")
    if unit == "week":
        return (F.datediff(trunc_date("week", b), trunc_date("week", a)) / 7).cast("bigint")
    months = (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))
    if unit == "month":
        return months.cast("bigint")
    if unit == "quarter":
        return ((F.year(b) - F.year(a)) * 4 + (F.quarter(b) - F.quarter(a))).cast("bigint")
    if unit == "year":
        return (F.year(b) - F.year(a)).cast("bigint")
    raise ValueError(f"unknown unit {unit!r}")


def safe_ratio(num: str | Column, den: str | Column, scale: float = 1, digits: int | None = None) -> Column:
    """num / den * scale, NULL when the denominator is 0 or NULL."""
    out = col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))
    if scale != 1:
        out = out * F.lit(float(scale))
    return out if digits is None else F.round(out, digits)


def full_match(text: str | Column, pattern: str) -> Column:
    """REGEXP predicate anchored at both ends (Spark's RLIKE searches)."""
    return col(text).rlike(f"^(?:{pattern})$")


def regexp_first(text: str | Column, pattern: str) -> Column:
    """First match, NULL where nothing matches."""
    return F.regexp_substr(col(text), F.lit(pattern))


def like_plain(text: str | Column, pattern: str, escape: str | None = None, ignore_case: bool = False) -> Column:
    """LIKE / ILIKE where the backslash is an ordinary character unless named as escape."""
    esc = "\u0001" if escape is None else escape
    value = col(text)
    fn = F.ilike if ignore_case else F.like
    return fn(value, F.lit(pattern), F.lit(esc))


def ilike_any(text: str | Column, patterns: Sequence[str]) -> Column:
    return functools.reduce(operator.or_, [like_plain(text, p, ignore_case=True) for p in patterns])


def array_slice0(arr: str | Column, start: int | Column, stop: int | Column) -> Column:
    """Zero-based half-open slice."""
    start = F.lit(start) if isinstance(start, int) else start
    stop = F.lit(stop) if isinstance(stop, int) else stop
    return F.slice(col(arr), (start + 1).cast("int"), F.greatest(stop - start, F.lit(0)).cast("int"))


def whole_number(value: str | Column) -> Column:
    """Storage in a scale-0 numeric column: rounds half up."""
    return F.round(col(value)).cast("decimal(38,0)")


def null_as_other(text: str | Column, default: str = "other") -> Column:
    return F.coalesce(F.lower(col(text)), F.lit(default))


def email_local_part(email: str | Column) -> Column:
    return F.substring_index(col(email), "@", 1)


def deep_link(record_id: str | Column, prefix: str, suffix: str = "/view") -> Column:
    return F.concat(F.lit(prefix), col(record_id), F.lit(suffix))


def percent_text(value: Column) -> Column:
    """Rounded percentage as text, e.g. ``42%``."""
    return F.concat(F.round(value).cast("bigint").cast("string"), F.lit("%"))


_COMPARE = {
    "<": operator.lt,
    "<=": operator.le,
    "=": operator.eq,
    ">": operator.gt,
    ">=": operator.ge,
    "Less Than": operator.lt,
    "Less Than or Equal": operator.le,
    "Equal": operator.eq,
    "Greater Than": operator.gt,
    "Greater Than or Equal": operator.ge,
}


def compare(left: str | Column, op: str, value, numeric_version: bool = False) -> Column:
    """Comparison whose operator is picked at run time.

    ``numeric_version`` compares dotted versions part by part ('3.10' > '3.9'); without it
    the comparison is the plain one of the column's type.
    """
    if op not in _COMPARE:
        raise ValueError(f"operator {op!r} is not allowed")
    left = col(left)
    right = value if isinstance(value, Column) else F.lit(value)
    if numeric_version:
        left, right = version_key(left), version_key(right)
    return _COMPARE[op](left, right)


def version_key(version: str | Column) -> Column:
    """Sortable array of the numeric parts of a dotted version."""
    parts = F.split(col(version), "\\.")
    return F.transform(parts, lambda p: F.coalesce(F.regexp_replace(p, "[^0-9]", "").try_cast("int"), F.lit(0)))


def digits_number(text: str | Column) -> Column:
    """Number left after dropping all but digits and dots, NULL if that is no number."""
    return F.regexp_replace(col(text), "[^0-9.]", "").try_cast("double")


def time_of_day(ts: str | Column) -> Column:
    return F.date_format(col(ts), "HH:mm:ss")


def same_time_of_day_or_earlier(ts: str | Column, as_of: Column, shift_hours: int = 0) -> Column:
    """True where the clock time of ``ts`` is not later than that of ``as_of``."""
    return time_of_day(add("hour", shift_hours, ts)) <= time_of_day(as_of)
