"""Rules as data: buckets, ordered text rules, incident windows, conformed unions."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import col, ilike_any


def case(rules: Sequence[tuple[Column, Column | str]], default: Column | None = None) -> Column:
    """Searched CASE: the first true condition decides; NULL conditions fall through."""
    out = None
    for cond, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if out is None:
        raise ValueError("no rules")
    return out if default is None else out.otherwise(default)


def bucketize(value: str | Column, ranges: Sequence[tuple[float | None, float | None, str]]) -> Column:
    """Label of the first range holding the value (both ends included, None is open)."""
    v = col(value)
    rules = []
    for low, high, label in ranges:
        cond = F.lit(True)
        if low is not None:
            cond = cond & (v >= low)
        if high is not None:
            cond = cond & (v <= high)
        rules.append((cond, label))
    return case(rules)


# Fixed values: (low, high, label), ends included.
WAIT_RANGES = [
    (0, 5, "00-5 secs"),
    (5, 10, "5-10 secs"),
    (10, 15, "10-15 secs"),
    (15, 20, "15-20 secs"),
    (20, 25, "20-25 secs"),
    (25, 30, "25-30 secs"),
    (30, 35, "30-35 secs"),
    (35, 40, "35-40 secs"),
    (40, 45, "40-45 secs"),
    (45, 50, "45-50 secs"),
    (50, 55, "50-55 secs"),
    (55, 60, "56-60 secs"),
    (60, None, "60+ secs"),
]
CALLBACK_RANGES = [
    (0, 299, "00-05 mins"),
    (300, 599, "05-10 mins"),
    (600, 899, "10-15 mins"),
    (900, 1799, "15-30 mins"),
    (1800, None, "30+ mins"),
]
LIFETIME_RANGES = [
    (0, 172799, "00-02 days"),
    (172800, 345599, "02-04 days"),
    (345600, 604799, "04-07 days"),
    (604800, 1209599, "07-14 days"),
    (1209600, 2591999, "14-30 days"),
    (2592000, None, "30+ days"),
]
DAY_SLOTS_4 = [
    (0, 5, "Midnight to 6am"),
    (6, 11, "6am to Noon"),
    (12, 16, "Noon to 5pm"),
    (17, 23, "5pm to Midnight"),
]
DAY_SLOTS_6 = [
    (0, 5, "Midnight to 6am"),
    (6, 8, "6am to 9am"),
    (9, 11, "9am to Noon"),
    (12, 13, "Noon to 2pm"),
    (14, 16, "2pm to 5pm"),
    (17, 23, "5pm to Midnight"),
]


def hour_slot(ts: str | Column, slots=DAY_SLOTS_4) -> Column:
    return bucketize(F.hour(col(ts)), slots)


@dataclass(frozen=True)
class TextRule:
    """Any ILIKE pattern -> label.  ``exact`` compares the whole text with case instead."""

    label: str
    patterns: tuple[str, ...]
    exact: bool = False

    def condition(self, text: Column) -> Column:
        if self.exact:
            return text.isin(*self.patterns)
        return ilike_any(text, self.patterns)


def classify(text: str | Column, rules: Sequence[TextRule], default: Column | None = None) -> Column:
    """Label of the first matching rule, else ``default`` (NULL when not given)."""
    t = col(text)
    return case([(r.condition(t), r.label) for r in rules], default)


def origin_default(origin: str | Column) -> Column:
    """Class of a case no queue rule matched."""
    o = col(origin)
    return F.when(o == "Chat", "Messaging").when(o == "Apparel", "Apparel").when(o.isNull(), "Messaging").otherwise(o)


def conformed_union(sources: Sequence[DataFrame], schema: Mapping[str, str]) -> DataFrame:
    """UNION ALL of sources brought to one typed schema; missing columns become typed NULLs."""
    def fit(df: DataFrame) -> DataFrame:
        return df.select(
            *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in schema.items()]
        )

    return functools.reduce(DataFrame.union, [fit(s) for s in sources])


def union_distinct(sources: Sequence[DataFrame], schema: Mapping[str, str]) -> DataFrame:
    return conformed_union(sources, schema).distinct()


def incident_windows(df: DataFrame, ts: str, incidents: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rows inside a configured incident window, with its label, start and end.

    ``incidents`` is a short list of (label, start, end); the first window that holds the
    row decides.  The windows are literals of the plan: nothing is joined or shuffled.
    """
    at = F.col(ts)
    rules = []
    for label, start, end in incidents:
        s, e = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
        rules.append((at.between(s, e), F.struct(F.lit(label).alias("label"), s.alias("start"), e.alias("end"))))
    hit = case(rules)
    return (
        df.withColumn("__hit", hit)
        .filter(F.col("__hit").isNotNull())
        .withColumns({"incident_label": F.col("__hit.label"), "incident_start": F.col("__hit.start"), "incident_end": F.col("__hit.end")})
        .drop("__hit")
    )
