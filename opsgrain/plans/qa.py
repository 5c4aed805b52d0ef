"""Reconciliation of touch sources, keyed lookups, pattern truth tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import like_plain, safe_ratio
from ..operators.quality import computed_vs_stored, distinct_values, null_rows, validate_patterns
from ..sources.tables import in_years, lookup

Tables = Mapping[str, DataFrame]


def touches_without_channel(unified: DataFrame) -> DataFrame:
    return null_rows(unified, "channel").select("touch_id").distinct()


def missing_handle_time(t: Tables, *, since_year: int = 2023) -> DataFrame:
    """Legacy touches without handle time beside what the unified source knows of their case.

    Each legacy touch gets one row with the number of unified touches and their handle time;
    the plain join of the two sources would pair every touch of a case with every other.
    """
    legacy = in_years(null_rows(t["messaging_touches"], "handle_time_seconds"), "touch_start_time", since_year)
    known = t["unified_touches"].filter(F.col("case_id").isNotNull()).groupBy("case_id").agg(
        F.countDistinct("touch_id").alias("unified_touches"), F.sum("handle_time").alias("unified_handle_time")
    )
    return legacy.join(known, "case_id").select("case_id", "touch_id", "touch_start_time", "unified_touches", "unified_handle_time")


def missing_handle_summary(t: Tables, *, since_year: int = 2023) -> DataFrame:
    """One row: cases, unified touches and hours behind legacy touches without handle time.

    The hours count a unified touch once per legacy touch of its case, as joining the two does.
    """
    rows = missing_handle_time(t, since_year=since_year)
    per = rows.groupBy("case_id").agg(
        F.max("unified_touches").alias("touches"), F.sum("unified_handle_time").alias("seconds")
    )
    return per.agg(
        F.count("case_id").alias("total_cases"), F.sum("touches").alias("total_touches"),
        safe_ratio(F.sum("seconds"), F.lit(3600)).alias("total_handle_hours"),
    )


def lifetime_check(touches: DataFrame) -> DataFrame:
    """Lifetime recomputed from assignment and end beside the stored one."""
    return computed_vs_stored(touches, "touch_assignment_time", "touch_end_time", "touch_lifetime_seconds")


def channels_in_use(touches: DataFrame, since_year: int = 2022) -> DataFrame:
    return distinct_values(in_years(touches, "touch_start_time", since_year), ["communication_channel"])


def both_sources(t: Tables, case_ids: Sequence | None = None) -> DataFrame:
    """Touches of both sources below each other, told apart by ``db``."""
    a = t["messaging_touches"].select(
        "case_id", "touch_start_time", "touch_end_time", F.col("handle_time_seconds").alias("handle_time"), "queue_name", F.lit("legacy").alias("db")
    )
    b = t["unified_touches"].select("case_id", "touch_start_time", "touch_end_time", "handle_time", "queue_name", F.lit("unified").alias("db"))
    rows = a.union(b)
    return rows if case_ids is None else lookup(rows, "case_id", case_ids)


def pattern_truth_table(df: DataFrame, column: str, patterns: Mapping[str, str]) -> DataFrame:
    """Whole-string matches of every text against every named pattern."""
    return validate_patterns(df, column, patterns)


def wildcard_truth_table(df: DataFrame, column: str, tests: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """ILIKE results per named (pattern, escape character)."""
    return df.withColumns({n: like_plain(column, p, esc, ignore_case=True) for n, (p, esc) in tests.items()})
