"""Monthly volume and handle time over eight unlike sources."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import PACIFIC, UTC, convert_tz, trunc_date
from ..operators.classify import TextRule, classify, conformed_union, origin_default
from ..operators.metrics import distinct_counts

Tables = Mapping[str, DataFrame]

# every source is brought to these columns; handle time in seconds
SCHEMA = {
    "day": "date",
    "item_id": "string",
    "origin": "string",
    "source": "string",
    "classification": "string",
    "handle_seconds": "double",
}


@dataclass(frozen=True)
class VolumeRules:
    """The rules of an organisation, and what differs between counting arrivals and counting touches.

    ``days``: first and last day that count, or None; each source is cut by a range on its raw time column, a day wider on both
    sides for the zone, so that it reaches the scan.
    """

    queue_rules: Sequence[TextRule]
    assignment_rules: Sequence[TextRule]
    by_touch: bool = False
    days: tuple[str, str] | None = None
    touch_system: str = "desk"
    skipped_channels: Sequence[str] = ("Twitter", "Phone")
    review_method: str = "ADVOCATE"
    deposit_case_type: str = "BANKING RDC RR"
    tz: str = PACIFIC


def _near(df: DataFrame, column: str, r: VolumeRules) -> DataFrame:
    if r.days is None:
        return df
    first, last = (date.fromisoformat(str(d)) for d in r.days)
    lo, hi = F.lit(str(first - timedelta(days=1))).cast("timestamp_ntz"), F.lit(str(last + timedelta(days=2))).cast("timestamp_ntz")
    return df.filter((F.col(column) >= lo) & (F.col(column) < hi))


def _touches(t: Tables, r: VolumeRules) -> DataFrame:
    at = "touch_start_time" if r.by_touch else "created_at"
    cases = t["support_cases"].select("case_id", F.col("origin").alias("case_origin"), "first_assigned_queue")
    rows = _near(t["unified_touches"], at, r).filter(F.col("source") == r.touch_system).join(cases, "case_id", "left")
    rows = rows.filter(~F.coalesce("channel", "case_origin").isin(*r.skipped_channels))
    queue = F.col("queue_name" if r.by_touch else "first_assigned_queue")
    return rows.select(
        F.col(at).cast("date").alias("day"),
        F.col("touch_id" if r.by_touch else "case_id").alias("item_id"), F.col("case_origin").alias("origin"), "source",
        classify(queue, r.queue_rules, origin_default("case_origin")).alias("classification"),
        F.col("handle_time").alias("handle_seconds"),
    )


def _reviews(t: Tables, r: VolumeRules) -> DataFrame:
    rows = _near(t["identity_reviews"], "created_at", r).filter(F.col("method_of_review") == r.review_method)
    return rows.select(
        F.col("created_at").cast("date").alias("day"), F.col("token").alias("item_id"), F.lit("idv").alias("source"), F.lit("AR").alias("classification")
    )


def _assignments(t: Tables, r: VolumeRules) -> DataFrame:
    at = "claimed_at" if r.by_touch else "occurred_at"
    rows = _near(t["assignments"], at, r).select(
        convert_tz(at, r.tz, UTC).cast("date").alias("day"), F.col("assignment_id").alias("item_id"), F.lit("assignment").alias("source"),
        classify("queue", r.assignment_rules).alias("classification"), (F.col("handled_minutes") * 60).alias("handle_seconds"),
    )
    return rows.filter(F.col("classification").isNotNull()).distinct()


def _bank_risk(t: Tables, r: VolumeRules) -> DataFrame:
    kind = F.when(F.col("case_type") == r.deposit_case_type, "Remote Deposit Capture").otherwise("Banking")
    return _near(t["bank_risk_cases"], "created_at", r).select(
        convert_tz("created_at", r.tz, UTC).cast("date").alias("day"), F.col("case_id").alias("item_id"),
        F.lit("internal transfer").alias("origin"), F.lit("bank_risk").alias("source"), kind.alias("classification"),
    )


def _with_regulated(df: DataFrame, regulated: DataFrame, token: str) -> DataFrame:
    side = regulated.select(F.col("target_token").alias("__t"), "handled_seconds")
    return df.join(side, F.col(token) == F.col("__t"), "left")


def _hashtags(t: Tables, r: VolumeRules) -> DataFrame:
    return _with_regulated(_near(t["bank_hashtags"], "hashtag_at", r), t["regulated"], "target_token").select(
        F.col("hashtag_at").cast("date").alias("day"), F.col("primary_key").alias("item_id"), F.lit("internal transfer").alias("origin"),
        F.lit("hashtag").alias("source"), F.lit("Remote Deposit Capture").alias("classification"), F.col("handled_seconds").alias("handle_seconds"),
    )


def _card_designs(t: Tables, r: VolumeRules) -> DataFrame:
    return _with_regulated(_near(t["card_designs"], "created_at", r), t["regulated"], "token").select(
        convert_tz("created_at", r.tz, UTC).cast("date").alias("day"), F.col("customer_token").alias("item_id"), F.lit("card_design").alias("source"),
        F.lit("AR").alias("classification"), F.col("handled_seconds").alias("handle_seconds"),
    )


def _social(t: Tables, r: VolumeRules) -> DataFrame:
    return _near(t["social_cases"], "created_at", r).select(
        convert_tz("created_at", r.tz, UTC).cast("date").alias("day"), F.col("case_id").alias("item_id"), F.col("channel_type").alias("origin"),
        F.lit("Social").alias("source"), F.lit("Social").alias("classification"),
    )


def _voice(t: Tables, r: VolumeRules) -> DataFrame:
    rows = _near(t["call_records"], "case_created_date", r).filter(~F.col("out_of_hours") & F.col("is_handled"))
    return rows.select(
        convert_tz("case_created_date", r.tz, UTC).cast("date").alias("day"), F.col("contact_id").alias("item_id"), F.lit("Voice").alias("source"),
        F.lit("Voice").alias("classification"), F.col("handle_time").alias("handle_seconds"),
    )


SOURCES: Sequence[Callable[[Tables, VolumeRules], DataFrame]] = (
    _touches, _reviews, _assignments, _bank_risk, _hashtags, _card_designs, _social, _voice,
)


def volume_rows(t: Tables, rules: VolumeRules) -> DataFrame:
    """The eight sources as one conformed table."""
    return conformed_union([s(t, rules) for s in SOURCES], SCHEMA)


def monthly_volume(t: Tables, first_day: str, last_day: str, rules: VolumeRules) -> DataFrame:
    """Month x class: distinct items with and without handle time, minutes handled.

    The calendar only limits the days, so it is a range filter on every source.  Handle times count in seconds whatever the unit of their source.  Items
    without handle time are told by a NULL instead of a text prefix.
    """
    lo, hi = F.lit(first_day).cast("date"), F.lit(last_day).cast("date")
    rows = volume_rows(t, replace(rules, days=(first_day, last_day))).filter(F.col("day").between(lo, hi)).withColumn("month", trunc_date("month", "day"))
    timed: Column = F.col("handle_seconds").isNotNull()
    # touches of the desk and calls always count as timed, as their class carries no prefix
    always = F.col("source").isin(rules.touch_system, "Voice")
    out = distinct_counts(
        rows, ["month", "classification"], "item_id", {"without_time": ~(timed | always), "with_time": timed | always, "total": None},
        sums={"__s": F.col("handle_seconds")},
    )
    return out.withColumn("handle_time_minutes", F.round(F.col("__s") / 60, 2)).drop("__s")


def monthly_touches(t: Tables, first_day: str, last_day: str, rules: VolumeRules) -> DataFrame:
    """The same by touch: touch ids, touch days, rules on the queue of the touch."""
    return monthly_volume(t, first_day, last_day, replace(rules, by_touch=True))
