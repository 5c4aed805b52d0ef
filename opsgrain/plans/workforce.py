"""Schedules: adherence, shrinkage, staffing, availability, interval productivity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dialect import UTC, email_local_part, ilike_any, safe_ratio
from ..operators.calendar import calendar_spine
from ..operators.intervals import available_in_interval, prorate_to_intervals, slots_inside
from ..operators.joins import asof_dim, contains_join
from ..operators.metrics import distinct_counts, with_totals
from ..operators.quality import key_uniqueness

Tables = Mapping[str, DataFrame]


def adherence(t: Tables, *, attribute: str = "Available") -> DataFrame:
    """Share of the scheduled seconds in adherence, with the employee of the time."""
    rows = t["adherence"].filter(F.col("attribute") == attribute)
    cols = {"full_name": "full_name", "team_code": "team_code", "is_bpo": "is_bpo", "is_advocate": "is_advocate", "city": "city", "manager": "manager"}
    rows = asof_dim(rows, t["employees"], ("wfm_id", "employee_id"), "period_ltz", cols, by_date=False)
    # the zone is a column here; the zones in use are few, so one conversion per row is native
    at = F.convert_timezone(F.col("local_timezone"), F.lit(UTC), F.col("period_ltz").cast("timestamp_ntz"))
    return rows.withColumns({"ts_utc": at, "date_utc": at.cast("date"), "adherence": safe_ratio("in_adherence_seconds", "scheduled_seconds")})


def schedule_shares(schedule: DataFrame, since: str, until: str) -> DataFrame:
    """Employee x day x channel x shift: share of the channel in the scheduled seconds of the day."""
    day = F.col("interval_start").cast("date")
    rows = schedule.withColumn("day", day).filter(F.col("day").between(F.lit(since).cast("date"), F.lit(until).cast("date")))
    parts = rows.groupBy("employee_id", "day", "schedule_channel", "shift_name").agg(F.sum("duration_seconds").alias("__s"))
    parts = with_totals(parts, ["employee_id", "day", "schedule_channel"], {"channel_seconds": ("sum", F.col("__s"))})
    parts = with_totals(parts, ["employee_id", "day"], {"day_seconds": ("sum", F.col("__s"))}).drop("__s")
    # a day of one employee has a handful of rows
    w = Window.partitionBy("employee_id", "day").orderBy(
        F.col("schedule_channel").desc_nulls_last(), F.col("channel_seconds").desc_nulls_first(), F.col("shift_name").asc_nulls_last()
    )
    return parts.withColumns({"channel_pct": safe_ratio("channel_seconds", "day_seconds", 100, 2), "place": F.row_number().over(w)})


def shift_hours(t: Tables) -> DataFrame:
    """Scheduled and non-productive hours of employees on days they took calls."""
    calls = t["call_records"].withColumn("day", F.col("call_start_time").cast("date"))
    worked = asof_dim(calls, t["employees"], ("agent_user_name", "agent_id"), "call_start_time", {"employee_id": "employee_id"}, how="inner")
    worked = worked.select("employee_id", "day").distinct()
    rows = t["schedule"].withColumn("day", F.col("interval_start").cast("date")).join(worked, ["employee_id", "day"], "left_semi")
    return rows.groupBy("employee_id", "day", "shift_name").agg(
        F.round(F.sum("duration_seconds") / 3600, 2).alias("scheduled_hours"),
        F.round(F.sum("non_prod_seconds") / 3600, 2).alias("non_prod_hours"),
    )


def schedule_grain(schedule: DataFrame) -> DataFrame:
    """Rows against distinct (day, employee)."""
    return key_uniqueness(schedule.withColumn("day", F.col("interval_start").cast("date")), ["day", "employee_id"])


# Shifts that mean absence.
ABSENCE = ("%vacation%", "%sick%", "%absence%", "%bereavement%")


def staffing_forecast(schedule: DataFrame, *, per_head: int = 15, patterns: Sequence[str] = ABSENCE) -> DataFrame:
    """Volume the staff could take against the volume planned with all of it, per day."""
    out = distinct_counts(
        schedule, ["day"], "employee_id", {"total_employees": None, "absent_employees": ilike_any("shift_name", patterns)}
    )
    return out.withColumns(
        {
            "actual_volume": (F.col("total_employees") - F.col("absent_employees")) * per_head,
            "forecasted_volume": F.col("total_employees") * per_head,
        }
    )


def available_minutes(activity: DataFrame, day_from, day_to, *, code: str = "Available") -> DataFrame:
    """Available minutes per half hour and their total per day, over all given people.

    Half hours without an available span stay with NULL minutes.
    """
    spans = activity.filter((F.col("code") == code) & F.col("status_remove_time").isNotNull()).select(
        email_local_part("email").alias("login"), F.col("date_time").alias("start_ts"), F.col("status_remove_time").alias("end_ts")
    )
    spine = calendar_spine(activity.sparkSession, day_from, day_to, "30 minutes")
    hits = slots_inside(spans, "start_ts", "end_ts", day_from, day_to, 30)
    hits = hits.withColumn("available_minutes", available_in_interval(F.col("interval_start"), F.col("interval_end"), F.col("end_ts")))
    # distinct rows with their number; what follows reads these only, and all its other sides have one row per slot or day at most
    cols = ["report_date", "interval_start", "login", "start_ts", "end_ts", "available_minutes"]
    rows = hits.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    slots = rows.groupBy("report_date", "interval_start").agg(F.sum(F.col("available_minutes") * F.col("__n")).alias("__minutes"))
    slots = spine.select("report_date", "interval_start").join(slots, ["report_date", "interval_start"], "left")
    days = slots.groupBy("report_date").agg(F.sum("__minutes").alias("day_minutes"))
    empty = slots.filter(F.col("__minutes").isNull()).select("report_date", "interval_start")
    out = rows.select(*cols).unionByName(empty, allowMissingColumns=True)
    return out.join(days, "report_date").select(*cols, "day_minutes")


def escalation_activity(chats: DataFrame, activity: DataFrame, record_type: str) -> DataFrame:
    """Chats of a type per agent and instant, with the agent's activity spans of the same instant.

    The plain join on the agent pairs every chat with every span of the agent; what such rows
    are used for is the span a chat falls into, so the instant is part of the join here.
    """
    worked = chats.filter(F.col("chat_record_type") == record_type).select(
        F.col("chat_start_time").alias("worked_ts"), F.col("chat_advocate_login").alias("login"), "chat_advocate_is_bpo"
    ).distinct()
    spans = activity.select(
        email_local_part("email").alias("login"), F.col("date_time").alias("start_ts"), "code", F.col("status_remove_time").alias("end_ts")
    )
    return contains_join(worked, spans, "worked_ts", "start_ts", "end_ts", minutes=30, keys=["login"])


def interval_productivity(touches: DataFrame, *, minutes: int = 30, compat: bool = False) -> DataFrame:
    """Distinct people and minutes worked per interval."""
    parts = prorate_to_intervals(touches, "touch_start_time", "touch_end_time", minutes, compat=compat)
    out = distinct_counts(
        parts, ["interval_start", "interval_end"], "full_name", {"total_advocates": None}, sums={"__seconds": F.col("interval_seconds")}
    )
    return out.withColumns(
        {"report_date": F.col("interval_start").cast("date"), "total_minutes": F.col("__seconds") / 60}
    ).drop("__seconds")


__all__ = [
    "ABSENCE", "adherence", "available_minutes", "escalation_activity", "interval_productivity", "schedule_grain", "schedule_shares",
    "shift_hours", "staffing_forecast",
]
